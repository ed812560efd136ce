"""Exact k-nearest-neighbour join without all-pairs work, and the classifier built on it.

Equal points are collapsed first, on both sides: copies never meet each other. The distinct training points of every key are cut
by a balanced tree: a node with more than ``LEAF_ROWS`` points is halved at the median of its widest column, level by level, each
level one grouping over all points. Nodes keep their bounding boxes. A query first meets the leaf that it falls into; its k-th
distance there then rules out every node whose box is farther away, again level by level, and it meets the leaves
that are left. Leaves and queries are tables that are joined by node; nothing about them is held at the driver.
The tree only steers the work; the result does not depend on it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlens.settings import TRANSFORMED_FEATURES
from campaignlens.sources.store import durable

LEAF_ROWS = 2_048
CHUNK_ROWS = 8_192
DISTANCE_DIGITS = 9
SLACK = 1e-6
QUERY_SLICE = 256
SALTS = 64
_LEVELS_PER_TABLE = 6


def _field_list(rows: DataFrame, names: Sequence[str]) -> str:
    kinds = dict(rows.dtypes)
    return ", ".join(f"`{n}` {kinds[n]}" for n in names)


def _grown(points: DataFrame, keys: Sequence[str], width: int, leaf_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """Points with their leaf ``node``, and one table of nodes per level: box ``low`` and ``high``, ``dim`` and ``cut`` of inner ones."""
    node = [*keys, "node"]
    done, active, levels = None, points.withColumn("node", F.lit(1).cast("bigint")), []
    while True:
        coordinate = [F.col("x")[i] for i in range(width)]
        boxes = active.groupBy(*node).agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.min(c) for c in coordinate]).alias("low"),
            F.array(*[F.max(c) for c in coordinate]).alias("high"),
        )
        spreads = F.array(*[F.struct((F.col("high")[i] - F.col("low")[i]).alias("spread"), F.lit(-i).alias("dim")) for i in range(width)])
        widest = F.array_max(spreads)
        boxes = durable(boxes.withColumn("dim", F.when((F.col("n") > leaf_rows) & (widest["spread"] > 0), -widest["dim"])))
        inner = boxes.where("dim IS NOT NULL")
        value = F.element_at("x", F.col("dim") + 1)
        halves = active.join(inner.select(*node, "dim"), node).groupBy(*node).agg(F.percentile_approx(value, 0.5, 1000).alias("half"))
        least, most = F.element_at("low", F.col("dim") + 1), F.element_at("high", F.col("dim") + 1)
        # both sides get points: a median that is also the maximum gives way to the middle
        cut = F.when(F.col("half") < most, F.col("half")).otherwise((least + most) / 2)
        level = durable(boxes.join(halves, node, "left").withColumn("cut", F.when(F.col("dim").isNotNull(), cut)).drop("half"))
        levels.append(level)
        stepped = active.join(level.select(*node, "dim", "cut"), node)
        child = F.col("node") * 2 + F.when(value <= F.col("cut"), 0).otherwise(1)
        stored = durable(stepped.withColumn("node", F.when(F.col("dim").isNull(), F.col("node")).otherwise(child)).withColumn("ended", F.col("dim").isNull()).drop("dim", "cut"))
        ended = stored.where("ended").drop("ended")
        done = ended if done is None else done.union(ended)
        active = stored.where("NOT ended").drop("ended")
        if inner.isEmpty():
            return done, levels


def _home(queries: DataFrame, levels: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Queries with the leaf ``node`` they fall into; those of a key without points are left out."""
    node = [*keys, "node"]
    at = queries.withColumn("node", F.lit(1).cast("bigint"))
    for depth, level in enumerate(levels):
        cuts = level.select(*node, "dim", "cut", F.lit(True).alias("here"))
        joined = at.join(cuts, node, "inner" if depth == 0 else "left")
        child = F.col("node") * 2 + F.when(F.element_at("x", F.col("dim") + 1) <= F.col("cut"), 0).otherwise(1)
        at = joined.withColumn("node", F.when(F.col("dim").isNull(), F.col("node")).otherwise(child)).drop("dim", "cut", "here")
        if depth % _LEVELS_PER_TABLE == _LEVELS_PER_TABLE - 1:
            at = durable(at)
    return at


def _within_reach(queries: DataFrame, levels: Sequence[DataFrame], keys: Sequence[str], width: int) -> DataFrame:
    """Queries ``(keys, qid, x, home, limit)`` once per leaf ``node``, other than their home, whose box lies within their limit."""
    node = [*keys, "node"]
    gaps = [F.greatest(F.col("low")[i] - F.col("x")[i], F.col("x")[i] - F.col("high")[i], F.lit(0.0)) for i in range(width)]
    distance = F.sqrt(sum(g * g for g in gaps))
    leaves, at = None, queries.withColumn("node", F.lit(1).cast("bigint"))
    for level in levels:
        near = at.join(level.select(*node, "low", "high", "dim"), node).where(distance <= F.col("limit") + SLACK).drop("low", "high")
        stored = durable(near)
        found = stored.where("dim IS NULL").drop("dim")
        leaves = found if leaves is None else leaves.union(found)
        both = F.explode(F.array(F.col("node") * 2, F.col("node") * 2 + 1))
        at = stored.where("dim IS NOT NULL").withColumn("node", both).drop("dim")
    return leaves.where("node <> home").select(*keys, "qid", "x", "node")


def _search(routed: DataFrame, train: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The k closest training rows of each query within each visited leaf."""
    keys = list(keys)
    unit = [*keys, "node"]
    # One row per unit: how many pieces each side is cut into. Small tables are broadcast by the engine itself.
    pieces = (
        train.groupBy(*unit).agg(F.count(F.lit(1)).alias("rows"))
        .join(routed.groupBy(*unit).agg(F.count(F.lit(1)).alias("visits")), unit)
        .select(
            *unit,
            F.ceil(F.col("rows") / CHUNK_ROWS).cast("int").alias("salts"),
            F.ceil(F.col("visits") / CHUNK_ROWS).cast("int").alias("chunks"),
        )
    )
    part = lambda name, n: F.pmod(F.xxhash64(name), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kinds = _field_list(train, keys)
    left = (
        routed.join(pieces, unit)
        .withColumns({"chunk": part("qid", "chunks")})
        .select(*unit, "qid", F.col("x").alias("qx"), "chunk", every("salts").alias("salt"))
    )
    right = (
        train.join(pieces, unit)
        .withColumns({"salt": part("id", "salts")})
        .select(*unit, "id", "y", "x", "salt", every("chunks").alias("chunk"))
    )
    group = [*unit, "salt", "chunk"]

    def closest(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        names = [*keys, "qid", "id", "y", "d2"]
        if not len(q) or not len(t):
            return pd.DataFrame({n: [] for n in names})
        points, ids, labels = np.vstack(t["x"].to_numpy()), t["id"].to_numpy(), t["y"].to_numpy()
        targets, qids = np.vstack(q["qx"].to_numpy()), q["qid"].to_numpy()
        take = min(k, len(points))
        frames: list[tuple[np.ndarray, ...]] = []
        for start in range(0, len(targets), QUERY_SLICE):
            some = targets[start : start + QUERY_SLICE]
            d2 = np.zeros((len(some), len(points)))
            for j in range(points.shape[1]):
                d2 += (some[:, j, None] - points[None, :, j]) ** 2
            d2 = np.round(d2, DISTANCE_DIGITS)
            edge = np.partition(d2, take - 1, axis=1)[:, take - 1]
            row, point = np.nonzero(d2 <= edge[:, None])
            order = np.lexsort((ids[point], d2[row, point], row))
            row, point = row[order], point[order]
            place = np.arange(len(row)) - np.searchsorted(row, np.arange(len(some)))[row]
            row, point = row[place < take], point[place < take]
            frames.append((qids[start + row], ids[point], labels[point], d2[row, point]))
        out = pd.DataFrame({n: np.concatenate(c) for n, c in zip(("qid", "id", "y", "d2"), zip(*frames))})
        for name in keys:
            out[name] = q[name].iloc[0]
        return out[names]

    schema = (kinds + ", " if keys else "") + "qid bigint, id bigint, y int, d2 double"
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(closest, schema)


def _closest_k(found: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys, "qid").orderBy("d2", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    columns: Sequence[str] = TRANSFORMED_FEATURES,
    keys: Sequence[str] = (),
    exclude_self: bool = False,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``(keys, qid, id, y, d2, rank)``: the k training rows closest to every query row.

    ``queries`` needs ``(keys, id, columns)`` and ``train`` needs ``(keys, id, y, columns)``; only
    rows with equal keys are compared. Equal distances are ordered by id. With ``exclude_self``
    a row is never its own neighbour.
    """
    keys, width = list(keys), len(columns)
    wanted = k + 1 if exclude_self else k
    coordinates = F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("x")
    points = queries.select(*keys, F.col("id").alias("qid"), coordinates)
    # One search per distinct query point; of equal training points only the first ids can be neighbours.
    distinct = durable(points.groupBy(*keys, "x").agg(F.min("qid").alias("qid")))
    rows = train.select(*keys, "id", F.col("y").cast("int").alias("y"), coordinates)
    located, levels = _grown(durable(_first_of_equal(rows, keys, wanted)), keys, width, leaf_rows)
    homes = durable(_home(distinct, levels, keys))
    first = durable(_closest_k(_search(homes, located, keys, wanted), keys, wanted))
    reach = first.groupBy(*keys, "qid").agg(
        F.when(F.count(F.lit(1)) >= wanted, F.sqrt(F.max("d2"))).otherwise(F.lit(float("inf"))).alias("limit")
    )
    limited = durable(homes.withColumnRenamed("node", "home").join(reach, [*keys, "qid"]))
    second = _search(durable(_within_reach(limited, levels, keys, width)), located, keys, wanted)
    found = _closest_k(first.drop("rank").unionByName(second), keys, wanted).withColumnRenamed("qid", "first_qid")
    copies = points.join(distinct.withColumnRenamed("qid", "first_qid"), [*keys, "x"]).select(*keys, "qid", "first_qid")
    everyone = copies.join(found.drop("rank"), [*keys, "first_qid"]).drop("first_qid")
    return _finished(everyone, keys, k, exclude_self)


def _first_of_equal(rows: DataFrame, keys: Sequence[str], wanted: int) -> DataFrame:
    """Of equal points those with the smallest ids, chosen per salt first so that no point's copies meet in one task."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for extra in (["_salt"], []):
        order = Window.partitionBy(*keys, "x", *extra).orderBy("id")
        salted = salted.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= wanted)
    return salted.drop("_salt", "_place")


def _finished(found: DataFrame, keys: Sequence[str], k: int, exclude_self: bool) -> DataFrame:
    if exclude_self:
        found = found.where(F.col("id") != F.col("qid"))
    return _closest_k(found, keys, k)


def neighbour_vote(neighbours: DataFrame, k: int, weights: str = "uniform", keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, id, p)``: share of positive neighbours, equal or inverse-distance weights.

    With distance weights an exact match takes all the weight.
    """
    near = neighbours.where(F.col("rank") <= k)
    y = F.col("y").cast("double")
    if weights == "uniform":
        p: Column = F.avg(y)
    elif weights == "distance":
        exact = F.col("d2") == 0
        inverse = F.when(~exact, F.lit(1.0) / F.sqrt("d2"))
        hits = F.count(F.when(exact, F.lit(1)))
        p = F.when(hits > 0, F.sum(F.when(exact, y)) / hits).otherwise(F.sum(inverse * y) / F.sum(inverse))
    else:
        raise ValueError(f"unknown weights {weights!r}")
    return near.groupBy(*keys, F.col("qid").alias("id")).agg(p.alias("p"))


