"""Forests of fits that a task can hold: each task grows some trees of one fit from the root to the last held-out row.

The trees are those of :mod:`campaignlens.operators.trees`: same bootstrap weights, drawn features, cuts and ties. What differs is who
works: rows are dealt once, in blocks, to tasks of one (fit, batch of trees), and no level is a job. In a task, values are ranks within their
feature. A level sorts, per drawn feature, one number for each row (node, rank, weight, label) and reads running class sums off it.
Only nodes that a held-out row reaches are grown.

A task answers with sums over its trees in units of 2**-52, whose total is the same whatever the order of additions.

Scale: a task holds one fit, at most ``WHOLE_ROWS`` rows; rows travel once per batch of trees.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import md5

import numpy as np
from pyspark.sql import DataFrame, functions as F

from campaignlens.functions.hashing import poisson_cutoffs, xxhash64_bytes, xxhash64_int
from campaignlens.settings import SEED, TRANSFORMED_FEATURES

WHOLE_ROWS = 1 << 20
UNIT = 1 << 52
_ORDERS = 251
_GAIN_UNITS = 1e9
_TASKS_PER_CORE = 4
_ROWS_OUT = 16_384
_PAIR_BITS = 5  # a bootstrap weight below 16 and a label


def feature_orders(every: int = len(TRANSFORMED_FEATURES)) -> list[list[int]]:
    """The orders in which nodes try features; a node's hash picks one."""
    orders = []
    for k in range(_ORDERS):
        order = list(range(every))
        random.Random(SEED * 1000 + k).shuffle(order)
        orders.append(order)
    return orders


def bootstrap_weights(ids: np.ndarray, trees: int) -> np.ndarray:
    """Poisson(1) weight of every id in every tree, as ``poisson_weight`` draws it: one row per tree."""
    tails = [f"|{t}|{SEED}|forest".encode() for t in range(trees)]
    digests = [b"".join([md5(head + tail, usedforsecurity=False).digest() for tail in tails]) for head in (str(i).encode() for i in ids.tolist())]
    hashed = np.frombuffer(b"".join(digests), ">u4")[::4].astype(np.int64)
    return np.searchsorted(poisson_cutoffs(), hashed, side="right").astype(np.uint8).reshape(-1, trees).T


@dataclass
class Table:
    """A fit's training rows as ranks, ``codes[feature, row]``, the features' distinct values, and labels."""

    codes: np.ndarray
    values: list[np.ndarray]
    y: np.ndarray

    @classmethod
    def of(cls, x: Sequence[np.ndarray], y: np.ndarray) -> Table:
        codes, values = np.empty((len(x), len(y)), np.int32), []
        for f, column in enumerate(x):
            found, codes[f] = np.unique(column, return_inverse=True)
            values.append(found)
        return cls(codes, values, y.astype(np.int64))

    def best_cuts(self, rows: np.ndarray, node: np.ndarray, pair: np.ndarray, order: np.ndarray, features: int) -> tuple[np.ndarray, ...]:
        """Feature (-1: none), rank and next rank of every node's best cut among the first drawn features that have any."""
        count, width = order.shape
        bits = int(max(len(v) for v in self.values)).bit_length()
        flat, size = self.codes.ravel(), self.codes.shape[1]
        worth, feature = np.full(count, -np.inf), np.full(count, -1)
        low, high = np.zeros(count, np.int64), np.zeros(count, np.int64)
        for first in range(0, width, features):
            weight = pair >> 1
            n, n1 = np.bincount(node, weight, count), np.bincount(node, weight * (pair & 1), count)
            base, base1 = np.cumsum(n) - n, np.cumsum(n1) - n1
            for slot in range(first, min(first + features, width)):
                drawn = order[:, slot]
                key = (((node << bits) | flat[drawn[node] * size + rows]) << _PAIR_BITS) | pair
                key.sort()
                cell = key >> _PAIR_BITS
                end = np.flatnonzero(cell[1:] != cell[:-1])
                owner = cell[end] >> bits
                inner = owner == cell[end + 1] >> bits  # a cut needs a further value of the node
                end, owner = end[inner], owner[inner]
                if not len(end):
                    continue
                key &= (1 << _PAIR_BITS) - 1
                heavy = key >> 1
                n_l = np.cumsum(heavy)[end] - base[owner]
                n1_l = np.cumsum(heavy * (key & 1))[end] - base1[owner]
                gain = _squares(n_l, n1_l) + _squares(n[owner] - n_l, n1[owner] - n1_l) - _squares(n[owner], n1[owner])
                gain = np.floor(gain * _GAIN_UNITS + 0.5)
                heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                most = np.maximum.reduceat(gain, heads)
                equal = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(heads, len(gain)))))
                leading = equal[np.concatenate(([True], owner[equal][1:] != owner[equal][:-1]))]
                of, found = owner[leading], gain[leading]
                better = (found > worth[of]) | ((found == worth[of]) & (drawn[of] < feature[of]))
                of, at = of[better], end[leading[better]]
                worth[of], feature[of] = found[better], drawn[of]
                low[of], high[of] = cell[at] & ((1 << bits) - 1), cell[at + 1] & ((1 << bits) - 1)
            open_rows = feature[node] < 0
            if not open_rows.any():
                break
            rows, node, pair = rows[open_rows], node[open_rows], pair[open_rows]
        return feature, low, high


def _squares(n: np.ndarray, n1: np.ndarray) -> np.ndarray:
    n0 = n - n1
    return (n1 * n1 + n0 * n0) / n


def tree_shares(
    table: Table, weight: np.ndarray, held: np.ndarray, seed: int, stops: Sequence[tuple[int | None, int]], features: int, orders: np.ndarray
) -> np.ndarray | None:
    """Shares of responders, ``[stop, row]``, where rows of ``held[feature, row]`` stop in one tree; ``stops``: depth and least split."""
    deepest = None if any(d is None for d, _ in stops) else max(d for d, _ in stops)
    least = min(m for _, m in stops)
    rows = np.flatnonzero(weight)
    if not len(rows):
        return None
    pair = (weight[rows].astype(np.int64) << 1) | table.y[rows]
    node, paths = np.zeros(len(rows), np.int64), np.zeros((1, 0), np.uint8)
    shares = np.full((len(stops), held.shape[1]), np.nan)
    walking, at = np.arange(held.shape[1]), np.zeros(held.shape[1], np.int64)
    depth, live = 0, list(range(len(stops)))
    while len(walking):
        count = len(paths)
        heavy = pair >> 1
        n, n1 = np.bincount(node, heavy, count), np.bincount(node, heavy * (pair & 1), count)
        tried = (n1 > 0) & (n1 < n) & (n >= least) & (deepest is None or depth < deepest)
        feature, threshold, low = np.full(count, -1), np.zeros(count), np.zeros(count, np.int64)
        if tried.any():
            where, number = np.flatnonzero(tried), np.cumsum(tried) - 1
            mine = np.flatnonzero(tried[node])
            order = orders[_remainder(xxhash64_bytes(paths[where], seed))]
            found, below, above = table.best_cuts(rows[mine], number[node[mine]], pair[mine], order, features)
            feature[where], low[where] = found, below
            for f in range(len(table.values)):
                cut = np.flatnonzero(found == f)
                if len(cut):
                    v, following = table.values[f][below[cut]], table.values[f][above[cut]]
                    middle = (v + following) / 2
                    threshold[where[cut]] = np.where(middle < following, middle, v)
        leaf, share = feature < 0, n1 / n
        waiting = np.zeros(len(walking), bool)
        for j in live:
            limit, split = stops[j]
            unset = np.isnan(shares[j, walking])
            stopping = unset & (leaf | (n < split) | (limit is not None and limit <= depth))[at]
            shares[j, walking[stopping]] = share[at[stopping]]
            waiting |= unset & ~stopping
        live = [j for j in live if stops[j][0] is None or stops[j][0] > depth]
        going = np.flatnonzero(waiting)
        walking, at = walking[going], at[going]
        child = 2 * at + (held[feature[at], walking] > threshold[at])
        reached = np.zeros(2 * count, bool)
        reached[child] = True
        number = np.cumsum(reached) - 1
        at = number[child]
        inner = np.flatnonzero(~leaf[node])
        rows, pair, node = rows[inner], pair[inner], node[inner]
        below = 2 * node + (table.codes[feature[node], rows] > low[node])
        kept = np.flatnonzero(reached[below])
        rows, pair, node = rows[kept], pair[kept], number[below[kept]]
        children = np.flatnonzero(reached)
        paths = np.concatenate((paths[children >> 1], np.where(children & 1, ord("R"), ord("L")).astype(np.uint8)[:, None]), axis=1)
        depth += 1
    return shares


def _remainder(hashed: np.ndarray) -> np.ndarray:
    """Positive remainder of the signed hash."""
    return np.mod(hashed.view(np.int64), _ORDERS)


def fit_sizes(rows: DataFrame) -> list[tuple[object, int, int, int]]:
    """``(fit, hash, rows, odd rows)``; rows without id, label 0 or 1, or a number in every column are odd."""
    odd = F.col("id").isNull() | F.col("y").isNull() | ~F.col("y").isin(0, 1) | F.exists("x", lambda v: v.isNull() | F.isnan(v))
    counted = rows.where("fit IS NOT NULL").groupBy("fit").agg(F.count(F.lit(1)).alias("rows"), F.count_if(odd).alias("odd"))
    found = counted.select("fit", F.xxhash64("fit", F.lit("gini")).alias("hash"), "rows", "odd").collect()  # one row per fit
    return sorted((tuple(r) for r in found), key=lambda r: str(r[0]))


def held_out_sums(rows: DataFrame, fits: Sequence[tuple[object, int]], stops: Sequence[tuple[int | None, int]], sizes: Sequence[int], features: int) -> DataFrame:
    """``(fit, id, y, sums, counts)`` of rows with ``w`` 0: per ascending size of ``sizes`` the trees from the size before it on, how many
    they are (``counts``), and their shares' total per stop in units of 2**-52 (``sums[size * stops + stop]``).

    ``rows``: ``(fit, id, y, w, x)`` without odd ones; ``fits``: every fit with its hash.
    """
    import pyarrow as pa

    trees, width = max(sizes), len(TRANSFORMED_FEATURES)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    batches = min(trees, -(-_TASKS_PER_CORE * cores // len(fits)))
    bounds = [trees * b // batches for b in range(batches + 1)]
    hashes, stops, sizes = [h for _, h in fits], list(stops), sorted(set(sizes))

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            slot, ids, y, w, *x = (c.to_numpy() for c in part.columns)
            for k in np.unique(slot):
                for learning in (True, False):
                    mine = np.flatnonzero((slot == k) & ((w > 0) == learning))
                    if not len(mine):
                        continue
                    held = pa.array([b"" if learning else ids[mine].tobytes()], pa.binary())
                    columns = np.stack([c[mine] for c in x]).astype(float).tobytes()
                    drawn = drawn_of(ids)[:, mine].tobytes() if learning else b""
                    made = [pa.array([int(k)], pa.int32()), pa.array([len(mine)], pa.int32()), pa.array([learning]), held]
                    made += [pa.array([v], pa.binary()) for v in (y[mine].astype(np.uint8).tobytes(), columns, drawn)]
                    yield pa.RecordBatch.from_arrays(made, ["slot", "n", "learning", "ids", "y", "x", "drawn"])
            memory.clear()

    memory: dict[str, np.ndarray] = {}

    def drawn_of(ids: np.ndarray) -> np.ndarray:
        """Weights of a batch's rows; a row's copies for further fits follow each other and are drawn once."""
        if "drawn" not in memory:
            fresh = np.concatenate(([True], ids[1:] != ids[:-1]))
            memory["drawn"] = bootstrap_weights(ids[fresh], trees)[:, np.cumsum(fresh) - 1]
        return memory["drawn"]

    def grown(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[tuple[int, int], list[dict]] = {}
        for part in parts:
            for block in part.to_pylist():
                blocks.setdefault((block["slot"], block["batch"]), []).append(block)
        for (slot, batch), found in blocks.items():
            yield from answered(slot, batch, found)

    def answered(slot: int, batch: int, found: list[dict]) -> Iterator[pa.RecordBatch]:
        learned, rest = ([b for b in found if b["learning"] == kind] for kind in (True, False))
        if not learned or not rest:
            return
        first, last = bounds[batch], bounds[batch + 1]
        joined = lambda blocks, name, kind: [np.frombuffer(b[name], kind).reshape(-1, b["n"]) for b in blocks]
        x = joined(learned, "x", float)
        table = Table.of([np.concatenate([b[f] for b in x]) for f in range(width)], np.concatenate(joined(learned, "y", np.uint8), axis=1)[0])
        weights = np.concatenate(joined(learned, "drawn", np.uint8), axis=1)
        held = np.concatenate(joined(rest, "x", float), axis=1)
        orders = np.array(feature_orders())
        sums, counts = np.zeros((len(sizes), len(stops), held.shape[1]), np.int64), np.zeros(len(sizes), np.int64)
        for tree in range(first, last):
            seed = xxhash64_int(np.array([tree]), np.array([hashes[slot]], np.int64).view(np.uint64))[0]
            shares = tree_shares(table, weights[tree - first], held, seed, stops, features, orders)
            if shares is not None:
                k = int(np.searchsorted(sizes, tree, side="right"))
                sums[k] += np.rint(shares * UNIT).astype(np.int64)
                counts[k] += 1
        ids, y = (np.concatenate(joined(rest, name, kind), axis=1)[0] for name, kind in (("ids", np.int64), ("y", np.uint8)))
        flat = np.ascontiguousarray(sums.reshape(-1, held.shape[1]).T)
        for at in range(0, len(ids), _ROWS_OUT):
            cut = slice(at, at + _ROWS_OUT)
            n = len(ids[cut])
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), v.shape[1]).cast(pa.list_(pa.int64())) for v in (flat[cut], np.tile(counts, (n, 1)))]
            made = [pa.array(np.full(n, slot), pa.int32()), pa.array(ids[cut]), pa.array(y[cut].astype(np.int32)), *lists]
            yield pa.RecordBatch.from_arrays(made, ["slot", "id", "y", "sums", "counts"])

    named = F.array(*[F.lit(f) for f, _ in fits])
    plain = rows.where("fit IS NOT NULL").select(
        (F.array_position(named, F.col("fit")) - 1).cast("int").alias("slot"), F.col("id").cast("bigint"), "y", "w", *[F.col("x")[i].alias(f"x{i}") for i in range(width)]
    )
    blocks = plain.mapInArrow(pack, "slot int, n int, learning boolean, ids binary, y binary, x binary, drawn binary")
    edges = F.array(*[F.lit(b) for b in bounds])
    dealt = blocks.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    start, stop = F.element_at(edges, F.col("batch") + 1), F.element_at(edges, F.col("batch") + 2)
    dealt = dealt.withColumn("drawn", F.substring("drawn", start * F.col("n") + 1, (stop - start) * F.col("n")))
    dealt = dealt.repartitionById(len(fits) * batches, F.col("slot") * batches + F.col("batch"))
    answers = dealt.mapInArrow(grown, "slot int, id bigint, y int, sums array<bigint>, counts array<bigint>")
    total = lambda name, size: F.array(*[F.sum(F.col(name)[i]) for i in range(size)]).alias(name)
    added = answers.groupBy("slot", "id", "y").agg(total("sums", len(sizes) * len(stops)), total("counts", len(sizes)))
    return added.select(F.element_at(named, F.col("slot") + 1).alias("fit"), "id", "y", "sums", "counts")
