"""Exact top-k inner-product search by MaxScore over integer vectors.

Every component of a query is a term, signed like the query: its postings in a shard are the rows whose
component has that sign, and its bound is the largest contribution there. A row's negative contributions only lower
its score. Terms are sorted by bound; once the k-th best score of a query is known, the longest tail
of terms whose bounds sum to less than it is non-essential: a row that is in no essential posting can't
enter, unless the k-th best score is negative: then every row stays a candidate. Essential postings are traversed first; the other terms are probed in falling order of bound, only for
rows whose partial score plus the bounds still to come stays competitive. Shards give their k best rows per query
and the merge keeps the k best of those.

Queries and rows meet in blocks: every block of queries with every shard of rows, each pair one task group.

Defined results: vectors that are null or hold null or non-finite components, or any of ``LARGEST`` or beyond, take no part, nor do
rows without an id; ids may repeat (every query row is ranked by itself; rows with its id are none of its candidates); ties go to the smaller
id; shorter vectors count as padded with zeros; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from campaignlens.llm.common import Workspace

K = 5
SCALE = 256
QUERY_STEP = 50
QUERY_BLOCK = 512
SHARD_ROWS = 8192
_ROWS_AT_ONCE = 2048
_TERMS_AT_ONCE = 8

#: Components of this magnitude or more could give scores beyond 64 bits.
LARGEST = float(1 << 20)

HIT_SCHEMA = T.StructType(
    [
        T.StructField("query_row", T.LongType()),
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
)


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` with integer components ``floor(scale * x)`` of the vectors that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(LARGEST)))
    whole = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("bigint"))
    return vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite).select("vec_id", whole.alias("v"))


def _matrix(column) -> np.ndarray:
    """Rows of a list column as one zero-padded integer matrix."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    width = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


class Shard:
    """Rows of one shard, sorted by id, with the extremes that bound every term's contribution."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.most = np.maximum(self.rows.max(axis=0, initial=0), 0)
        self.least = np.minimum(self.rows.min(axis=0, initial=0), 0)
        # exact in doubles: |score| <= width * 2**20 * 2**20 stays below 2**53 for components of magnitude below 2**20
        self.exact = np.abs(self.rows).max(initial=0) < 1 << 20
        self.blocks = [slice(i, i + _ROWS_AT_ONCE) for i in range(0, len(self.ids), _ROWS_AT_ONCE)]

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows for one query."""
        bounds = np.maximum(query * self.most, query * self.least)
        terms = np.flatnonzero(query)
        terms = terms[np.argsort(-bounds[terms], kind="stable")]
        groups = [terms[i : i + _TERMS_AT_ONCE] for i in range(0, len(terms), _TERMS_AT_ONCE)]
        to_come = np.append(np.cumsum([bounds[g].sum() for g in groups[::-1]])[::-1], 0) if groups else np.zeros(1, np.int64)
        top_ids, top_scores = np.empty(0, np.int64), np.empty(0, np.int64)
        threshold = None
        weights = query.astype(np.float64) if self.exact and np.abs(query).max(initial=0) < 1 << 20 else query
        for block in self.blocks:
            ids, rows = self.ids[block], self.rows[block]
            candidates = np.flatnonzero(ids != query_id)
            scores = np.zeros(len(candidates), np.int64)
            if threshold is not None:
                # essential terms: those before the tail whose bounds can't reach the threshold by themselves
                essential = int(np.searchsorted(-to_come, -threshold, side="right"))
                if essential == 0:
                    continue
                # below zero even a row outside all postings, whose score is at most zero, may enter
                in_postings = np.full(len(ids), threshold < 0)
                for g in groups[:essential]:
                    if in_postings.all():
                        break
                    in_postings |= ((rows[:, g] > 0) == (query[g] > 0)).any(axis=1)
                candidates = candidates[in_postings[candidates]]
                scores = np.zeros(len(candidates), np.int64)
            for step, g in enumerate(groups):
                part = rows[candidates[:, None], g] if len(candidates) < len(ids) // 2 else rows[:, g][candidates]
                scores += (part @ weights[g]).astype(np.int64)
                if threshold is not None:
                    # the threshold is the k-th best score so far; an equal score comes later, with a larger id
                    open_rows = scores + to_come[step + 1] > threshold
                    if not open_rows.all():
                        candidates, scores = candidates[open_rows], scores[open_rows]
                        if not len(candidates):
                            break
            if len(candidates):
                top_ids = np.concatenate([top_ids, ids[candidates]])
                top_scores = np.concatenate([top_scores, scores])
                best = np.lexsort((top_ids, -top_scores))[:k]
                top_ids, top_scores = top_ids[best], top_scores[best]
                if len(top_ids) == k:
                    threshold = int(top_scores[-1])
        return top_ids, top_scores


def shard_hits(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best rows of every shard for every query, both dealt to ``(shard, block)``."""
    import pyarrow as pa

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            rows, queries = _matrix(left.column("v")), _matrix(right.column("v"))
            width = max(rows.shape[1], queries.shape[1])
            rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
            queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
            shard = Shard(left.column("vec_id").to_numpy(), rows)
            numbers = zip(right.column("query_row").to_pylist(), right.column("vec_id").to_pylist(), strict=True)
            for (row, query_id), query in zip(numbers, queries, strict=True):
                ids, scores = shard.search(query_id, query, k)
                found.append((np.full(len(ids), row), np.full(len(ids), query_id), ids, scores))
        columns = [np.concatenate(c) if found else np.empty(0, np.int64) for c in (zip(*found, strict=True) if found else ((), (), (), ()))]
        return pa.table(dict(zip(HIT_SCHEMA.names, map(pa.array, columns), strict=True)))

    cell = ("shard", "block")
    return rows.groupBy(*cell).cogroup(queries.groupBy(*cell)).applyInArrow(search, HIT_SCHEMA)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    query_block: int = QUERY_BLOCK,
    shard_rows: int = SHARD_ROWS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best other rows for every row that ``is_query`` selects."""
    workspace = workspace or Workspace(vectors.sparkSession)
    rows = workspace.table(quantized(vectors, scale), "vectors")
    queries = rows.filter(is_query)
    n_rows, n_queries = rows.count(), queries.count()
    shards, blocks = max(1, -(-n_rows // shard_rows)), max(1, -(-n_queries // query_block))

    def deal(n: int) -> Column:
        return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("vec_id", "v", deal(shards).alias("shard")).withColumn("block", every(blocks))
    numbered = queries.select("vec_id", "v", F.monotonically_increasing_id().alias("query_row"), deal(blocks).alias("block"))
    right = numbered.withColumn("shard", every(shards))
    hits = shard_hits(left, right, k)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
