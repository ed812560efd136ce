"""Near-duplicates by 64-bit SimHash, compared bit-sliced, as connected groups.

Fingerprints are made per document from all its word shingles. Distinct fingerprints meet where enough
bit bands agree: with ``b`` bands and radius ``r``, two fingerprints within the radius agree in at least
``b - r`` bands, so one key per choice of ``b - r`` bands finds every pair. Within a key the fingerprints'
bit planes are stored vertically, 64 of them to a machine word; carry-save counters add up the differing
bits of a query against a whole word at once, and a word is abandoned as soon as all its lanes exceed the
radius. Links become a spanning forest inside the task, and groups by alternating large-star and small-star
steps over stored tables.

Defined results: a null or empty text, or one without words, has fingerprint zero and links like any other;
repeated rows share a fingerprint; a missing ``doc_id`` never names a group (a group of such rows alone has a null id);
an empty table gives an empty result; other columns are ignored.

Scale: texts are read once and not shuffled. Copies collapse to one fingerprint before any comparison. The number
of bands follows the number of distinct fingerprints, so keys stay small; a key with more than ``BLOCK``
fingerprints is cut into blocks, and every pair of blocks is a cell of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from campaignlens.llm.common import Workspace, text_bytes

SHINGLE_WORDS = 4
SEED = 42
BITS = 64
RADIUS = 4
BLOCK = 4096
_KEY_TARGET = 256
_SHINGLES_AT_ONCE = 1 << 16
_PAIRS_AT_ONCE = 1 << 17


def fingerprint(text: bytes, width: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of the whole text: bit i is set if it is set in over half of the shingle hashes."""
    import xxhash

    words = text.lower().split()  # bytes: lower-cases A-Z and splits at ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    ends -= 1
    n = max(1, len(words) - width + 1)
    lows, highs = starts[:n].tolist(), ends[-n:].tolist() if len(words) >= width else [len(joined)]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, _SHINGLES_AT_ONCE):
        spans = zip(lows[at : at + _SHINGLES_AT_ONCE], highs[at : at + _SHINGLES_AT_ONCE], strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[i:j], seed) for i, j in spans], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """The documents (all columns) and ``fp``, the fingerprint as a signed 64-bit number."""
    import pyarrow as pa

    at = docs.columns.index("text")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t, width, seed) for t in text_bytes(batch.column(at))], dtype=np.uint64)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made.view(np.int64))], schema.names)

    schema = T.StructType([*docs.schema.fields, T.StructField("fp", T.LongType())])
    return docs.mapInArrow(sign, schema)


def band_keys(n: int, radius: int = RADIUS) -> list[int]:
    """Bit masks of all choices of bands that must agree, with the fewest bands that keep keys small."""
    bands = radius + 1
    while True:
        edges = [round(i * BITS / bands) for i in range(bands + 1)]
        masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
        chosen = bands - radius
        if n >> (BITS * chosen // bands) <= _KEY_TARGET or bands == 2 * radius:
            return [sum(c) for c in combinations(masks, chosen)]
        bands += 1


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(distinct: DataFrame, masks: list[int]) -> DataFrame:
    """Each fingerprint under each of its keys, and under each pair of blocks where a key is crowded."""
    keys = [F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for i, m in enumerate(masks)]
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.band", "key.bits")
    crowded = keyed.groupBy("band", "bits").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    crowded = crowded.select("band", "bits", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    split = keyed.join(crowded, ["band", "bits"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    cells = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    alone = F.array(F.struct(F.lit(0).cast("bigint").alias("i"), F.lit(0).cast("bigint").alias("j")))
    split = split.withColumn("cell", F.explode(F.when(F.col("blocks").isNull(), alone).otherwise(cells)))
    return split.select("band", "bits", "cell.i", "cell.j", "fp")


def near_pairs(values: np.ndarray, groups: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of values of the same group within the radius, by bit-sliced counting.

    ``groups`` is sorted. Planes hold bit p of 64 values in one word; a query meets the words
    that hold its group. Lanes outside the group or not after the query are dead from the start.
    """
    n = len(values)
    words = -(-n // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[:n] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)
    ends = np.searchsorted(groups, groups, side="right")
    first_word = (np.arange(n) + 1) // 64
    last_word = (ends - 1) // 64
    spans = np.where(np.arange(n) + 1 < ends, last_word - first_word + 1, 0)
    order = np.argsort(-(bits[:n].mean(axis=0) * (1 - bits[:n].mean(axis=0)))) if n else np.arange(64)
    totals = np.cumsum(spans)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(totals, (totals[at - 1] if at else 0) + _PAIRS_AT_ONCE)))
        query = np.repeat(np.arange(at, stop), spans[at:stop])
        if len(query):
            begin = np.repeat(np.cumsum(spans[at:stop]) - spans[at:stop], spans[at:stop])
            word = first_word[query] + np.arange(len(query)) - begin
            yield from _compare(planes, bits, order, query, word, ends, radius)
        at = stop


def _lanes(low: np.ndarray) -> np.ndarray:
    """Words whose bits from ``low`` (0 to 64) on are set."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    return np.where(low >= 64, np.uint64(0), full << np.minimum(low, 63).astype(np.uint64))


def _compare(planes, bits, order, query, word, ends, radius):
    base = word * 64
    alive = _lanes(np.clip(query + 1 - base, 0, 64)) & ~_lanes(np.clip(ends[query] - base, 0, 64))
    depth = int(radius).bit_length() + 1
    start = (1 << (depth - 1)) - 1 - radius  # counters begin so that radius + 1 differences reach the top bit
    counters = [np.full(len(query), np.uint64(0xFFFFFFFFFFFFFFFF) if start >> k & 1 else np.uint64(0)) for k in range(depth)]
    for step, plane in enumerate(order.tolist()):
        flip = np.where(bits[query, plane] == 1, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
        carry = planes[plane][word] ^ flip
        for k in range(depth - 1):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        counters[-1] |= carry
        if step % 4 == 3:
            left = (alive & ~counters[-1]) != 0
            if not left.any():
                return
            if left.mean() < 0.75:
                query, word, alive = query[left], word[left], alive[left]
                counters = [c[left] for c in counters]
    near = alive & ~counters[-1]
    hit = np.flatnonzero(near)
    lanes = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(lanes)
    if len(row):
        yield query[hit[row]], word[hit[row]] * 64 + lane


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable from each of n indices, by hooking and pointer jumping."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            np.minimum.at(label, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label = jumped
    return label


def links(distinct: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` with a > b that connect exactly the fingerprints within the radius of each other."""
    import pyarrow as pa

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    cell = ["band", "bits", "i", "j"]

    def connect(table: pa.Table) -> pa.RecordBatch:
        values = table.column("fp").to_numpy()
        change = np.zeros(len(values), bool)
        for name in cell:
            column = table.column(name).to_numpy()
            change[1:] |= column[1:] != column[:-1]
        label = forest(len(values), near_pairs(values.view(np.uint64), np.cumsum(change), radius))
        moved = label != np.arange(len(values))
        found = np.unique(np.sort(np.stack([values[moved], values[label[moved]]], axis=1), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 1]), pa.array(found[:, 0])], schema.names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # all rows before the last cell that starts in this batch are whole cells
            start = 0
            same = np.ones(batch.num_rows, bool)
            for name in cell:
                column = batch.column(name).to_numpy()
                same &= column == column[-1]
            if not same.all():
                start = batch.num_rows - int(np.argmin(same[::-1]))
            if start or (held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in cell)):
                held.append(batch.slice(0, start))
                yield connect(pa.Table.from_batches(held).combine_chunks())
                held = []
            held.append(batch.slice(start))
        if held:
            yield connect(pa.Table.from_batches(held).combine_chunks())

    cells = _keyed(distinct, band_keys(n, radius))
    dealt = cells.repartition(*cell).sortWithinPartitions(*cell, "fp")
    return dealt.mapInArrow(compare, schema).distinct()


def components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """``(fp, root)`` for every fingerprint with a link: the smallest one reachable.

    Alternating large-star and small-star steps; each is a partial minimum per node and one join, so
    a node with many neighbours is split like any hot key. Ends when a round changes nothing.
    """

    def state(pairs: DataFrame) -> tuple:
        total = F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))
        return tuple(pairs.agg(F.count(F.lit(1)), total).first())

    edges = workspace.table(edges, "links")
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(down, F.col("a") == F.col("u"))
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = workspace.table(small.select("e.a", "e.b").filter("a > b").distinct(), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))


def groups(signed: DataFrame, workspace: Workspace, radius: int = RADIUS) -> DataFrame:
    """``(fp, component_id)`` of every fingerprint of a stored table ``(doc_id, fp, ...)``."""
    distinct = workspace.table(signed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    rooted = components(links(distinct.select("fp"), distinct.count(), radius), workspace)
    placed = distinct.join(rooted, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return placed.join(named, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, workspace: Workspace | None = None) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every document."""
    workspace = workspace or Workspace(docs.sparkSession)
    signed = workspace.table(fingerprints(docs.select("doc_id", "text")).drop("text"), "fingerprints")
    joined = signed.join(groups(signed, workspace, radius), "fp")
    return joined.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_group(docs: DataFrame, radius: int = RADIUS, workspace: Workspace | None = None) -> DataFrame:
    """The documents without near-duplicates: of each group the first row with the smallest id stays.

    Rows are numbered in a stored table; only that number, the id and the fingerprint take part
    until the winners are known, so texts move once.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    record = F.struct(*[docs[c] for c in docs.columns]).alias("record")
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_number"), record)
    signed = workspace.table(fingerprints(numbered).select("doc_id", "fp", "row_number", "record"), "fingerprints")
    members = signed.select("fp", "doc_id", "row_number").join(groups(signed, workspace, radius), "fp")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row_number")
    winners = members.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("nameless")).agg(
        F.min(rank).alias("rank")
    )
    winners = winners.select(F.col("rank.row_number").alias("winner"))
    return signed.join(winners, F.col("row_number") == F.col("winner"), "left_semi").select("record.*")
