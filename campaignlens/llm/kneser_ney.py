"""Interpolated modified Kneser-Ney bigram model of words, for text probabilities and perplexity.

Every map task counts the word pairs of its texts and sends each shard one block of sorted pairs; a shard owns
all occurrences of its pairs, adds them up and stores sorted hash arrays in the shared folder: 64-bit pair
hashes and counts. What a shard knows about a word (as a token, as a continuation, as a context) goes to that word's
shard, which stores the sums the same way. Scoring tasks memory-map the arrays and look up sorted batches.

Token counts, vocabulary and base scores are exact up to collisions of 64-bit hashes.

Defined results: a null or empty text is the end token alone; a missing id belongs to no held-out fold; repeated rows
count and score each time; without training rows every token has probability one; an empty table gives an
empty result; other columns are ignored.

Scale: the model grows with the corpus, so nothing of it is broadcast or gathered; the shard count follows the bytes
of training text, and a shard's memory is bounded by ``PAIRS_PER_SHARD`` tokens. Pairs are dealt by their hash, so
frequent words spread over all shards. Recomputed tasks write the same files again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from campaignlens.llm.common import Workspace, map_array, text_bytes, write_array

PAIRS_PER_SHARD = 4_000_000
BYTES_PER_TOKEN = 6
_TOKENS_AT_ONCE = 3_000_000
_SCORED_AT_ONCE = 1_000_000
_CACHED_WORDS = 1_000_000
START, END = b" start", b" end"  # words hold no space

_ROLES = ("token", "context", "continuation", "once", "twice", "more")


class WordHashes(dict):
    """64-bit hashes of words, remembered per worker."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word, 9)
        if len(word) <= 48:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


_HASHES = WordHashes()


def token_hashes(text: bytes) -> np.ndarray:
    """Hashes of the lower-cased words of a text and of the end token."""
    words = text.lower().split()
    words.append(END)
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def with_context(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Previous and current hashes of all tokens of several texts; each text begins after the start token."""
    current = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
    previous = np.empty_like(current)
    previous[1:] = current[:-1]
    firsts = np.cumsum([0, *map(len, tokens[:-1])]) if tokens else np.empty(0, np.int64)
    previous[firsts] = _HASHES[START]
    return previous, current


def pair_hash(previous: np.ndarray, current: np.ndarray) -> np.ndarray:
    mixed = previous * np.uint64(0x9E3779B97F4A7C15) ^ (current + (previous << np.uint64(6)) + (previous >> np.uint64(2)))
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard by the leading bits: hashes in order are in order of shards too."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def add_up(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of the columns per key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    firsts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return (keys[firsts], *[np.add.reduceat(c[order], firsts) if len(firsts) else c for c in columns])


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams seen once to four times."""
    n1, n2, n3, n4 = counts
    if not (n1 and n2 and n3 and n4):
        return 0.5, 0.75, 1.0  # too little text to estimate
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k) for k, d in enumerate(raw, start=1))


def discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """Counts less their discount; zero stays zero."""
    less = np.array((0.0, *d))[np.minimum(counts, 3)]
    return np.maximum(counts - less, 0.0)


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the totals."""

    location: str
    pair_shards: int
    word_shards: int
    tokens: int
    types: int
    pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_mass: float


_SENT = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("block", T.BinaryType())])
_STATS = ("tokens", "types", "pairs", *(f"p{k}" for k in range(1, 5)), *(f"w{k}" for k in range(1, 5)), "w_more")


def _blocks(shards: np.ndarray, count: int, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """One block per shard that has rows: the rows' columns one after another."""
    order = np.argsort(shards.astype(np.uint32), kind="stable")
    edges = np.searchsorted(shards[order], np.arange(count + 1, dtype=np.uint64))
    for shard in np.flatnonzero(np.diff(edges)).tolist():
        rows = order[edges[shard] : edges[shard + 1]]
        yield shard, b"".join(c[rows].tobytes() for c in columns)


def _unpacked(table, dtypes: list) -> list[np.ndarray]:
    """Columns of all blocks of a shard."""
    width = sum(np.dtype(d).itemsize for d in dtypes)
    columns: list[list[np.ndarray]] = [[] for _ in dtypes]
    for value in table.column("block"):
        data = value.as_buffer()
        rows, at = len(data) // width, 0
        for column, dtype in zip(columns, dtypes, strict=True):
            column.append(np.frombuffer(data, dtype, rows, at))
            at += rows * np.dtype(dtype).itemsize
    return [np.concatenate(c) if c else np.empty(0, d) for c, d in zip(columns, dtypes, strict=True)]


def train(training: DataFrame, workspace: Workspace, pairs_per_shard: int = PAIRS_PER_SHARD) -> Model:
    """Counts the pairs of ``training.text`` and stores the model's arrays in the workspace."""
    import pyarrow as pa

    text = training.select(F.col("text").cast("string").alias("text"))
    size = text.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(8)), F.lit(0))).first()[0]
    shards = max(1, -(-size // (BYTES_PER_TOKEN * pairs_per_shard)))
    word_shards = max(1, shards // 2)
    location = workspace.path("kneser-ney")

    def counted(previous: np.ndarray, current: np.ndarray) -> list[np.ndarray]:
        order = np.lexsort((current, previous))  # by context: its hash repeats, which compresses well
        previous, current = previous[order], current[order]
        new = np.concatenate(([True], (previous[1:] != previous[:-1]) | (current[1:] != current[:-1])))
        firsts = np.flatnonzero(new)
        return [previous[firsts], current[firsts], np.diff(np.append(firsts, len(order))).astype(np.uint32)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def sent() -> pa.RecordBatch:
            columns = counted(*with_context(held))
            rows = list(_blocks(shard_of(pair_hash(columns[0], columns[1]), shards), shards, columns))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary()))], _SENT.names)

        for batch in batches:
            for value in text_bytes(batch.column(0)):
                held.append(token_hashes(value))
                n += len(held[-1])
                if n >= _TOKENS_AT_ONCE:
                    yield sent()
                    held, n = [], 0
        if held:
            yield sent()

    role_types = [np.uint64, *[np.int64] * len(_ROLES)]
    told_schema = T.StructType([*_SENT.fields, *[T.StructField(f"p{k}", T.LongType()) for k in range(1, 5)]])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        previous, current, counts = _unpacked(table, [np.uint64, np.uint64, np.uint32])
        hashes = pair_hash(previous, current)
        order = np.argsort(hashes, kind="stable")
        firsts = np.flatnonzero(np.concatenate(([True], hashes[order][1:] != hashes[order][:-1])))
        hashes, counts = hashes[order][firsts], np.add.reduceat(counts[order].astype(np.int64), firsts)
        previous, current = previous[order][firsts], current[order][firsts]
        write_array(f"{location}/pairs-{shard}", hashes)
        write_array(f"{location}/counts-{shard}", np.minimum(counts, 0xFFFFFFFF).astype(np.uint32))
        none = np.zeros(len(counts), np.int64)
        as_word = add_up(current, counts, none, none + 1, none, none, none)
        as_context = add_up(previous, none, counts, none, *[(m).astype(np.int64) for m in (counts == 1, counts == 2, counts > 2)])
        words = add_up(*[np.concatenate(c) for c in zip(as_word, as_context, strict=True)])
        rows = list(_blocks(shard_of(words[0], word_shards), word_shards, list(words)))
        seen = [int((counts == k).sum()) for k in range(1, 5)]
        first = [[s if i == 0 else 0 for i in range(len(rows))] for s in seen]
        columns = [[r[0] for r in rows], [r[1] for r in rows], *first]
        kinds = [pa.int32(), pa.binary(), *[pa.int64()] * 4]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=told_schema.names)

    def merge_words(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        words = add_up(*_unpacked(table, role_types))
        write_array(f"{location}/words-{shard}", words[0])
        for name, column in zip(_ROLES, words[1:], strict=True):
            write_array(f"{location}/{name}-{shard}", column)
        token, continuation = words[1], words[3]
        stats = [token.sum(), (token > 0).sum(), continuation.sum(), *[sum(table.column(f"p{k}").to_pylist()) for k in range(1, 5)]]
        stats += [*[(continuation == k).sum() for k in range(1, 5)], (continuation > 2).sum()]
        return pa.table([pa.array([int(s)]) for s in stats], names=list(_STATS))

    stats_schema = T.StructType([T.StructField(n, T.LongType()) for n in _STATS])
    sent = text.mapInArrow(count, _SENT)
    told = sent.groupBy("shard").applyInArrow(merge, told_schema)
    stats = told.groupBy("shard").applyInArrow(merge_words, stats_schema)
    row = {k: v or 0 for k, v in stats.agg(*[F.sum(n).alias(n) for n in _STATS]).first().asDict().items()}
    word_d = discounts([row[f"w{k}"] for k in range(1, 5)])
    mass = (word_d[0] * row["w1"] + word_d[1] * row["w2"] + word_d[2] * row["w_more"]) / row["pairs"] if row["pairs"] else 1.0
    pair_d = discounts([row[f"p{k}"] for k in range(1, 5)])
    return Model(location, shards, word_shards, row["tokens"], row["types"], row["pairs"], pair_d, word_d, mass)


_MAPPED: dict[str, np.ndarray] = {}


def _mapped(path: str, dtype) -> np.ndarray:
    if path not in _MAPPED:
        if len(_MAPPED) >= 4096:
            _MAPPED.clear()
        _MAPPED[path] = map_array(path, dtype)
    return _MAPPED[path]


def look_up(location: str, keys_name: str, names: dict[str, object], shards: int, wanted: np.ndarray) -> list[np.ndarray]:
    """Values of sorted, distinct hashes in the stored arrays; zero where a hash isn't stored."""
    out = [np.zeros(len(wanted), np.int64) for _ in names]
    edges = np.searchsorted(shard_of(wanted, shards), np.arange(shards + 1, dtype=np.uint64))
    for shard in np.flatnonzero(np.diff(edges)).tolist():
        part = slice(edges[shard], edges[shard + 1])
        try:
            keys = _mapped(f"{location}/{keys_name}-{shard}", np.uint64)
        except FileNotFoundError:  # no key at all fell into this shard
            continue
        at = np.minimum(np.searchsorted(keys, wanted[part]), max(len(keys) - 1, 0))
        hit = keys[at] == wanted[part] if len(keys) else np.zeros(part.stop - part.start, bool)
        for column, (name, dtype) in zip(out, names.items(), strict=True):
            values = _mapped(f"{location}/{name}-{shard}", dtype)
            column[part][hit] = values[at[hit]]
    return out


def token_scores(model: Model, previous: np.ndarray, current: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: the model's log10 probability, the base log10 probability, and whether it was seen."""
    words, at = np.unique(np.concatenate([current, previous]), return_inverse=True)
    roles = {name: np.int64 for name in _ROLES}
    token, context, continuation, once, twice, more = look_up(model.location, "words", roles, model.word_shards, words)
    at_word, at_context = at[: len(current)], at[len(current) :]
    hashes, at_pair = np.unique(pair_hash(previous, current), return_inverse=True)
    (counts,) = look_up(model.location, "pairs", {"counts": np.uint32}, model.pair_shards, hashes)
    lower = discounted(continuation, model.word_discounts) / max(model.pairs, 1) + model.word_mass / (model.types + 1)
    d1, d2, d3 = model.pair_discounts
    with np.errstate(divide="ignore", invalid="ignore"):
        backoff = np.where(context > 0, (d1 * once + d2 * twice + d3 * more) / context, 1.0)
    direct = discounted(counts, model.pair_discounts)[at_pair] / np.maximum(context, 1)[at_context]
    p = direct + backoff[at_context] * lower[at_word]
    base = (token + 0.5) / (model.tokens + 0.5 * (model.types + 1))
    return np.log10(p), np.log10(base)[at_word], (token > 0)[at_word]


SCORE_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("perplexity", T.DoubleType()),
    ]
)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Log10 probability and perplexity of every whole text of ``(doc_id, text)``."""
    import pyarrow as pa

    def scored(ids: list, tokens: list[np.ndarray]) -> pa.RecordBatch:
        logs, base, known = token_scores(model, *with_context(tokens))
        lengths = np.array([len(t) for t in tokens])
        firsts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        total = np.add.reduceat(logs, firsts)
        columns = [ids, lengths, np.add.reduceat(known.astype(np.int64), firsts), np.add.reduceat(base, firsts), total, 10 ** (-total / lengths)]
        kinds = [pa.int64()] * 3 + [pa.float64()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], SCORE_SCHEMA.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        tokens: list[np.ndarray] = []
        n = 0
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                ids.append(doc_id)
                tokens.append(token_hashes(value))
                n += len(tokens[-1])
                if n >= _SCORED_AT_ONCE:
                    yield scored(ids, tokens)
                    ids, tokens, n = [], [], 0
        if ids:
            yield scored(ids, tokens)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, SCORE_SCHEMA)
