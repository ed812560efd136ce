"""Quality rules: surface counts per text and the perplexity of its words under a character n-gram model.

The model is an interpolated modified Kneser-Ney model of the bytes of lower-cased words between boundaries, counted
in Spark over all texts and stored in sorted hash arrays in the shared folder. A word's probability depends on
the word alone, so every distinct word is scored once and stored the same way; a text's is looked up and added. Perplexity is per byte. Each
language has its own lower and upper limit, from the quartiles of its distinct texts' log perplexities; texts outside
are rejected.

Defined results: a null or empty text has no words and fails the base rules; texts with a null language form
one group; repeated rows count each time in the model and once in the limits; an empty table gives an empty result; other columns are ignored.

Scale: words are counted per task and summed by Spark, n-grams are counted over distinct words, and scoring is one pass without a shuffle. Quartiles are
mergeable sketches per language over one value per text hash, so a language or a text may hold any share of the rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from campaignlens.llm.common import Workspace, text_bytes, write_array
from campaignlens.llm.kneser_ney import WordHashes, discounted, discounts, look_up, pair_hash, shard_of

ORDER = 5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Limits in quartile distances from the median of the language's log perplexities, below and above. Of the labelled texts of sf0.1 that
#: pass the base rules they keep 99.5% of the good and 52% of the bad ones (8 and 8: 99.9% and 76%; 4 and 4: 96.6% and 24%).
BAND_BELOW = 6.0
BAND_ABOVE = 6.0
#: A quartile distance counts as this much at least: those of sf0.1 lie between 0.0049 and 0.0118.
LEAST_DISTANCE = 0.004
_WORDS_AT_ONCE = 400_000
_ROWS_PER_SHARD = 8_000_000
_CACHED_WORDS = 600_000
_SPACE = 0x20


def _grams(words: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every byte after the opening boundary: gram length, gram code and word number, by position.

    A gram ends at the byte and starts at most ``order - 1`` bytes before; near the boundary it starts there.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    flat = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    number = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(flat)) - starts[number]
    code = np.zeros(len(flat), np.uint64)
    for back in range(order - 1, -1, -1):
        usable = place >= back
        shifted = np.zeros(len(flat), np.uint64)
        shifted[back:] = flat[: len(flat) - back] if back else flat
        code = np.where(usable, (code << np.uint64(8)) | shifted, code)
    keep = place > 0
    yield np.minimum(place + 1, order)[keep], code[keep], number[keep]


@dataclass(frozen=True)
class CharModel:
    """Where the arrays of every order are, and the totals."""

    location: str
    order: int
    shards: tuple[int, ...]
    discounts: tuple[tuple[float, float, float], ...]
    unigrams: int
    types: int
    word_shards: int


def _gram_hash(codes: np.ndarray) -> np.ndarray:
    return pair_hash(codes, np.full(len(codes), 77, np.uint64))


def word_table(texts: DataFrame) -> DataFrame:
    """``(word, times)``: lower-cased words of all texts as bytes, counted per task and then by Spark."""
    import pyarrow as pa

    def packed(words: Counter) -> pa.RecordBatch:
        made = [pa.array(words.keys(), pa.binary()), pa.array(words.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(made, ["word", "times"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in batches:
            for value in text_bytes(batch.column(0)):
                words.update(value.lower().split())
                if len(words) >= _WORDS_AT_ONCE:
                    yield packed(words)
                    words = Counter()
        if words:
            yield packed(words)

    return texts.mapInArrow(count, "word binary, times bigint").groupBy("word").agg(F.sum("times").alias("times"))


def _gram_counts(words: DataFrame, order: int) -> DataFrame:
    """``(n, code, count)``: grams of all words of a :func:`word_table`, summed per batch and then by Spark."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            times = batch.column(1).to_numpy()
            for lengths, codes, number in _grams(batch.column(0).to_pylist(), order):
                key = np.stack([lengths.astype(np.uint64), codes])
                sort = np.lexsort((key[1], key[0]))
                key, weights = key[:, sort], times[number][sort]
                firsts = np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0))))
                totals = np.add.reduceat(weights, firsts)
                made = [pa.array(key[0, firsts].astype(np.int32)), pa.array(key[1, firsts].view(np.int64)), pa.array(totals)]
                yield pa.RecordBatch.from_arrays(made, ["n", "code", "count"])

    schema = "n int, code bigint, count bigint"
    return words.mapInArrow(count, schema).groupBy("n", "code").agg(F.sum("count").alias("count"))


def train(docs: DataFrame, workspace: Workspace, order: int = ORDER) -> CharModel:
    """Counts all words of ``docs.text``, stores grams and contexts of every order, and every word's own probability."""
    words = workspace.table(word_table(docs.select(F.col("text").cast("string").alias("text"))), "words")
    raw = workspace.table(_gram_counts(words, order), "grams")
    level = raw.filter(F.col("n") == order).select("code", "count")
    shards, found_discounts = [], []
    unigrams = types = 0
    location = workspace.path("characters")
    for n in range(order, 0, -1):
        stored = workspace.table(level, f"order{n}")
        seen = [F.count(F.when(F.col("count") == k, 1)).alias(f"n{k}") for k in range(1, 5)]
        row = stored.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("count"), F.lit(0)).alias("sum"), *seen).first()
        number = max(1, -(-row["rows"] // _ROWS_PER_SHARD))
        shards.insert(0, number)
        found_discounts.insert(0, discounts([row[f"n{k}"] for k in range(1, 5)]))
        prefix = F.shiftright("code", 8)
        contexts = stored.groupBy(prefix.alias("code")).agg(
            F.sum("count").alias("total"), *[F.count(F.when(c, 1)).alias(a) for a, c in (("once", F.col("count") == 1), ("twice", F.col("count") == 2), ("more", F.col("count") > 2))]
        )
        _store(stored, f"{location}/grams{n}", ("count",), number)
        _store(contexts, f"{location}/contexts{n}", ("total", "once", "twice", "more"), number)
        if n == 1:
            unigrams, types = row["sum"], row["rows"]
            break
        suffix = F.col("code").bitwiseAND(F.lit((1 << (8 * (n - 1))) - 1))
        lower = stored.groupBy(suffix.alias("code")).agg(F.count(F.lit(1)).alias("count"))
        # grams at the opening boundary have nothing to their left: they keep their raw counts
        level = lower.union(raw.filter(F.col("n") == n - 1).select("code", "count"))
    word_shards = max(1, -(-words.count() // _ROWS_PER_SHARD))
    model = CharModel(location, order, tuple(shards), tuple(found_discounts), unigrams, types, word_shards)
    _store_word_logs(words, model)
    return model


def _store_word_logs(words: DataFrame, model: CharModel) -> None:
    """Sorted hash arrays of the log probabilities of all counted words, each scored once."""
    import pyarrow as pa

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column(0).to_pylist()
            if some:
                hashes = word_hashes(some)
                made = [pa.array(shard_of(hashes, model.word_shards).astype(np.int32)), pa.array(hashes.view(np.int64)), pa.array(word_logs(model, some))]
                yield pa.RecordBatch.from_arrays(made, ["shard", "hash", "log"])

    def write(key: tuple, table: pa.Table) -> pa.Table:
        hashes = table.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        write_array(f"{model.location}/words-hash-{key[0].as_py()}", hashes[order])
        write_array(f"{model.location}/words-log-{key[0].as_py()}", table.column("log").to_numpy()[order])
        return pa.table({"rows": pa.array([len(order)], pa.int64())})

    scored = words.select("word").mapInArrow(score, "shard int, hash bigint, log double")
    scored.groupBy("shard").applyInArrow(write, "rows bigint").agg(F.sum("rows")).first()


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w, 11) for w in words), np.uint64, len(words))


def _store(rows: DataFrame, location: str, names: tuple[str, ...], shards: int) -> None:
    """Sorted hash arrays of ``code`` and its values, one set of files per shard."""
    import pyarrow as pa

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = _gram_hash(batch.column(0).to_numpy().view(np.uint64))
            made = [pa.array(shard_of(hashes, shards).astype(np.int32)), pa.array(hashes.view(np.int64)), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(made, ["shard", "hash", *names])

    def write(key: tuple, table: pa.Table) -> pa.Table:
        hashes = table.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        write_array(f"{location}-hash-{key[0].as_py()}", hashes[order])
        for name in names:
            write_array(f"{location}-{name}-{key[0].as_py()}", table.column(name).to_numpy()[order])
        return pa.table({"rows": pa.array([len(order)], pa.int64())})

    dealt = rows.select("code", *names).mapInArrow(deal, "shard int, hash bigint, " + ", ".join(f"{n} bigint" for n in names))
    dealt.groupBy("shard").applyInArrow(write, "rows bigint").agg(F.sum("rows")).first()


def _looked_up(location: str, codes: np.ndarray, names: tuple[str, ...], shards: int) -> list[np.ndarray]:
    hashes, at = np.unique(_gram_hash(codes), return_inverse=True)
    folder, _, table = location.rpartition("/")
    found = look_up(folder, f"{table}-hash", {f"{table}-{n}": np.int64 for n in names}, shards, hashes)
    return [column[at] for column in found]


def word_logs(model: CharModel, words: list[bytes]) -> np.ndarray:
    """Log10 probability of each word's bytes and closing boundary."""
    for lengths, codes, number in _grams(words, model.order):
        p = np.full(len(codes), 1.0 / (model.types + 1))
        for n in range(1, model.order + 1):
            rows = np.flatnonzero(lengths >= n)
            gram = codes[rows] & np.uint64((1 << (8 * n)) - 1)
            (count,) = _looked_up(f"{model.location}/grams{n}", gram, ("count",), model.shards[n - 1])
            total, once, twice, more = _looked_up(
                f"{model.location}/contexts{n}", gram >> np.uint64(8), ("total", "once", "twice", "more"), model.shards[n - 1]
            )
            d = model.discounts[n - 1]
            seen = np.maximum(total, 1)
            mass = np.where(total > 0, (d[0] * once + d[1] * twice + d[2] * more) / seen, 1.0)
            p[rows] = discounted(count, d) / seen + mass * p[rows]
        return np.bincount(number, np.log10(p), len(words))


class WordScores(dict):
    """Log probabilities of words, remembered per worker for one model."""

    model: CharModel | None = None

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > _CACHED_WORDS:
            self.clear()
            new = list(words)
        if not new:
            return
        hashes, at = np.unique(word_hashes(new), return_inverse=True)
        (found,) = look_up(self.model.location, "words-hash", {"words-log": np.int64}, self.model.word_shards, hashes)
        logs = found.view(np.float64)[at]
        unseen = np.flatnonzero(logs == 0)  # words that weren't counted; a stored probability is below one
        if len(unseen):
            logs[unseen] = word_logs(self.model, [new[i] for i in unseen])
        self.update(zip(new, logs.tolist(), strict=True))


_SCORES = WordScores()
_HASHES = WordHashes()


def repeated_words(hashes: np.ndarray) -> int:
    """Number of words inside any 3-word window that occurs twice or more."""
    if len(hashes) < 4:
        return 0
    windows = pair_hash(pair_hash(hashes[:-2], hashes[1:-1]), hashes[2:])
    _, at, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[at] > 1
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_SPACES = np.frombuffer(b" \t\n\v\f\r", np.uint8)


def surface(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, duplicate lines, and words in repeated windows."""
    if not words:
        return 0, 0, 0, 0, 0
    bytes_seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text) - bytes_seen[0x80:0xC0].sum() - bytes_seen[_SPACES].sum()
    lines = [line for line in text.split(b"\n") if line.strip()]
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    return len(words), int(chars), int(bytes_seen[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_words(hashes)


METRICS_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("lang", T.StringType()),
        *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        T.StructField("log_perplexity", T.DoubleType()),
        T.StructField("text_hash", T.LongType()),
    ]
)


def measured(docs: DataFrame, model: CharModel) -> DataFrame:
    """Surface counts and the log10 perplexity per byte of every whole text."""
    import pyarrow as pa
    import xxhash

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _SCORES.model != model:
            _SCORES.clear()
            _SCORES.model = model
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = list(text_bytes(batch.column(2)))
                small = [t.lower().split() for t in texts]
                _SCORES.learn(set().union(*small))
                rows = []
                for text, words in zip(texts, small, strict=True):
                    size = sum(map(len, words)) + len(words)
                    total = sum(map(_SCORES.__getitem__, words))
                    rows.append((*surface(text, text.split()), -total / size if size else None, xxhash.xxh64_intdigest(text, 5) - (1 << 63)))
                columns = zip(*rows, strict=True)
                kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64()]
                made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], METRICS_SCHEMA.names)

    return docs.select("doc_id", F.col("lang").cast("string"), F.col("text").cast("string")).mapInArrow(measure, METRICS_SCHEMA)


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def bands(metrics: DataFrame, below: float = BAND_BELOW, above: float = BAND_ABOVE) -> DataFrame:
    """``(band_lang, low, high)``: limits of the log perplexity per language, from distinct texts that pass the base rules."""
    quartiles = F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10000).alias("q")
    distinct = metrics.filter(~base_failed()).groupBy(F.col("lang").alias("band_lang"), "text_hash").agg(F.min("log_perplexity").alias("log_perplexity"))
    by_lang = distinct.groupBy("band_lang").agg(quartiles)
    q1, q2, q3 = (F.col("q")[i] for i in range(3))
    down, up = (F.greatest(d, F.lit(LEAST_DISTANCE)) for d in (q2 - q1, q3 - q2))
    return by_lang.select("band_lang", (q2 - down * below).alias("low"), (q2 + up * above).alias("high"))


def judged(docs: DataFrame, workspace: Workspace | None = None, order: int = ORDER) -> DataFrame:
    """Per document: the counts, ``base_failed``, ``log_perplexity``, its language's limits and ``kept``."""
    workspace = workspace or Workspace(docs.sparkSession)
    model = train(docs, workspace, order)
    metrics = workspace.table(measured(docs, model), "metrics")
    limits = workspace.table(bands(metrics), "bands")
    joined = metrics.join(limits, F.col("lang").eqNullSafe(F.col("band_lang")), "left")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & inside).drop("band_lang", "text_hash")
