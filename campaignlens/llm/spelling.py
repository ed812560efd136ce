"""Spelling variants: words one edit apart, found by pivotal bigrams, and the common form that a rare word stands for.

Words are letter runs of whole texts; some runs lose a letter by rule (``SLIP_EVERY``), which plants misspellings. For a single edit
(``ERRORS`` = 1) a word's bigrams are ordered by rarity: its prefix is the first ``2 * ERRORS + 1`` (and repetitions of the last), its pivots are the
``ERRORS + 1`` disjoint ones of the prefix with the least total frequency, chosen by dynamic programming. An edit
touches at most one of two disjoint bigrams, so of two near words the one whose prefix ends first in the order has a pivot in the
other's prefix. Places limit the lookup further: an edit right of the first pivot leaves the letters up to and with that pivot alone, any other
edit those from the second pivot on, so pivots are looked up among prefixes together with that side of the word, among lengths that
differ by one at most. Candidates are verified by edit distance inside the join.

Defined results: a null or empty text has no words; a missing id counts as an empty one in the rule; repeated rows count each time;
of near words with equal counts the first in code-point order is the form; a word without a much more frequent near word has no
form and is its own root; an empty table gives an empty result; other columns are ignored.

Scale: runs are counted per text and task, then summed by Spark. The only collected and shipped data are bigram counts, at most
90 * 90 for this alphabet. Keys with many prefixes are salted: prefixes spread over salts, pivots meet every
salt, and nothing but verified pairs leaves the join.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
from pyspark.sql import DataFrame, functions as F

from campaignlens.llm.common import Workspace, text_bytes

LETTERS = r"[A-Za-zÀ-ÿ]"
SLIP_EVERY = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
DOMINANCE = 5
GRAM = 2
ERRORS = 1
_WORDS_AT_ONCE = 1_000_000
_SALT_ROWS = 512


def slipped(runs: list[str], seed: int) -> np.ndarray:
    """Checksums of lower-cased runs; ``seed`` is the checksum of the text's id and a colon."""
    return np.fromiter((zlib.crc32(run, seed) for run in map(str.encode, runs)), np.uint32, len(runs))


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of all words that are long and frequent enough.

    Runs that are too short before a letter is lost are too short afterwards, so they are skipped.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    runs = re.compile(f"{LETTERS}{{{LEAST_LETTERS},}}")

    def counted(words: list[str], checks: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.concatenate(checks)
        for at in np.flatnonzero(hashes % SLIP_EVERY == 0):
            cut = int(hashes[at]) % len(words[at])
            words[at] = words[at][:cut] + words[at][cut + 1 :]
        values = pc.value_counts(pa.array(words, pa.string()))
        return pa.RecordBatch.from_arrays([values.field("values"), values.field("counts")], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[str] = []
        checks: list[np.ndarray] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                found = runs.findall(text.lower().decode())  # of bytes, so only A-Z
                words += found
                checks.append(slipped(found, zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())))
                if len(words) >= _WORDS_AT_ONCE:
                    yield counted(words, checks)
                    words, checks = [], []
        if words:
            yield counted(words, checks)

    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n bigint")
    long = found.filter(F.length("word") >= LEAST_LETTERS)
    return long.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram occurs in the distinct words; as many entries as the alphabet has pairs, at most."""
    places = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = words.select(F.explode(F.transform(places, lambda p: F.substring("word", p, F.lit(GRAM)))).alias("gram"))
    return {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}


def prefix(word: str, counts: Mapping[str, int], errors: int = ERRORS) -> list[tuple[tuple[int, str, int], int]]:
    """The rarest ``2 * errors + 1`` bigrams by frequency, letters and place, and all places of the last one: ``(order, place)``."""
    grams = (word[p : p + GRAM] for p in range(len(word) - GRAM + 1))
    ordered = sorted((counts.get(g, 0), g, p) for p, g in enumerate(grams))
    last = ordered[GRAM * errors][:2]
    return [(order, order[2]) for order in ordered if order[:2] <= last]


def pivots(chosen: list[tuple[tuple[int, str, int], int]], errors: int = ERRORS) -> list[int]:
    """Places of the ``errors + 1`` disjoint bigrams of a prefix with the least total frequency.

    ``best[k]`` is the cheapest choice of ``k`` disjoint bigrams among those seen; a bigram extends choices among the
    bigrams that end before it starts.
    """
    by_place = sorted(chosen, key=lambda gram: gram[1])
    history: list[tuple[int, list]] = [(-GRAM, [(0, [])] + [None] * (errors + 1))]
    for (frequency, _, _), place in by_place:
        best = list(history[-1][1])
        before = next(state for at, state in reversed(history) if at <= place - GRAM)
        for k in range(errors + 1):
            if before[k] is not None:
                choice = (before[k][0] + frequency, [*before[k][1], place])
                if best[k + 1] is None or choice < best[k + 1]:
                    best[k + 1] = choice
        history.append((place, best))
    return history[-1][1][errors + 1][1]


def mask(grams: Iterator[str]) -> int:
    """A set of bigrams or letters as 64 bits, in signed form."""
    bits = 0
    for gram in grams:
        bits |= 1 << zlib.crc32(gram.encode()) % 64
    return bits - (bits >> 63 << 64)


def signatures(words: DataFrame, counts: Mapping[str, int]) -> DataFrame:
    """Words with ``last``, the order of the prefix's last bigram, the prefix's places, pivots marked, and masks of letters and bigrams."""
    import pyarrow as pa

    row = pa.struct([("place", pa.int32()), ("pivot", pa.bool_())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lasts, grams, masks = [], [], []
            for word in batch.column(0).to_pylist():
                chosen = prefix(word, counts)
                best = pivots(chosen)
                # compared as text: frequency and letters decide, equal ones go both ways
                lasts.append(f"{chosen[-1][0][0]:020d}{chosen[-1][0][1]}")
                grams.append([{"place": place, "pivot": place in best} for _, place in sorted(chosen, key=lambda gram: gram[1])])
                masks.append((mask(word), mask(word[p : p + GRAM] for p in range(len(word) - GRAM + 1))))
            made = [pa.array(lasts, pa.string()), pa.array(grams, pa.list_(row)), *[pa.array(m, pa.int64()) for m in zip(*masks, strict=True)]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names)

    names = ["word", "n", "last", "grams", "letters", "bigrams"]
    schema = "word string, n bigint, last string, grams array<struct<place: int, pivot: boolean>>, letters bigint, bigrams bigint"
    return words.select("word", "n").mapInArrow(sign, schema)


def near_pairs(words: DataFrame, workspace: Workspace) -> DataFrame:
    """``(word, n, near, near_n)``: every ordered pair of stored words that differ by exactly one edit."""
    signed = workspace.table(signatures(words, gram_counts(words)), "signatures").withColumn("size", F.length("word"))
    place, length, carried = F.col("g.place"), F.col("size"), ["word", "n", "last", "letters", "bigrams", "size"]
    left = F.concat(F.lit("<"), F.substring("word", F.lit(1), place + GRAM))
    right = F.concat(F.substring("word", place + 1, length), F.lit(">"))
    held = signed.withColumn("g", F.explode("grams")).select(*carried, F.explode(F.array(left, right)).alias("part"))
    key = ["size", "part"]
    salts = held.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / _SALT_ROWS).cast("int").alias("salts"))
    salts = workspace.table(salts, "salts")
    held = held.join(salts, key).select(
        *key, F.pmod(F.xxhash64("word"), "salts").cast("int").alias("salt"),
        *[F.col(c).alias(f"held_{c}") for c in ("word", "n", "last", "letters", "bigrams")],
    )
    # an edit right of the first pivot leaves all up to it alone, any other edit all from the second one on
    first, second = (F.filter("grams", lambda g: g["pivot"])[i]["place"] for i in range(2))
    parts = F.array(
        F.concat(F.lit("<"), F.substring("word", F.lit(1), first + GRAM)), F.concat(F.substring("word", second + 1, length), F.lit(">"))
    )
    probes = signed.select(*carried, F.explode(parts).alias("part"))
    probes = probes.withColumn("size", F.explode(F.array(*[length + d for d in range(-ERRORS, ERRORS + 1)])))
    probes = probes.join(salts, key).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    # one edit changes two letters and four bigrams at most
    alike = [F.bit_count(F.col(c).bitwiseXOR(F.col(f"held_{c}"))) <= most for c, most in (("bigrams", 4), ("letters", 2))]
    verified = alike[0] & alike[1] & (F.col("last") <= F.col("held_last")) & (F.levenshtein("word", "held_word", 1) == 1)
    # few bytes, but many comparisons: dealt over as many tasks as a shuffle may have, not merged by size
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probes, held = (rows.repartition(tasks, *key, "salt") for rows in (probes, held))
    met = probes.alias("p").join(held.alias("h"), [F.col(f"p.{c}") == F.col(f"h.{c}") for c in [*key, "salt"]] + [verified])
    pairs = workspace.table(met.select("word", "n", "held_word", "held_n").distinct(), "pairs")
    names = ["word", "n", "near", "near_n"]
    return pairs.toDF(*names).union(pairs.select("held_word", "held_n", "word", "n").toDF(*names)).distinct()


def rooted(forms: DataFrame, workspace: Workspace) -> DataFrame:
    """``(word, root)`` of all words with a form: forms are followed by doubling until nothing changes.

    Counts grow at least ``DOMINANCE`` times with every form, so the chains are short and have no circles.
    """
    at = workspace.table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        stored = workspace.table(moved, "roots")
        at = stored.drop("moved")
        if stored.filter("moved").isEmpty():
            return at


def variants(docs: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the texts."""
    workspace = workspace or Workspace(docs.sparkSession)
    words = workspace.table(word_counts(docs), "words")
    near = near_pairs(words, workspace)
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near")))
    chosen = near.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    dominant = -F.col("best.order") >= DOMINANCE * F.col("n")
    found = workspace.table(
        chosen.select(
            "word", "n_near", F.when(dominant, F.col("best.near")).alias("form"), F.when(dominant, -F.col("best.order")).alias("form_n")
        ),
        "forms",
    )
    roots = rooted(found.filter(F.col("form").isNotNull()), workspace)
    joined = words.join(found, "word", "left").join(roots, "word", "left")
    return joined.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )
