"""Near-duplicates by shingle sets, as the pipeline drops them."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from campaignlens.llm import shingles, simhash
from campaignlens.llm.common import Workspace
from tests.llm.conftest import ROWS


def plain_set(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_kept(rows: list[tuple]) -> list:
    """Smallest id of each group connected by similarity of at least 0.8, over all pairs."""
    sets = [plain_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for x, y in combinations(range(len(rows)), 2):
        a, b = sets[x], sets[y]
        if a == b or 5 * len(a & b) >= 4 * len(a | b):
            root[max(top(x), top(y))] = min(top(x), top(y))
    members: dict = {}
    for k, (i, *_) in enumerate(rows):
        members.setdefault(top(k), []).append(i)
    return sorted((min((i for i in m if i is not None), default=None) for m in members.values()), key=str)


def kept_ids(docs) -> list:
    return sorted((r["doc_id"] for r in docs.collect()), key=str)


def near_copies(seed: int) -> list[tuple]:
    """Copies of a few texts with words replaced: most pairs lie above, some below the limit."""
    rng = np.random.default_rng(seed)
    rows = []
    for base in range(8):
        words = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        for _ in range(12):
            copy = list(words)
            for at in rng.integers(0, 200, rng.integers(0, 8)):
                copy[at] = f"new{rng.integers(0, 10**9)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_stage_drops_near_copies_that_differ_in_many_bits(spark):
    rows = near_copies(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = kept_ids(corpus_pipeline.drop_near_duplicates(spark, docs, ""))
    assert kept == brute_kept(rows) and len(kept) < simhash.one_per_group(docs).count()


def test_rounds_of_crowded_keys(spark, monkeypatch):
    monkeypatch.setattr(shingles, "_FIRST_SHARE", 1)
    monkeypatch.setattr(shingles, "_GROWTH", 2)
    monkeypatch.setattr(shingles, "_SMALL_KEY", 2)
    monkeypatch.setattr(shingles, "_SALT_ROWS", 4)
    rows = near_copies(2)
    assert kept_ids(shingles.one_per_group(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_kept(rows)


def test_odd_documents(odd_docs, no_docs):
    kept = shingles.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns and kept_ids(kept) == brute_kept(ROWS)
    assert shingles.one_per_group(no_docs).count() == 0


@pytest.mark.parametrize("n", [6, 60, 3000])
def test_keys_of_similar_sets_meet(n):
    rng = np.random.default_rng(n)
    for _ in range(50):
        a = rng.integers(0, 2**64, n, dtype=np.uint64)
        b = a[max(1, n // 5) :]
        one, two = (shingles.least_hashes(np.unique(x)) for x in (a, b))
        assert (shingles.band_keys(one) == shingles.band_keys(two)).any()
        agreeing = np.frombuffer(shingles.sketch(one), np.uint8) == np.frombuffer(shingles.sketch(two), np.uint8)
        assert agreeing.sum() >= shingles.LEAST_AGREEING


def test_simhash_operator_finds_candidates(spark):
    """Sets without any minimum-hash key in common still meet if their fingerprints are within the radius."""
    rng = np.random.default_rng(5)
    words = [f"w{x}" for x in rng.integers(0, 5000, 400)]
    rows = [(k, " ".join([*words, f"end{k}"])) for k in range(6)]
    prints = [simhash.fingerprint(text.encode(), shingles.SHINGLE_WORDS) for _, text in rows]
    assert max((prints[0] ^ p).bit_count() for p in prints) <= simhash.RADIUS
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    numbered = docs.withColumn("record", F.struct("doc_id", "text")).withColumn("row_number", F.col("doc_id"))
    workspace = Workspace(spark)
    apart = F.transform(F.sequence(F.lit(0), F.lit(shingles.BANDS - 1)), lambda k: F.col("doc_id") * shingles.BANDS + k)
    stored = workspace.table(shingles.signed(numbered).drop("text").withColumn("keys", apart), "shingled")
    assert shingles.groups(stored, workspace).select("root").distinct().count() == 1


def test_differences_leave_no_similar_pair_out(spark):
    """All pairs of one crowd through their differences from a centre: every similar one meets or is near the centre, few others do."""
    rng = np.random.default_rng(7)
    words = [f"w{x}" for x in rng.integers(0, 5000, 150)]
    texts = []
    for _ in range(60):
        copy = list(words)
        for at in rng.integers(0, 150, rng.integers(0, 8)):
            copy[at] = f"new{rng.integers(0, 40)}"
        texts.append(" ".join(copy))
    sets = [set(shingles.shingle_set(t.encode()).tolist()) for t in texts]
    centre = 30
    rows = [(k, centre, len(s), [int(np.uint64(e).view(np.int64)) for e in s ^ sets[centre]], False) for k, s in enumerate(sets) if k != centre]
    differences = spark.createDataFrame(rows, "a long, b long, n long, elements array<long>, near boolean")
    rooted = spark.createDataFrame([], "fp long, root long")
    met = {(r["a"], r["b"]) for r in shingles._by_differences(differences, rooted).collect()}
    similar = lambda x, y: 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y])
    others = [k for k in range(60) if k != centre]
    for x, y in combinations(others, 2):
        if similar(x, y):
            assert (x, y) in met or (similar(x, centre) and similar(y, centre))
    assert len(met) < 0.6 * len(others) * (len(others) - 1) / 2


def test_a_crowd_is_compared_from_one_centre(spark, monkeypatch):
    """Of a crowd of sets, most of them too far apart, each is stated once, and no similar pair stays apart."""
    rng = np.random.default_rng(11)
    words = [f"w{x}" for x in rng.integers(0, 5000, 150)]
    rows = []
    for _ in range(80):
        copy = list(words)
        for at in rng.integers(0, 150, rng.integers(2, 9)):
            copy[at] = f"new{rng.integers(0, 40)}"
        rows.append((len(rows), " ".join(copy)))
    made = []
    differences = shingles._differences

    def counted(pairs, texts, workspace):
        made.append(pairs)
        return differences(pairs, texts, workspace)

    monkeypatch.setattr(shingles, "_differences", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert kept_ids(shingles.one_per_group(docs)) == brute_kept(rows)
    (pairs,) = made
    members = [r["a"] for r in pairs.collect()]
    assert len(set(members)) == len(members) > 0


def test_first_elements_are_a_bounded_part(spark):
    """Elements that every difference has aren't exploded for each of them; whatever the order, the rest suffices."""
    common = list(range(100))
    rows = [(k, -1, 100, [*common, *range(1000 * k, 1000 * k + 30)], False) for k in range(1, 41)]
    differences = spark.createDataFrame(rows, "a long, b long, n long, elements array<long>, near boolean")
    first = shingles._first_elements(differences).collect()
    assert len(first) == 40 * 26 and not any(r["e"] in common for r in first)
    assert {r["left"] for r in first} == set(range(105, 131))
