"""Packing, near-duplicates and exact search."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from campaignlens.llm import packing, simhash, topk
from tests.llm.conftest import ROWS


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path(packing.TOKENIZER))


def test_ids_of_chunks_are_those_of_the_text(tokenizer):
    chunks = packing.ChunkIds(packing.TOKENIZER)
    texts = [t or "" for _, t, *_ in ROWS[:9]] + [
        "naïve café's I'm don't ÀÉÎ ǅ İstanbul ΣΑΣ ß ﬁ 12.5 a_b x²y ½ <|endoftext|> a\x1cb ​.",
        "it's. they'LL! A.B.C. ..., ?! a1b2 ª º µ ĳ |a| ##x%%", "日本語 テキスト 한국어 ẞ",
        "a <|endoftext|> b", "x<|startoftext|>y. <|endoftext|>. <|ENDOFTEXT|> <|endoftext| >", "<|endoftext|><|endoftext|>don't|",
    ]
    for text in texts:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        assert chunks.ids(text.encode()) == ids.tobytes()


def test_spelled_out_special_tokens_count_as_themselves():
    assert list(np.frombuffer(packing.ChunkIds(packing.TOKENIZER).ids(b"a <|endoftext|> b"), "<u4")) == [320, 49407, 321]


def test_packing_of_odd_documents(odd_docs, no_docs, tokenizer):
    rows = packing.packed(odd_docs, keep_ids=True).collect()
    expected = Counter()
    for doc_id, text, *_ in ROWS:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048].tobytes()
            expected[doc_id, piece, at, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) == -(-sum(r["length"] for r in rows) // 2048)
    assert packing.packed(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 20))
def test_best_fit_takes_the_fullest_that_fits(lengths, limit):
    fit, used, open_bins = packing.BestFit(50, limit), [], {}
    for n in lengths:
        number, offset = fit.place(n)
        free = [f for f in open_bins.values() if f >= n]
        if free:
            assert open_bins[number] == min(free)
        else:
            assert number == len(used) and offset == 0
            used.append(0)
            if len(open_bins) >= limit:
                closed = min(open_bins.values())
                victims = [b for b, f in open_bins.items() if f == closed]
                del open_bins[victims[-1] if len(victims) == 1 else next(b for b in victims if b not in {x for s in fit.by_free for x in s})]
        assert offset == used[number]
        used[number] += n
        open_bins[number] = 50 - used[number]
        if not open_bins[number]:
            del open_bins[number]
        assert used[number] <= 50 and fit.open <= limit


def test_sequences_hold_their_documents(odd_docs):
    placed = packing.packed(odd_docs, keep_ids=True)
    whole = packing.sequences(placed).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * placed.agg(F.sum("length")).first()[0]


def plain_fingerprint(text: str | None) -> int:
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd_docs):
    for _, text, *_ in ROWS:
        assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 6))
def test_bit_sliced_pairs(seed, radius):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64) * np.uint64(2)
    values = np.repeat(centres, 9)
    for _ in range(3):
        values ^= np.uint64(1) << rng.integers(0, 64, len(values)).astype(np.uint64)
    groups = np.sort(rng.integers(0, 3, len(values)))
    found = {(int(a), int(b)) for x, y in simhash.near_pairs(values, groups, radius) for a, b in zip(x, y)}
    n = range(len(values))
    near = lambda i, j: int(values[i] ^ values[j]).bit_count() <= radius
    assert found == {(i, j) for i in n for j in n if i < j and groups[i] == groups[j] and near(i, j)}


@pytest.mark.parametrize("n", [1, 10**5, 10**8, 10**12])
def test_every_pair_within_the_radius_shares_a_key(n):
    masks = simhash.band_keys(n)
    rng = np.random.default_rng(n)
    for _ in range(200):
        flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not m & flips for m in masks)


def brute_groups(rows: list[tuple]) -> dict:
    """Smallest id reachable from each fingerprint."""
    prints = [(i, plain_fingerprint(t)) for i, t, *_ in rows]
    distinct = sorted({f for _, f in prints})
    root = {f: f for f in distinct}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in distinct:
        for b in distinct:
            if (a ^ b).bit_count() <= 4:
                root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for i, f in prints:
        if i is not None:
            least[top(f)] = min(i, least.get(top(f), i))
    return {f: least.get(top(f)) for f in distinct}


def test_groups_of_odd_documents(odd_docs, no_docs):
    expected = brute_groups(ROWS)
    rows = simhash.near_duplicates(odd_docs).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == Counter(
        (i, f"{plain_fingerprint(t):016x}", expected[plain_fingerprint(t)]) for i, t, *_ in ROWS
    )
    kept = simhash.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({(expected[plain_fingerprint(t)], plain_fingerprint(t) if expected[plain_fingerprint(t)] is None else 0) for _, t, *_ in ROWS})
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_per_group(no_docs).count() == 0


def test_crowded_keys_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(5)
    values = {int(x) for x in rng.integers(0, 2**20, 60)} | {1 << k for k in range(40)}  # one crowded key, one star around zero
    values = sorted({*values, 0})
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    from campaignlens.llm.common import Workspace

    rooted = {r["fp"]: r["root"] for r in simhash.components(simhash.links(distinct, len(values)), Workspace(spark)).collect()}
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 4:
                root[max(top(a), top(b))] = min(top(a), top(b))
    assert {v: rooted.get(v, v) for v in values} == {v: top(v) for v in values}


def brute_top(rows: list[tuple], k: int = 5) -> set:
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in good:
        if q % 50 == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(hits, start=1)}
    return out


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(400)]
    rows += [(i, rows[50][1]) for i in range(400, 420)]  # ties
    rows += [(500, None), (501, [None] * 16), (502, [float("nan")] * 16), (503, [float("inf")] * 16), (None, rows[0][1]), (550, [0.0] * 16)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"v": F.lit(1), "shard": F.lit(2), "score": F.lit(3)})
    for options in ({}, {"query_block": 3, "shard_rows": 70}):
        found = {tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 50 == 0, **options).collect()}
        assert found == brute_top(rows)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = {tuple(r) for r in topk.top_k(vectors.filter("vec_id in (0, 1, 2)"), F.col("vec_id") % 50 == 0).collect()}
    assert len(few) == 2


def test_maxscore_skips_rows_but_stays_exact():
    rng = np.random.default_rng(1)
    ids, rows = np.arange(6000), rng.integers(-80, 80, (6000, 32))
    rows[:40] *= 3
    shard = topk.Shard(ids, rows)
    for q in range(0, 6000, 700):
        found_ids, found_scores = shard.search(q, rows[q], 5)
        scores = rows @ rows[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:5]
        assert found_ids.tolist() == order and found_scores.tolist() == scores[order].tolist()


def test_negative_scores_in_later_blocks():
    rng = np.random.default_rng(4)
    ids, rows = np.arange(5000), rng.integers(1, 90, (5000, 12))
    rows[-3:] = 0
    rows[3000:3040] = 1
    for query in (-rng.integers(1, 90, 12), np.array([-5, *[0] * 11])):
        found_ids, found_scores = topk.Shard(ids, rows).search(7, query, 5)
        scores = rows @ query
        order = [i for i in np.lexsort((ids, -scores)) if i != 7][:5]
        assert found_ids.tolist() == order and found_scores.tolist() == scores[order].tolist()


def test_repeated_query_rows_are_ranked_by_themselves(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(60)]
    rows += [rows[50], (50, rows[3][1]), (70, [1e18, *[1.0] * 7]), (71, [2.0**20] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = Counter(tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 50 == 0).collect())
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if max(map(abs, v)) < 2.0**20]
    expected = Counter()
    for q, a in good:
        if q % 50 == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:5]
            expected.update((q, r, i, -s) for r, (s, i) in enumerate(hits, start=1))
    assert found == expected and sum(expected.values()) == 20
