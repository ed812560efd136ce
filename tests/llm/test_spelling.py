"""Spelling variants against plain wildcard neighbourhoods."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from campaignlens.llm import spelling
from campaignlens.llm.common import Workspace

DATA = "/root/testdata/sf0.01"


def plain_counts(rows) -> dict[str, int]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_near(words) -> dict[str, set[str]]:
    masks, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masks[w[:i], w[i + 1 :]].add(w)
    for (before, after), group in masks.items():
        for w in group:
            near[w] |= group - {w}
            if before + after in words:
                near[w].add(before + after)
                near[before + after].add(w)
    return near


def plain_variants(rows) -> set[tuple]:
    n = plain_counts(rows)
    near, form = plain_near(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def test_variants_equal_plain_ones(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = [tuple(r) for r in spelling.variants(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_variants([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert any(form for _, form, *_ in got)


def _pairs_of(spark, words) -> set[tuple]:
    workspace = Workspace(spark)
    stored = workspace.table(spark.createDataFrame([(w, 5) for w in words], "word string, n bigint"))
    return {(r["word"], r["near"]) for r in spelling.near_pairs(stored, workspace).collect()}


def test_near_pairs_of_repetitive_words(spark, monkeypatch):
    """Few letters give many equal bigrams, ties in the order and crowded keys."""
    monkeypatch.setattr(spelling, "_SALT_ROWS", 3)
    words = {"".join("abé"[(k // 3**i) % 3] for i in range(size)) for size in (6, 7) for k in range(0, 3**size, 4)}
    near = plain_near(words)
    assert _pairs_of(spark, words) == {(a, b) for a in near for b in near[a]}


@settings(max_examples=200, deadline=None)
@given(st.text("abcà", min_size=6, max_size=12), st.dictionaries(st.text("abcà", min_size=2, max_size=2), st.integers(0, 9)))
def test_pivots_are_disjoint_and_cheapest(word, counts):
    chosen = spelling.prefix(word, counts)
    places = spelling.pivots(chosen)
    cost = {place: order[0] for order, place in chosen}
    pairs = [(a, b) for a in cost for b in cost if b - a >= 2]
    assert tuple(places) in pairs and sum(cost[p] for p in places) == min(cost[a] + cost[b] for a, b in pairs)


def test_ties_chains_and_odd_rows(spark, odd_docs, no_docs):
    texts = ["meadow " * 625, "meadows " * 125, "meadowsy " * 25, "meadowsyx " * 5, "planta " * 5, "plantb " * 25, "plantc " * 25, "ÉCOLES école " * 5]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r["word"]: r for r in spelling.variants(docs.withColumn("n", F.lit(1))).collect()}
    assert {tuple(r) for r in rows.values()} == plain_variants(list(enumerate(texts)))
    assert rows["meadowsyx"]["root"] == "meadow" and rows["planta"]["form"] == "plantb" and rows["plantb"]["form"] is None
    got = {tuple(r) for r in spelling.variants(odd_docs).collect()}
    assert got == plain_variants([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert spelling.variants(no_docs).count() == 0
