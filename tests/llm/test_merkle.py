"""The Merkle manifest against a plain tree, for several arities and odd tables."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from campaignlens.llm import merkle
from campaignlens.llm.common import Workspace
from tests.llm.conftest import ROWS


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row, more: int = 0) -> str:
    n = None if row["n_chars"] is None else row["n_chars"] + more
    return sha("".join(field(v) for v in (row["doc_id"], row["source"], row["lang"], n, row["text"])))


def plain_tree(leaves: list[str], arity: int) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + arity])) for i in range(0, len(levels[-1]), arity)])
    return levels


def plain_proof(levels: list[list[str]], at: int, arity: int) -> list[tuple[str, str]]:
    steps = []
    for level in levels[:-1]:
        first = at // arity * arity
        steps.append(("".join(level[first:at]), "".join(level[at + 1 : first + arity])))
        at //= arity
    return steps


def plain_audit(rows, arity: int) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[lang] = plain_tree([plain_leaf(r) for r in groups[lang]], arity)
    top = plain_tree([trees[lang][-1][0] for lang in langs], arity)
    out = []
    for k, lang in enumerate(langs):
        for i, row in enumerate(groups[lang]):
            steps = plain_proof(trees[lang], i, arity) + plain_proof(top, k, arity)
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            found = plain_leaf(row, int(tampered))
            for before, after in steps:
                found = sha(before + found + after)
            root = top[-1][0]
            out.append((row["doc_id"], plain_leaf(row), trees[lang][-1][0], root, sha("".join(a + b for a, b in steps)), found, found == root))
    return out


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_audit_equals_plain_trees(spark, arity):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert ordered(merkle.audited(docs, arity=arity).collect()) == ordered(plain_audit(docs.collect(), arity))


def test_odd_rows_have_places_and_proofs(odd_docs):
    rows = odd_docs.select(*merkle.FIELDS).collect()
    assert len(rows) == len(ROWS)
    assert ordered(merkle.audited(odd_docs).collect()) == ordered(plain_audit(rows, 2))


def test_equal_rows_each_have_a_place(spark):
    docs = spark.range(37).select(
        F.lit(7).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"),
        F.lit(4).cast("long").alias("n_chars"), F.lit("copy").alias("text"),
    )
    assert ordered(merkle.audited(docs).collect()) == ordered(plain_audit(docs.collect(), 2))
    workspace = Workspace(spark)
    places = merkle.manifest(docs, workspace).select("idx").collect()
    assert sorted(r["idx"] for r in places) == list(range(37))


def test_changes_are_found_and_change_the_root(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = merkle.audited(docs).collect()
    expected = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0 for r in rows}
    assert {r["doc_id"]: r["verified"] for r in rows} == expected
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 3, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    roots = {r["root"] for r in rows}, {r["root"] for r in merkle.audited(changed).select("root").collect()}
    assert all(len(r) == 1 for r in roots) and roots[0] != roots[1]


def test_no_documents(no_docs):
    assert merkle.audited(no_docs).count() == 0
