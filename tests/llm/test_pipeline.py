"""The pipeline's stages and the registered queries on a small table."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from campaignlens.llm import queries
from campaignlens.llm.common import Workspace
from tests.llm.test_shingles import brute_kept, kept_ids

DATA = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    results, kept = Workspace(spark), [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(results.table(stage(spark, kept[-1], DATA), name))
    before, language, unique, clean, mixed, packed = kept
    assert all(x.columns == docs.columns for x in (language, unique, clean, mixed))
    assert language.count() > 0.97 * before.count()
    rows = [(r["doc_id"], r["text"]) for r in language.collect()]
    assert kept_ids(unique) == brute_kept(rows)
    assert clean.count() == unique.count()
    assert not any("example.com" in r["text"] for r in clean.collect())
    passes = Counter(r["doc_id"] for r in mixed.collect())
    assert max(passes.values()) > 1 and set(passes) <= {r["doc_id"] for r in clean.collect()}
    assert Counter(r["doc_id"] for r in packed.filter("piece = 0").collect()) == passes


def test_pipeline_of_odd_and_no_documents(spark, odd_docs, no_docs):
    for given in (odd_docs, no_docs):
        docs = given
        results = Workspace(spark)
        for name, stage in corpus_pipeline.STAGES:
            docs = results.table(stage(spark, docs, DATA), name)
        if given.isEmpty():
            assert docs.isEmpty()
        else:
            assert {r["doc_id"] for r in docs.collect()} <= {r["doc_id"] for r in given.collect()}


def test_a_second_run_leaves_the_first_result(spark):
    first = corpus_pipeline.run(spark, DATA)
    second = corpus_pipeline.run(spark, DATA)
    key = ["doc_id", "piece", "length"]
    assert first.select(key).exceptAll(second.select(key)).isEmpty() and first.count() == second.count() > 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_every_row(spark, name):
    result = queries.QUERIES[name](spark, DATA)
    if "doc_id" in result.columns:
        assert result.select("doc_id").distinct().count() == 200
    if name in queries.ORACLE:
        duckdb = pytest.importorskip("duckdb")
        con = duckdb.connect()
        for table in ("documents", "embeddings"):
            con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
        names = ", ".join(result.columns)
        expected = Counter(con.sql(f"SELECT {names} FROM ({queries.ORACLE[name]})").fetchall())
        assert Counter(tuple(r) for r in result.collect()) == expected

