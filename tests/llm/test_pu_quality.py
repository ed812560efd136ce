"""Positive-unlabelled quality: risk and prior against plain formulas, accuracy on held-out labels."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlens.llm import pu_quality as pu
from campaignlens.llm.common import Workspace

DATA = "/root/testdata/sf0.1"


def test_held_out_texts_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    scores = pu.quality_scores(docs, labels)
    rows = scores.where("held_out").join(labels.select("doc_id", "quality"), "doc_id").select("quality", "score", "predicted").collect()
    good, bad = (np.array([r["score"] for r in rows if r["quality"] == q]) for q in (1, 0))
    assert len(good) > 500 and len(bad) > 100
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert (good >= pu.GOOD_AT).mean() > 0.99 and (bad >= pu.GOOD_AT).mean() < 0.05
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_only_positives_of_training_folds_are_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).where("quality = 1").union(
        labels.where("quality = 0").limit(3)
    )
    plain, other = ({r["doc_id"]: r["score"] for r in pu.quality_scores(docs, x).collect()} for x in (labels, turned))
    assert plain.keys() == other.keys() and all(abs(plain[k] - other[k]) < 1e-6 for k in plain)


def _table(spark, x: np.ndarray, positive: np.ndarray):
    rows = [(bytearray(row.astype(np.float32).tobytes()), bool(p)) for row, p in zip(x, positive, strict=True)]
    return spark.createDataFrame(rows, "figures binary, positive boolean").repartition(3)


def test_fit_minimizes_the_stated_risk(spark):
    rng = np.random.default_rng(7)
    x = np.zeros((900, pu.SIZE), np.float32)
    x[:, 0] = 1.0
    x[:300, 1:4] = rng.normal(1.0, 1.0, (300, 3))
    x[300:, 1:4] = np.where(rng.random((600, 1)) < 0.6, rng.normal(1.0, 1.0, (600, 3)), rng.normal(-1.0, 1.0, (600, 3)))
    positive = np.arange(900) < 300
    stored = Workspace(spark).table(_table(spark, x, positive))
    scale = pu.scale_of(stored)
    assert (scale.positives, scale.unlabelled) == (300, 600)
    w = pu.fit(stored, scale, 0.6)
    z = scale(x.astype(float))
    ridge = np.full(pu.SIZE, pu.RIDGE)
    ridge[0] = pu.RIDGE / 100

    def risk(v):
        g = z @ v
        loss = lambda m: np.logaddexp(0, m).mean()
        rest = loss(g[300:]) - 0.6 * loss(g[:300])
        return 0.6 * loss(-g[:300]) + max(0.0, rest) + 0.5 * ridge @ (v * v)

    least = risk(w)
    for _ in range(50):
        assert risk(w + rng.normal(0, 0.05, pu.SIZE)) > least - 1e-9


def test_best_bin_finds_the_share_of_positives():
    rng = np.random.default_rng(3)
    share = 0.7
    positives = np.histogram(rng.beta(5, 2, 20_000), 512, (0, 1))[0]
    mixed = np.concatenate([rng.beta(5, 2, int(40_000 * share)), rng.beta(1, 6, int(40_000 * (1 - share)))])
    assert pu.best_bin_prior(positives, np.histogram(mixed, 512, (0, 1))[0]) == pytest.approx(share, abs=0.03)
    assert pu.best_bin_prior(np.zeros(512), np.ones(512)) == pu.LARGEST_PRIOR


def test_figures_of_odd_texts():
    assert not pu.describe(b"").any() and not pu.describe(b" \n\t").any()
    plain, symbols = pu.describe(b"Some plain words here. " * 30), pu.describe(b"Some### plain$$$ words%%% here. " * 30)
    assert np.isfinite(plain).all() and symbols[14] > plain[14] == 0
    assert np.allclose((plain[pu.FIGURES :] ** 2).sum(), 1.0, atol=1e-4)


def test_odd_rows_and_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (8, None), (None, 1), (11, 0)], "doc_id long, quality int")
    rows = pu.quality_scores(odd_docs, labels.withColumn("figures", F.lit(0))).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    copies = [r["score"] for r in rows if r["doc_id"] == 1]
    assert len(copies) == 2 and copies[0] == copies[1]
    nothing = pu.quality_scores(odd_docs, labels.limit(0)).collect()
    assert {r["score"] for r in nothing} == {0.0}
    assert pu.quality_scores(no_docs, labels).count() == 0
