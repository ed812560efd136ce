"""Small hand-made tables and independent NumPy references."""

from __future__ import annotations

import numpy as np

SCORED = "model string, id bigint, y int, p double"
FEATURE_ROW = (
    "id bigint, age_group string, income double, previous_purchases double, purchase_frequency double, "
    "previous_campaign_response int, website_visits double, email_engagement double, discount_usage double, target int"
)


def scored_frame(spark, p, y, model="m"):
    rows = [(model, i, int(yy), float(pp)) for i, (pp, yy) in enumerate(zip(p, y))]
    return spark.createDataFrame(rows, SCORED)


def np_auc(p, y):
    p, y = np.asarray(p), np.asarray(y)
    pos, neg = p[y == 1], p[y == 0]
    if not len(pos) or not len(neg):
        return 0.5
    gaps = pos[:, None] - neg[None, :]
    return ((gaps > 0).sum() + 0.5 * (gaps == 0).sum()) / (len(pos) * len(neg))


def np_average_precision(p, y):
    p, y = np.asarray(p), np.asarray(y)
    total, last, result = y.sum(), 0.0, 0.0
    for t in sorted(set(p.tolist()), reverse=True):
        hit = p >= t
        recall = y[hit].sum() / total
        result += (recall - last) * y[hit].mean()
        last = recall
    return result


def np_roc(p, y, reduced=True):
    """Points (fpr, tpr) without the origin, optionally without inner points on straight stretches."""
    p, y = np.asarray(p), np.asarray(y)
    points = []
    for t in sorted(set(p.tolist()), reverse=True):
        hit = p >= t
        points.append((int((y[hit] == 0).sum()), int((y[hit] == 1).sum())))
    if reduced and len(points) > 2:
        arr = np.array(points)
        bend = (np.diff(arr[:, 0], 2) != 0) | (np.diff(arr[:, 1], 2) != 0)
        arr = arr[np.r_[True, bend, True]]
        points = [tuple(row) for row in arr]
    neg, pos = int((y == 0).sum()), int((y == 1).sum())
    return [(f / neg, t / pos) for f, t in points]


def rows_of(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
