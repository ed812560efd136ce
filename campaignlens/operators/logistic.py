"""Logistic regression of many fits and strengths at once, by Newton steps on sums that Spark adds up.

A step is one aggregation: every task adds up loss, gradient and curvature of its rows under every (fit, strength) that isn't settled, Spark
adds up the tasks by key, and the driver solves one system of as many unknowns as there are columns per key. Steps that
raise the loss are halved. The result has a gradient of (nearly) zero, whichever way the sums were added.

Semantics: ``strength * sum(loss) + |coefficients|**2 / 2`` is minimized, the intercept is free; a strength of None leaves out the
penalty. Targets may be fractions. Columns that are constant or repeat others get a tiny extra penalty, so the system can be solved.

Scale: rows are read once a step, some six to ten times; what travels is one row of sums per task and key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

MOST_STEPS = 100
SETTLED = 1e-9
_TINY = 1e-10


@dataclass(frozen=True)
class Logit:
    """A fitted curve: its fit, strength, intercept, coefficients by column, and the largest gradient per unit of weight."""

    fit: int
    strength: float | None
    intercept: float
    coefficients: tuple[float, ...]
    gradient: float

    def probability(self, columns: Sequence[Column]) -> Column:
        z = F.lit(self.intercept)
        for weight, column in zip(self.coefficients, columns, strict=True):
            z = z + F.lit(weight) * column
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Weight, loss, gradient and upper triangle of the curvature of a block; the first column of ``x`` is one."""
    z = x @ beta
    p = 0.5 * np.tanh(0.5 * z) + 0.5
    loss = weight @ (np.logaddexp(0.0, z) - y * z)
    gradient = (weight * (p - y)) @ x
    bend = (x * (weight * p * (1 - p))[:, None]).T @ x
    return np.concatenate([[weight.sum(), loss], gradient, bend[np.triu_indices(x.shape[1])]])


def _step(rows: DataFrame, betas: dict[tuple[int, int], np.ndarray], width: int) -> dict[tuple[int, int], np.ndarray]:
    """Sums of every key of ``betas`` over rows of ``(fit, y, weight, columns...)``: one job."""
    import pyarrow as pa

    by_fit: dict[int, list[tuple[int, np.ndarray]]] = {}
    for (fit, number), beta in betas.items():
        by_fit.setdefault(fit, []).append((number, beta))
    size = 2 + width + width * (width + 1) // 2

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {key: np.zeros(size) for key in betas}
        for batch in batches:
            fit, y, weight, *x = (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns)
            x = np.stack([np.ones(len(y)), *x], axis=1)
            for key, found in by_fit.items():
                mine = np.flatnonzero(fit == key)
                if len(mine):
                    for number, beta in found:
                        totals[key, number] += _sums(x[mine], y[mine], weight[mine], beta)
        keys = list(totals)
        made = [pa.array([k[i] for k in keys], pa.int32()) for i in range(2)]
        yield pa.RecordBatch.from_arrays([*made, pa.array([totals[k] for k in keys], pa.list_(pa.float64()))], ["fit", "number", "sums"])

    parts = rows.mapInArrow(add, "fit int, number int, sums array<double>")
    added = parts.groupBy("fit", "number").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(size)]).alias("sums"))
    return {(r["fit"], r["number"]): np.array(r["sums"]) for r in added.collect()}  # one row per fit and strength


def fit_logits(
    rows: DataFrame, columns: Sequence[str], strengths: Sequence[float | None] = (None,), label: str = "y", weight: str | None = None, fit: str | None = None
) -> list[Logit]:
    """Fits every strength for every value of the integer column ``fit`` (one fit if not given) of stored ``rows``."""
    width = len(columns) + 1
    key = F.col(fit).cast("int") if fit else F.lit(0)
    mass = F.col(weight).cast("double") if weight else F.lit(1.0)
    plain = rows.select(key.alias("fit"), F.col(label).cast("double").alias("y"), mass.alias("weight"), *[F.col(f"`{c}`").cast("double") for c in columns])
    fits = [r["fit"] for r in plain.select("fit").distinct().collect()] if fit else [0]  # a handful of folds
    upper = np.triu_indices(width)
    keys = [(f, i) for f in fits for i in range(len(strengths))]
    beta = {k: np.zeros(width) for k in keys}
    trial, best, done = dict(beta), dict.fromkeys(keys, np.inf), {}
    for _ in range(MOST_STEPS):
        found = _step(plain, {k: b for k, b in trial.items() if k not in done}, width)
        for k, sums in found.items():
            strength, at = strengths[k[1]], trial[k]
            scale, ridge = (1.0, 0.0) if strength is None else (strength, 1.0)
            penalty = np.concatenate([[0.0], np.full(width - 1, ridge)])
            loss = scale * sums[1] + 0.5 * penalty @ (at * at)
            mass = max(scale * sums[0], 1e-300)
            if not loss <= best[k] + 1e-12 * abs(best[k]) and np.isfinite(best[k]) and np.abs(at - beta[k]).max() > 1e-14:
                trial[k] = (at + beta[k]) / 2
                continue
            beta[k], best[k] = at, loss
            gradient = scale * sums[2 : 2 + width] + penalty * at
            bend = np.zeros((width, width))
            bend[upper] = scale * sums[2 + width :]
            bend = bend + np.triu(bend, 1).T + np.diag(penalty)
            bend += np.diag(np.full(width, _TINY * max(np.trace(bend), 1e-12)))
            step = np.linalg.solve(bend, gradient)
            if np.abs(gradient).max() / mass < SETTLED or np.abs(step).max() < SETTLED:
                done[k] = np.abs(gradient).max() / mass
            trial[k] = at - step
        if len(done) == len(keys):
            break
    return [
        Logit(f, strengths[i], float(beta[f, i][0]), tuple(float(b) for b in beta[f, i][1:]), float(done.get((f, i), np.inf)))
        for f, i in keys
    ]


def logit_probability(logits: Sequence[Logit], columns: Sequence[str], fit: str) -> Column:
    """Probability by the curve of the row's ``fit``; the curves must have one strength."""
    found = F.lit(None).cast("double")
    for logit in logits:
        found = F.when(F.col(fit) == logit.fit, logit.probability([F.col(f"`{c}`") for c in columns])).otherwise(found)
    return found
