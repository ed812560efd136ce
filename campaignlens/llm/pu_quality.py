"""Quality of texts, learned from trusted positives and unlabelled web text alone (positive-unlabelled learning).

A text is described by surface figures (lengths, repetition, symbols, capitals) and by hashed shares of word shapes (``Word.``
is ``Aa.``); no word itself enters. The model is linear in the standardized figures. With the logistic loss l, class prior q and
score g it minimizes the non-negative risk

    q * E_pos[l(g)] + max(0, E_unl[l(-g)] - q * E_pos[l(-g)]) + RIDGE / 2 * |w|^2

by damped Newton steps; where the difference is negative, the step raises it instead. The prior is estimated by the best bin: a
plain classifier of positives against unlabelled texts is fitted on one half of the rows, and the other half gives the smallest
ratio of tail shares, unlabelled to positive, with a confidence bound on both. The score is the sigmoid of g.

Defined results: a null or empty text is described by zeros and scored like any other; without positives every score is 0; several
labels of an id count as positive once if any of them is; rows without an id train only as unlabelled ones; repeated rows count each
time and score alike; an empty table gives an empty result; other columns are ignored.

Scale: figures are taken in one pass over whole texts and stored once (``SIZE`` floats a text); every training pass reads all of
them, on Spark. Tasks add up gradient and curvature, ``_FAN`` tasks add those up, and the driver solves a system of ``SIZE``
unknowns. There is no sample and no cap on positives or unlabelled texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.llm.common import Workspace, in_fold, text_bytes
from campaignlens.llm.kneser_ney import WordHashes
from campaignlens.llm.quality import repeated_words

GOOD_AT = 0.7
RIDGE = 1e-3
SHAPES = 96
FIGURES = 24
SIZE = FIGURES + SHAPES
MOST_STEPS = 12
SETTLED = 1e-5
LARGEST_PRIOR = 0.99
_BINS = 512
_FAN = 8
_TEXTS_AT_ONCE = 2048
_HASHES = WordHashes()
_SHAPE = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)
_SYMBOLS = np.frombuffer(b"#*$%&|<>{}[]\\^~_=+@/", np.uint8)
_ENDS = np.frombuffer(b".,;:!?", np.uint8)


def _letters(counts: np.ndarray) -> tuple[int, int, int]:
    """Capitals, other letters and digits among byte counts; a letter beyond ASCII counts once."""
    return int(counts[65:91].sum()), int(counts[97:123].sum() + counts[192:].sum()), int(counts[48:58].sum())


def describe(text: bytes) -> np.ndarray:
    """The figures of one whole text."""
    x = np.zeros(SIZE, np.float32)
    words = text.split()
    n = len(words)
    if not n:
        return x
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    capitals, small, digits = _letters(seen)
    letters, chars = capitals + small, len(text) - int(seen[128:192].sum())
    counts = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    same = float(np.count_nonzero(hashes[1:] == hashes[:-1])) / n
    repeated = repeated_words(hashes) / n
    doubled = 1 - len(set(lines)) / len(lines)
    symbols, ends = int(seen[_SYMBOLS].sum()), int(seen[_ENDS].sum())
    distinct, top = len(counts) / n, max(counts.values()) / n
    x[:FIGURES] = (
        1.0, np.log1p(n) / 10, min(n, 50) / 50, min(n, 200) / 200, distinct, distinct * np.log1p(n) / 10, top, np.sqrt(top),
        same, np.sqrt(same), repeated, np.sqrt(repeated), doubled, np.sqrt(doubled), symbols / n, np.sqrt(symbols / n),
        capitals / max(letters, 1), digits / chars, np.sqrt(ends / n), chars / n / 20, max(map(len, words)) / 100 if n else 0.0,
        np.log1p(len(lines)) / 10, np.log1p(n / len(lines)) / 10, letters / chars,
    )
    shapes: Counter = Counter()
    for shape, times in Counter(text.translate(_SHAPE).split()).items():
        shapes[_RUN.sub(rb"\1", shape)] += times
    for shape, times in shapes.items():
        x[FIGURES + zlib.crc32(shape) % SHAPES] += times / n
    np.sqrt(x[FIGURES:], out=x[FIGURES:])
    return x


def described(docs: DataFrame) -> DataFrame:
    """``(doc_id, figures)``: the figures of every text as 32-bit floats."""
    import pyarrow as pa

    def describe_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _TEXTS_AT_ONCE):
                batch = whole.slice(at, _TEXTS_AT_ONCE)
                figures = [describe(text).tobytes() for text in text_bytes(batch.column(1))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(figures, pa.binary())], ["doc_id", "figures"])

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(describe_all, "doc_id bigint, figures binary")


def _matrix(column) -> np.ndarray:
    flat = b"".join(value.as_py() for value in column)
    return np.frombuffer(flat, np.float32).reshape(-1, SIZE).astype(np.float64)


def added_up(rows: DataFrame, statistic: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``statistic(figures, positive)`` (``size`` numbers) over all blocks of ``rows`` of ``(figures, positive)``.

    Tasks add up their blocks, ``_FAN`` further tasks add up the tasks, and the driver those.
    """
    import pyarrow as pa

    def packed(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for whole in batches:
            for at in range(0, whole.num_rows, _TEXTS_AT_ONCE):
                batch = whole.slice(at, _TEXTS_AT_ONCE)
                total += statistic(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool))
        yield packed(total)

    def then(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_py())
        yield packed(total)

    parts = rows.select("figures", "positive").mapInArrow(first, "total binary").repartition(_FAN).mapInArrow(then, "total binary")
    return sum((np.frombuffer(r["total"]) for r in parts.collect()), np.zeros(size))


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass(frozen=True)
class Scale:
    """Means and deviations of the unlabelled texts' figures, and the numbers of positives and unlabelled texts."""

    mean: np.ndarray
    deviation: np.ndarray
    positives: float
    unlabelled: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.deviation
        z[:, 0] = 1.0
        return z


def scale_of(rows: DataFrame) -> Scale:
    def sums(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        u = x[~positive]
        return np.concatenate([[positive.sum(), len(u)], u.sum(axis=0), (u * u).sum(axis=0)])

    total = added_up(rows, sums, 2 + 2 * SIZE)
    n = max(total[1], 1.0)
    mean = total[2 : 2 + SIZE] / n
    spread = np.sqrt(np.maximum(total[2 + SIZE :] / n - mean**2, 0.0))
    return Scale(mean, np.where(spread > 1e-6, spread, 1.0), total[0], total[1])


def risk_parts(z: np.ndarray, positive: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over a block: three losses, their gradients, and three curvatures.

    The parts are l(g) and l(-g) of positives and l(-g) of unlabelled texts; l(g) and l(-g) share their curvature.
    """
    out = []
    p, u = z[positive], z[~positive]
    gp, gu = p @ w, u @ w
    sp, su = _sigmoid(gp), _sigmoid(gu)
    losses = [_softplus(-gp).sum(), _softplus(gp).sum(), _softplus(gu).sum()]
    slopes = [(sp - 1) @ p, sp @ p, su @ u]
    bends = [(p * (sp * (1 - sp))[:, None]).T @ p, (u * (su * (1 - su))[:, None]).T @ u]
    out = [np.array(losses), *slopes, *[b.ravel() for b in bends]]
    return np.concatenate(out)


def fit(rows: DataFrame, scale: Scale, prior: float | None) -> np.ndarray:
    """Weights of least non-negative risk for a class prior, or of a plain classifier of positives against unlabelled texts."""
    size = 3 + 3 * SIZE + 2 * SIZE * SIZE
    ridge = np.full(SIZE, RIDGE)
    ridge[0] = RIDGE / 100
    w, step, best = np.zeros(SIZE), np.zeros(SIZE), np.inf
    for _ in range(MOST_STEPS):
        at = w + step
        total = added_up(rows, lambda x, positive, at=at: risk_parts(scale(x), positive, at), size)
        counts = np.array([scale.positives, scale.positives, scale.unlabelled])
        losses = total[:3] / counts
        slopes = total[3 : 3 + 3 * SIZE].reshape(3, SIZE) / counts[:, None]
        bends = total[3 + 3 * SIZE :].reshape(2, SIZE, SIZE) / counts[1:, None, None]
        if prior is None:
            risk, slope, bend = (losses[0] + losses[2]) / 2, (slopes[0] + slopes[2]) / 2, (bends[0] + bends[1]) / 2
        else:
            negative = losses[2] - prior * losses[1]
            risk = prior * losses[0] + max(0.0, negative)
            if negative >= 0:  # the curvatures of the positives' two losses cancel
                slope, bend = prior * slopes[0] + slopes[2] - prior * slopes[1], bends[1]
            else:
                slope, bend = -(slopes[2] - prior * slopes[1]), bends[1]
        risk += 0.5 * float(ridge @ (at * at))
        if risk > best + 1e-12:
            step = step / 2
            if np.abs(step).max() < SETTLED:
                return w
            continue
        w, best = at, risk
        step = -np.linalg.solve(bend + np.diag(ridge + 1e-9), slope + ridge * at)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < SETTLED:
            break
    return w


def best_bin_prior(positives: np.ndarray, unlabelled: np.ndarray, doubt: float = 0.1) -> float:
    """Class prior from score histograms (ascending bins): the tail ratio where ratio plus confidence bound is least."""
    n_pos, n_unl = positives.sum(), unlabelled.sum()
    if not n_pos or not n_unl:
        return LARGEST_PRIOR
    tail_pos, tail_unl = (np.cumsum(h[::-1])[::-1] / h.sum() for h in (positives, unlabelled))
    bound = np.sqrt(np.log(4 / doubt) / (2 * n_unl)) + np.sqrt(np.log(4 / doubt) / (2 * n_pos))
    usable = tail_pos > 0
    ratio = tail_unl[usable] / tail_pos[usable]
    chosen = np.argmin(ratio + 1.01 * bound / tail_pos[usable])
    return float(np.clip(ratio[chosen], 0.01, LARGEST_PRIOR))


@dataclass(frozen=True)
class Model:
    """Scale, weights and the estimated class prior; no weights without positives."""

    scale: Scale
    weights: np.ndarray | None
    prior: float


def train(figures: DataFrame, trusted: DataFrame, learns: Column, workspace: Workspace) -> Model:
    """Fits on the rows of :func:`described` for which ``learns`` holds; ``trusted`` has the ids of positives."""
    unlabelled = figures.filter(learns)
    positive = unlabelled.join(trusted.select("doc_id").distinct(), "doc_id", "left_semi")
    half = (F.xxhash64("doc_id", F.lit(13)) % 2 == 0).alias("half")
    rows = unlabelled.select("figures", F.lit(False).alias("positive"), half).union(positive.select("figures", F.lit(True).alias("positive"), half))
    stored = workspace.table(rows, "training")
    scale = scale_of(stored)
    if not scale.positives:
        return Model(scale, None, 0.0)
    first, second = stored.filter("half"), stored.filter("NOT half")
    first_scale = scale_of(first)
    prior = LARGEST_PRIOR
    if first_scale.positives:
        plain = fit(first, first_scale, None)

        def histogram(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
            bins = np.minimum((_sigmoid(first_scale(x) @ plain) * _BINS).astype(int), _BINS - 1)
            return np.concatenate([np.bincount(bins[m], minlength=_BINS) for m in (positive, ~positive)]).astype(float)

        counted = added_up(second, histogram, 2 * _BINS)
        prior = best_bin_prior(counted[:_BINS], counted[_BINS:])
    return Model(scale, fit(stored, scale, prior), prior)


def scored(figures: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row of :func:`described`."""
    import pyarrow as pa

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _TEXTS_AT_ONCE):
                batch = whole.slice(at, _TEXTS_AT_ONCE)
                x = _matrix(batch.column(1))
                # added up row by row, so that equal texts get equal scores wherever they stand in a block
                found = np.zeros(len(x)) if model.weights is None else _sigmoid((model.scale(x) * model.weights).sum(axis=1))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return figures.select("doc_id", "figures").mapInArrow(score, "doc_id bigint, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``; ids whose checksum is 2 modulo 4 are held out of training."""
    workspace = workspace or Workspace(docs.sparkSession)
    held_out = in_fold(F.col("doc_id"), 4, 2)
    figures = workspace.table(described(docs), "figures")
    trusted = labels.filter((F.col("quality") == 1) & ~held_out)
    model = train(figures, trusted, ~held_out, workspace)
    predicted = (F.col("score") >= GOOD_AT).cast("int").alias("predicted")
    return scored(figures, model).select("doc_id", held_out.alias("held_out"), "score", predicted)
