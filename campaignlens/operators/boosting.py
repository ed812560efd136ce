"""Gradient boosting of many fits at once: one histogram job a level for all settings and folds.

A fit is one (learning rate, depth, left-out fold). All fits share one stored table of rows as bin numbers. A job adds up, per
(fit, node, feature, bin), rows, gradients and curvatures of the logistic loss; the sums meet by (fit, node), where
the best cut of every node is found, so the driver receives one row per fit and open node. Leaves take Newton values.
Ensembles of fewer trees are beginnings of longer ones, so a grid's largest number of trees serves the others.

Semantics: every distinct value is a bin of its own up to ``bins`` values per feature, beyond that bins follow quantiles.
Cuts lie in the middle between neighbouring values of the node. A cut's worth is that of squared gradients,
``n_l * n_r / n * (mean_l - mean_r) ** 2``; values equal to nine digits go to the first feature and lowest cut. Missing
values take the median (or most frequent group) of the fit's own training rows.

Scale: a row is a few dozen bytes plus one score per fit, rewritten every ``_TREES_PER_TABLE`` trees, so a lost executor costs at
most that many trees of one task. Histograms are bounded by fits, nodes and bins, not by rows.

A search over at most ``WHOLE_ROWS`` rows needs no job a level: rows are dealt once, in blocks, to one task per fit, which grows its whole
ensemble from the same histograms and cuts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, functions as F

from campaignlens.functions.numeric import clean
from campaignlens.settings import AGE_GROUPS, DUMMIES, NUMERIC_FEATURES, TARGET, TRANSFORMED_FEATURES
from campaignlens.sources.store import durable

BINS = 255
NO_FOLD = -1
_MISSING = 65_535
_TREES_PER_TABLE = 5
_ROWS_PER_FILE = 4096
_ROWS_AT_ONCE = 65_536
_WORTH_DIGITS = 9
_LEAST_WORTH = 1e-9
WHOLE_ROWS = 1 << 20
_ROWS_OUT = 65_536
_FOUND = ["fit", "node", "feature", "bin", "next", "n_l", "g_l", "h_l", "n_r", "g_r", "h_r"]


@dataclass(frozen=True)
class Fit:
    """One ensemble: its settings and the fold that it doesn't see (``NO_FOLD``: it sees all rows)."""

    rate: float
    depth: int
    fold: int


@dataclass
class Tree:
    """Heap-ordered nodes from 1: feature (-1 in leaves), highest bin that goes left, threshold, value, rows."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    threshold: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    rows: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 1 << (self.depth + 1)
        self.feature, self.cut, self.rows = np.full(size, -1), np.zeros(size, int), np.zeros(size, int)
        self.threshold, self.value = np.full(size, np.nan), np.zeros(size)

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """Node that each row of bins has reached so far."""
        node = np.ones(len(codes), int)
        for _ in range(self.depth):
            feature = self.feature[node]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                break
            at = node[inner]
            node[inner] = 2 * at + (codes[inner, feature[inner]] > self.cut[at])
        return node

    def split(self, found: Mapping[str, float], level: int, edges: Sequence[np.ndarray]) -> list[int]:
        """Enter a node's best cut, or its value if there is none; the children to be cut next."""
        node = found["node"]
        if found["feature"] < 0:
            self.value[node], self.rows[node] = _newton(found["g_l"], found["h_l"]), found["n_l"]
            return []
        values = edges[found["feature"]]
        middle = (values[found["bin"]] + values[found["next"]]) / 2
        self.feature[node], self.threshold[node], self.rows[node] = found["feature"], middle, found["n_l"] + found["n_r"]
        self.cut[node] = np.searchsorted(values, middle, side="right") - 1
        children = []
        for child, side in ((2 * node, "l"), (2 * node + 1, "r")):
            self.value[child], self.rows[child] = _newton(found[f"g_{side}"], found[f"h_{side}"]), found[f"n_{side}"]
            if level + 1 < self.depth and self.rows[child] > 1:
                children.append(child)
        return children


@dataclass(frozen=True)
class Bins:
    """Upper values of every feature's bins, and per left-out fold the bins that missing values take."""

    edges: tuple[np.ndarray, ...]
    filled: Mapping[int, np.ndarray]

    @property
    def offsets(self) -> np.ndarray:
        return np.cumsum([0, *[len(e) for e in self.edges]])

    def codes(self, raw: np.ndarray, fold: int) -> np.ndarray:
        """Bins of stored rows as the fit that leaves out ``fold`` sees them."""
        return np.where(raw == _MISSING, self.filled[fold], raw)


def bins_of(rows: DataFrame, statistics: DataFrame, bins: int = BINS) -> Bins:
    """Bins of the training rows; ``statistics`` has one row per left-out fold (``fit``) with medians and most frequent group."""
    medians = {r["fit"]: r for r in statistics.collect()}  # k + 1 rows
    values = rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), clean(F.col(c)).alias("x")) for i, c in enumerate(NUMERIC_FEATURES)])).alias("v"))
    counts = values.select("v.i", "v.x").where("x IS NOT NULL").groupBy("i", "x").agg(F.count(F.lit(1)).alias("n"))
    counts = durable(counts)
    distinct = {r["i"]: r["m"] for r in counts.groupBy("i").agg(F.count(F.lit(1)).alias("m")).collect()}  # one row per feature
    few = [i for i, m in distinct.items() if m <= bins]
    edges: list[np.ndarray] = [np.zeros(1)] * len(NUMERIC_FEATURES)
    found: dict[int, list[float]] = {i: [] for i in few}
    for r in counts.where(F.col("i").isin(few) if few else F.lit(False)).collect():  # at most ``bins`` per feature
        found[r["i"]].append(r["x"])
    shares = [(k + 1) / bins for k in range(bins)]
    if len(few) < len(distinct):
        weighted = values.select("v.i", "v.x").where("x IS NOT NULL")
        many = weighted.where(~F.col("i").isin(few) if few else F.lit(True)).groupBy("i").agg(F.percentile_approx("x", shares, 100_000).alias("e"))
        found |= {r["i"]: r["e"] for r in many.collect()}
    for i, c in enumerate(NUMERIC_FEATURES):
        filled = [m[f"{c}_median"] for m in medians.values() if m[f"{c}_median"] is not None]
        exact = filled if i in few else []
        if i in found:
            edges[i] = np.unique(np.array([*found[i], *exact], float))
    everything = (*edges, *[np.array([0.0, 1.0])] * len(DUMMIES))
    fills = {}
    for fold, row in medians.items():
        fill = [min(int(np.searchsorted(e, row[f"{c}_median"] or 0.0)), len(e) - 1) for c, e in zip(NUMERIC_FEATURES, edges, strict=True)]
        fills[fold] = np.array([*fill, *[int(row["age_group_mode"] == g) for g in AGE_GROUPS[1:]]])
    return Bins(everything, fills)


def binned(rows: DataFrame, bins: Bins) -> DataFrame:
    """Stored ``(id, y, fold, codes)``; ``codes`` holds the bins of the model columns as 16-bit numbers."""
    import pyarrow as pa

    numbers = len(NUMERIC_FEATURES)

    def bin_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.full((batch.num_rows, len(TRANSFORMED_FEATURES)), _MISSING, np.uint16)
            for i in range(numbers):
                x = batch.column(3 + i).to_numpy(zero_copy_only=False).astype(float)
                known = np.flatnonzero(~np.isnan(x))
                codes[known, i] = np.minimum(np.searchsorted(bins.edges[i], x[known]), len(bins.edges[i]) - 1)
            groups = np.array(batch.column(3 + numbers).to_pylist(), dtype=object)
            known = np.flatnonzero([g is not None for g in groups])
            for k, name in enumerate(AGE_GROUPS[1:]):
                codes[known, numbers + k] = groups[known] == name
            packed = [row.tobytes() for row in codes]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], ["id", "y", "fold", "codes"])

    plain = rows.select(
        "id", F.col(TARGET).cast("int").alias("y"), F.col("fold").cast("int"), *[clean(F.col(c)).alias(c) for c in NUMERIC_FEATURES], "age_group"
    )
    return plain.mapInArrow(bin_all, "id bigint, y int, fold int, codes binary")


def best_cuts(fit: np.ndarray, node: np.ndarray, cell: np.ndarray, sums: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Best cut of every (fit, node) from unsorted, possibly repeated cells.

    ``cell`` is a bin's place among all features' bins; ``sums`` has rows, gradients and curvatures as columns. Nodes without a cut have feature -1.
    """
    order = np.lexsort((cell, node, fit))
    fit, node, cell, sums = fit[order], node[order], cell[order], sums[order]
    fresh = np.concatenate(([True], (fit[1:] != fit[:-1]) | (node[1:] != node[:-1]) | (cell[1:] != cell[:-1])))
    at = np.flatnonzero(fresh)
    fit, node, cell, sums = fit[at], node[at], cell[at], np.add.reduceat(sums, at)
    feature = np.searchsorted(offsets, cell, side="right") - 1
    run = np.concatenate(([True], (fit[1:] != fit[:-1]) | (node[1:] != node[:-1]) | (feature[1:] != feature[:-1])))
    first = np.flatnonzero(run)
    number = np.cumsum(run) - 1
    upto = np.cumsum(sums, axis=0)
    left = upto - (upto[first] - sums[first])[number]
    total = np.add.reduceat(sums, first)[number]
    right = total - left
    inner = np.flatnonzero(number[1:] == number[:-1])  # a cut needs a further bin of the feature
    n_l, n_r = left[inner, 0], right[inner, 0]
    worth = n_l * n_r / (n_l + n_r) * (left[inner, 1] / n_l - right[inner, 1] / n_r) ** 2
    group = np.concatenate(([True], (fit[1:] != fit[:-1]) | (node[1:] != node[:-1])))
    owner = np.cumsum(group) - 1
    heads = np.flatnonzero(group)
    ranked = np.lexsort((cell[inner], -np.round(worth, _WORTH_DIGITS), owner[inner]))
    leading = ranked[np.concatenate(([True], owner[inner][ranked][1:] != owner[inner][ranked][:-1]))] if len(ranked) else ranked
    leading = leading[worth[leading] > _LEAST_WORTH]
    out = {"fit": fit[heads], "node": node[heads], "feature": np.full(len(heads), -1), "bin": np.zeros(len(heads), int), "next": np.zeros(len(heads), int)}
    sides = np.zeros((len(heads), 6))
    sides[:, :3] = total[heads]
    chosen, cells = owner[inner][leading], inner[leading]
    out["feature"][chosen] = feature[cells]
    out["bin"][chosen], out["next"][chosen] = (cell[c] - offsets[feature[cells]] for c in (cells, cells + 1))
    sides[chosen, :3], sides[chosen, 3:] = left[cells], right[cells]
    return out | {"sides": sides}


def _blocks(batches: Iterator, fits: Sequence[Fit], bins: Bins, recent: Sequence[Sequence[Tree]]) -> Iterator[tuple]:
    """Slices of stored rows, their bins, and their scores under every fit, recent trees included."""
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS_AT_ONCE):
            batch = whole.slice(at, _ROWS_AT_ONCE)
            raw, scores = (b"".join(v.as_py() for v in batch.column(batch.schema.get_field_index(c))) for c in ("codes", "scores"))
            raw = np.frombuffer(raw, np.uint16).reshape(batch.num_rows, -1).astype(int)
            scores = np.frombuffer(scores).reshape(batch.num_rows, -1).copy()
            for i, fit in enumerate(fits):
                if recent[i]:
                    codes = bins.codes(raw, fit.fold)
                    for tree in recent[i]:
                        scores[:, i] += fit.rate * tree.value[tree.nodes(codes)]
            yield batch, raw, scores


class Boosting:
    """Fits that grow side by side on stored rows."""

    def __init__(self, rows: DataFrame, bins: Bins, fits: Sequence[Fit]):
        self.bins, self.fits = bins, tuple(fits)
        self.stored = durable(binned(rows, bins))
        size = self.stored.count()
        counted = self.stored.groupBy("fold").agg(F.sum("y").alias("ones"), F.count(F.lit(1)).alias("n")).collect()  # one row per fold
        self.start = []
        for fit in self.fits:
            ones = sum(r["ones"] for r in counted if r["fold"] != fit.fold)
            n = sum(r["n"] for r in counted if r["fold"] != fit.fold)
            self.start.append(_start(ones, n))
        files = min(-(-size // _ROWS_PER_FILE), 2 * rows.sparkSession.sparkContext.defaultParallelism)
        self.recent: list[list[Tree]] = [[] for _ in self.fits]
        self.trees: list[list[Tree]] = [[] for _ in self.fits]
        start = np.array(self.start).tobytes()
        self.table = durable(self.stored.repartition(max(1, files), "id").withColumn("scores", F.lit(start)))

    def _level(self, growing: list[Tree], open_nodes: list[set[int]]) -> list:
        """Best cuts of all open nodes of the growing trees: one job."""
        import pyarrow as pa

        offsets, fits, bins, recent = self.bins.offsets, self.fits, self.bins, self.recent

        def cells(batches):
            for batch, raw, scores in _blocks(batches, fits, bins, recent):
                y, fold = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("y", "fold"))
                parts = []
                for i, fit in enumerate(fits):
                    if not open_nodes[i]:
                        continue
                    seen = np.flatnonzero(fold != fit.fold)
                    codes = bins.codes(raw[seen], fit.fold)
                    node = growing[i].nodes(codes)
                    still = np.isin(node, list(open_nodes[i]))
                    codes, node, seen = codes[still], node[still], seen[still]
                    p = 0.5 * np.tanh(0.5 * scores[seen, i]) + 0.5
                    place = ((node[:, None] * offsets[-1]) + codes + offsets[:-1]).ravel()
                    found, at = np.unique(place, return_inverse=True)
                    width = codes.shape[1]
                    gradient, bend = y[seen] - p, p * (1 - p)
                    sums = [np.bincount(at, None if w is None else np.repeat(w, width), len(found)) for w in (None, gradient, bend)]
                    parts.append((np.full(len(found), i), found // offsets[-1], found % offsets[-1], *sums))
                if parts:
                    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                    made = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64()), strict=True)]
                    yield pa.RecordBatch.from_arrays(made, ["fit", "node", "cell", "n", "g", "h"])

        def cuts(batches):
            held = list(batches)  # cells of this task's nodes: bounded by nodes and bins, times tasks
            if not any(b.num_rows for b in held):
                return
            table = pa.Table.from_batches(held)
            fit, node, cell, *sums = (table.column(c).to_numpy() for c in ("fit", "node", "cell", "n", "g", "h"))
            found = best_cuts(fit, node, cell, np.stack(sums, axis=1), offsets)
            made = [pa.array(found[c], pa.int64()) for c in ("fit", "node", "feature", "bin", "next")]
            made += [pa.array(found["sides"][:, k], pa.float64()) for k in range(6)]
            yield pa.RecordBatch.from_arrays(made, names)

        names = _FOUND
        schema = ", ".join(f"{n} bigint" for n in names[:5]) + ", " + ", ".join(f"{n} double" for n in names[5:])
        summed = self.table.mapInArrow(cells, "fit int, node bigint, cell int, n double, g double, h double")
        return summed.repartition("fit", "node").mapInArrow(cuts, schema).collect()  # one row per fit and open node

    def grow_tree(self) -> None:
        """One more tree for every fit."""
        growing = [Tree(fit.depth) for fit in self.fits]
        open_nodes = [{1} for _ in self.fits]
        for level in range(max(fit.depth for fit in self.fits)):
            if not any(open_nodes):
                break
            found = self._level(growing, open_nodes)
            open_nodes = [set() for _ in self.fits]
            for r in found:
                open_nodes[r["fit"]].update(growing[r["fit"]].split(r, level, self.bins.edges))
        for i, tree in enumerate(growing):
            tree.value[tree.feature >= 0] = 0.0
            self.trees[i].append(tree)
            self.recent[i].append(tree)
        if len(self.recent[0]) >= _TREES_PER_TABLE:
            self.settle()

    def settle(self) -> None:
        """Write rows with their scores so far, so that recent trees needn't be applied again."""
        import pyarrow as pa

        fits, bins, recent = self.fits, self.bins, self.recent

        def add(batches):
            for batch, _, scores in _blocks(batches, fits, bins, recent):
                packed = pa.array([row.tobytes() for row in np.ascontiguousarray(scores)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], packed], ["id", "y", "fold", "codes", "scores"])

        if any(self.recent):
            self.table = durable(self.table.mapInArrow(add, self.table.schema))
            self.recent = [[] for _ in self.fits]

    def held_out_scores(self) -> DataFrame:
        """``(fit, fold, id, y, p)``: every row under the fits that haven't seen it."""
        import pyarrow as pa

        self.settle()
        folds = np.array([fit.fold for fit in self.fits])

        def read(batches):
            for batch in batches:
                fold = batch.column(2).to_numpy()
                scores = np.frombuffer(b"".join(v.as_py() for v in batch.column(4))).reshape(batch.num_rows, -1)
                row, fit = np.nonzero(fold[:, None] == folds[None, :])
                p = 0.5 * np.tanh(0.5 * scores[row, fit]) + 0.5
                made = [pa.array(fit, pa.int32()), *[batch.column(c).take(pa.array(row)) for c in (2, 0, 1)], pa.array(p, pa.float64())]
                yield pa.RecordBatch.from_arrays(made, ["fit", "fold", "id", "y", "p"])

        return self.table.mapInArrow(read, "fit int, fold int, id bigint, y int, p double")

    def tree_table(self, number: int) -> list[tuple]:
        """Nodes of every fit's tree ``number``: (fit, path, feature, threshold, rows, value)."""
        out = []
        for i, trees in enumerate(self.trees):
            tree = trees[number]
            for node in np.flatnonzero(tree.rows > 0):
                path = "".join("LR"[int(b)] for b in bin(node)[3:])
                inner = tree.feature[node] >= 0
                out.append((
                    i, path, TRANSFORMED_FEATURES[tree.feature[node]] if inner else None,
                    float(tree.threshold[node]) if inner else None, int(tree.rows[node]), None if inner else float(tree.value[node]),
                ))
        return out


def _newton(gradient: float, bend: float) -> float:
    return gradient / bend if abs(bend) > 1e-150 else 0.0


def _start(ones: float, n: float) -> float:
    share = min(max(ones / max(n, 1), 1e-12), 1 - 1e-12)
    return float(np.log(share / (1 - share)))


def _whole_tree(codes: np.ndarray, gradient: np.ndarray, bend: np.ndarray, depth: int, bins: Bins) -> tuple[Tree, np.ndarray]:
    """A tree on rows ``codes[feature, row]``, and the node that each row ends in."""
    tree, offsets = Tree(depth), bins.offsets
    node, open_nodes = np.ones(codes.shape[1], int), [1]
    for level in range(depth):
        number = np.full(len(tree.feature), -1)
        number[open_nodes] = np.arange(len(open_nodes))
        rows = np.flatnonzero(number[node] >= 0)
        if not len(rows):
            break
        of = number[node[rows]]
        sums = np.zeros((3, len(open_nodes), offsets[-1]))
        weights = (None, gradient[rows], bend[rows])
        for f, size in enumerate(np.diff(offsets)):
            place = of * size + codes[f, rows]
            for k, w in enumerate(weights):
                sums[k, :, offsets[f] : offsets[f + 1]] = np.bincount(place, w, len(open_nodes) * size).reshape(-1, size)
        at, cell = np.nonzero(sums[0])
        found = best_cuts(np.zeros(len(at), int), np.array(open_nodes)[at], cell, sums[:, at, cell].T, offsets)
        columns = [*(found[c].tolist() for c in _FOUND[:5]), *found["sides"].T.tolist()]
        open_nodes = sorted(c for r in zip(*columns, strict=True) for c in tree.split(dict(zip(_FOUND, r, strict=True)), level, bins.edges))
        rows = rows[tree.feature[node[rows]] >= 0]
        stood = node[rows]
        node[rows] = 2 * stood + (codes[tree.feature[stood], rows] > tree.cut[stood])
    tree.value[tree.feature >= 0] = 0.0
    return tree, node


def whole_ensemble(raw: np.ndarray, y: np.ndarray, fold: np.ndarray, fit: Fit, bins: Bins, stops: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    """``(trees, p)`` after every number of trees of ``stops``, ascending: probabilities of the rows of the fit's left-out fold."""
    codes, seen = bins.codes(raw, fit.fold), fold != fit.fold
    held, codes, y = codes[~seen], np.ascontiguousarray(codes[seen].T.astype(np.int32)), y[seen]
    start = _start(y.sum(), len(y))
    scores, out = np.full(len(y), start), np.full(len(held), start)
    for trees in range(1, max(stops) + 1):
        p = 0.5 * np.tanh(0.5 * scores) + 0.5
        tree, node = _whole_tree(codes, y - p, p * (1 - p), fit.depth, bins)
        scores += fit.rate * tree.value[node]
        out += fit.rate * tree.value[tree.nodes(held)]
        if trees in stops:
            yield trees, 0.5 * np.tanh(0.5 * out) + 0.5


def whole_scores(rows: DataFrame, bins: Bins, fits: Sequence[Fit], stops: Sequence[int]) -> DataFrame:
    """``(fit, trees, fold, id, y, p)``: held-out scores of every fit after every number of trees of ``stops``, one task per fit."""
    import pyarrow as pa

    order = sorted(range(len(fits)), key=lambda i: -fits[i].depth)  # long tasks first

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [batch.column(i).to_numpy().astype(kind).tobytes() for i, kind in enumerate((np.int64, np.int32, np.int32))]
            blocks.append(b"".join(batch.column(3).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blocks], ["id", "y", "fold", "codes"])

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list[dict]] = {}
        for batch in batches:
            for block in batch.to_pylist():
                blocks.setdefault(block["fit"], []).append(block)
        for i, found in blocks.items():
            ids, y, fold, raw = (np.frombuffer(b"".join(b[c] for b in found), kind) for c, kind in (("id", np.int64), ("y", np.int32), ("fold", np.int32), ("codes", np.uint16)))
            held = np.flatnonzero(fold == fits[i].fold)
            for trees, p in whole_ensemble(raw.reshape(len(ids), -1), y, fold, fits[i], bins, stops):
                for at in range(0, len(held), _ROWS_OUT):
                    cut = held[at : at + _ROWS_OUT]
                    same = [pa.array(np.full(len(cut), v), pa.int32()) for v in (i, trees, fits[i].fold)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(ids[cut]), pa.array(y[cut]), pa.array(p[at : at + _ROWS_OUT])], ["fit", "trees", "fold", "id", "y", "p"])

    packed = binned(rows, bins).mapInArrow(pack, "id binary, y binary, fold binary, codes binary")
    tasks = F.array(*[F.struct(F.lit(k).alias("task"), F.lit(i).alias("fit")) for k, i in enumerate(order)])
    dealt = packed.withColumn("t", F.explode(tasks)).select("id", "y", "fold", "codes", "t.task", "t.fit").repartitionById(len(fits), "task")
    return dealt.mapInArrow(grown, "fit int, trees int, fold int, id bigint, y int, p double")


def grid_scores(rows: DataFrame, statistics: DataFrame, grid: Sequence[Mapping[str, object]], k: int = 5, bins: int = BINS) -> DataFrame:
    """``(position, fold, id, y, p)``: out-of-fold scores of every setting; settings that differ in the number of trees share fits."""
    shapes = list(dict.fromkeys((float(p["learning_rate"]), int(p["max_depth"])) for p in grid))
    fits = [Fit(rate, depth, fold) for rate, depth in shapes for fold in range(k)]
    found = bins_of(rows, statistics, bins)
    stops = sorted({int(p["n_estimators"]) for p in grid})
    odd = F.col("id").isNull() | F.col(TARGET).isNull() | F.col("fold").isNull()
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(odd).alias("odd")).first()
    if size["rows"] <= WHOLE_ROWS and not size["odd"]:
        places = F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(shapes.index((float(p["learning_rate"]), int(p["max_depth"])))).alias("shape"), F.lit(int(p["n_estimators"])).alias("trees"))
            for i, p in enumerate(grid)
        ])
        mine = F.filter(places, lambda s: (s["shape"] == F.floor(F.col("fit") / k)) & (s["trees"] == F.col("trees")))
        return whole_scores(rows, found, fits, stops).withColumn("s", F.explode(mine)).select("s.position", "fold", "id", "y", "p")
    model = Boosting(rows, found, fits)
    parts = None
    for trees in range(1, stops[-1] + 1):
        model.grow_tree()
        if trees in stops:
            scores = model.held_out_scores()
            for position, p in enumerate(grid):
                if int(p["n_estimators"]) == trees:
                    first = shapes.index((float(p["learning_rate"]), int(p["max_depth"]))) * k
                    part = scores.where(F.col("fit").between(first, first + k - 1)).select(F.lit(position).alias("position"), "fold", "id", "y", "p")
                    parts = part if parts is None else parts.union(part)
    return parts
