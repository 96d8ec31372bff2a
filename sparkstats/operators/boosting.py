"""Gradient-boosted trees on binned features, with the softmax loss.

A round grows one tree per class, level by level. A pass over the rows sums the gradients and curvatures of each
(class, node, feature, bin); tasks that hold a feature of a class find its best cut of every node, and only those
reach the driver. Gradients are rounded to whole multiples of 1 / SCALE, so that sums are exact: the trees do not
depend on how rows are partitioned, nor on retries. Rows are stored binned, a byte per feature, with their scores;
those of the same bins and class, which no tree tells apart, are one row with their number. They are written anew every
few rounds, so that a pass walks few trees and no plan contains an earlier one. Where they are so few that one task sums a
level sooner than a Spark job begins, one task grows all trees, by the same sums.
"""

from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import vectors
from ..sources.models import Written

#: Gradients and losses are whole multiples of 1 / SCALE.
SCALE = 1 << 24
#: The cut of a node that is not split: every bin is at its left.
NONE = 255
#: Rows x features x classes that one task grows all trees from.
ONE_TASK = 1 << 24


@dataclass
class Tree:
    """A complete tree in heap order: the children of node i are 2i + 1 and 2i + 2. Rows go left up to the cut's bin."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> "Tree":
        inner = (1 << depth) - 1
        return Tree(np.zeros(inner, np.int64), np.full(inner, NONE, np.int64), np.zeros(2 * inner + 1))

    def node(self, codes: np.ndarray, depth: int) -> np.ndarray:
        at, row, flat = np.zeros(len(codes), np.int64), np.arange(len(codes)) * codes.shape[1], codes.reshape(-1)
        for _ in range(depth):
            at = 2 * at + 1 + (flat.take(row + self.feature.take(at)) > self.cut.take(at))
        return at


@dataclass
class Model:
    """Scores of a row: `base` plus `step` times the leaf values of every round's trees, one tree per class."""

    edges: list[np.ndarray]
    base: np.ndarray
    depth: int
    step: float
    rounds: list[list[Tree]] = field(default_factory=list)
    #: Mean loss of the training rows before each round.
    losses: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Append `scores` (an array over classes) and `prediction` (the first class of the highest score).

        A row whose features are null is refused, as everywhere in `vectors`; NaN lies in the lowest bin.
        """
        held = df.sparkSession.sparkContext.broadcast(self)

        def run(x):
            m = held.value
            if not len(x):
                return np.zeros((0, len(m.base))), np.zeros(0, np.int32)
            s = m.base + _walked(m.rounds, codes_of(x, m.edges), m.depth, m.step, len(m.base))
            return s, s.argmax(axis=1)
        return vectors.map_vectors(df, run, [("scores", T.ArrayType(T.DoubleType())), ("prediction", T.IntegerType())], features)

    def table(self, spark) -> DataFrame:
        """(round, class, node, feature, threshold, value): nodes in heap order; a split has a feature, a leaf a value."""
        rows = []
        for n, trees in enumerate(self.rounds):
            for k, t in enumerate(trees):
                for i in range(len(t.value)):
                    split = i < len(t.cut) and t.cut[i] != NONE
                    leaf = i >= len(t.cut)
                    rows.append((n, k, i, int(t.feature[i]) if split else None, float(self.edges[t.feature[i]][t.cut[i]]) if split else None,
                                 float(t.value[i]) if leaf else None))
        return spark.createDataFrame(rows, "round int, class int, node int, feature int, threshold double, value double")


def bin_edges(df: DataFrame, dim: int, bins: int = 64, features: str = "features", accuracy: int = 10_000) -> list[np.ndarray]:
    """Upper edges of the bins of each feature: approximate quantiles, each once. NaN and null do not count."""
    marks = [i / bins for i in range(1, bins)]
    x = [F.get(features, F.lit(j)) for j in range(dim)]
    found = df.agg(*[F.percentile_approx(F.when(~F.isnan(v), v), marks, accuracy).alias(f"e{j}") for j, v in enumerate(x)]).first()
    return [np.unique(np.array(e or [], dtype=float)) for e in found]


def codes_of(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each value, the number of edges below it; NaN lies in the lowest."""
    out = np.zeros((len(x), len(edges)), np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.where(np.isnan(x[:, j]), 0, np.searchsorted(e, x[:, j], side="left"))
    return out


def _walked(rounds, codes, depth, step, classes) -> np.ndarray:
    s = np.zeros((len(codes), classes))
    for trees in rounds:
        for k, t in enumerate(trees):
            s[:, k] += step * t.value[t.node(codes, depth)]
    return s


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def slopes(s: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gradient, curvature, loss) of rows with scores s and classes y, in units of 1 / SCALE."""
    p = softmax(s)
    hit = np.arange(s.shape[1]) == y[:, None]
    return (np.rint((p - hit) * SCALE), np.rint(p * (1 - p) * SCALE), np.rint(-np.log(np.maximum(p[hit], 1e-300)) * SCALE))


def _blocks(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    return codes, batch.column("y").to_numpy(), batch.column("n").to_numpy(), vectors.as_matrix(batch.column("scores"))


def _added(key: np.ndarray, values: np.ndarray, size: int, exact: bool) -> np.ndarray:
    """Sums of whole numbers by key; `exact`: they all fit a double."""
    if exact:
        return np.bincount(key, values, size).astype(np.int64)
    out = np.zeros(size, np.int64)
    np.add.at(out, key, values)
    return out


def best_cuts(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, ...]:
    """(cut, gain, g and h at its left, g and h of all) of each node, from its sums per bin: the first of the best cuts."""
    left_g, left_h = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
    all_g, all_h = left_g[:, -1:], left_h[:, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h
    worth = lambda a, b: (a / SCALE) ** 2 / (b / SCALE + ridge)
    gain = np.where((left_h > 0) & (right_h > 0), worth(left_g, left_h) + worth(right_g, right_h) - worth(all_g, all_h), 0.0)
    cut = gain.argmax(axis=1)
    at = np.arange(len(g)), cut
    return cut, gain[at], left_g[at], left_h[at], all_g[:, 0], all_h[:, 0]


SUMS = "k int, j int, s array<bigint>"
CUTS = "k int, j int, node int, cut int, gain double, lg bigint, lh bigint, g bigint, h bigint"


def _summed(batches):
    """Add up the arrays of each (k, j)."""
    total: dict = {}
    for batch in batches:
        for k, j, s in zip(batch.column("k").to_pylist(), batch.column("j").to_pylist(), batch.column("s")):
            v = s.values.to_numpy()
            total[k, j] = total[k, j] + v if (k, j) in total else v
    return total


def _sum_rows(total: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in total], pa.int32()), pa.array([j for _, j in total], pa.int32()),
                                       pa.array(list(total.values()), pa.list_(pa.int64()))], names=["k", "j", "s"])


def _level(state: DataFrame, model: Model, fresh: list[list[Tree]], grown: list[Tree], level: int, bins: int, ridge: float, parts: int) -> list:
    """The best cut of every node of a level for each class and feature; (k = -1) the loss and the number of rows.

    A task holds classes x features x nodes x bins sums; about the root of the number of tasks add those up first.
    """
    nodes, first = 1 << level, (1 << level) - 1
    held = state.sparkSession.sparkContext.broadcast((fresh, grown, model.depth, model.step, len(model.base), len(model.edges)))

    def histograms(batches):
        fresh_, grown_, depth, step, classes, dim = held.value
        total, lost, rows = np.zeros((classes, dim, 2, nodes * bins), np.int64), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, y, n, scores = _blocks(batch)
            g, h, loss = slopes(scores + _walked(fresh_, codes, depth, step, classes), y)
            g, h = (x.astype(np.int64) * n[:, None] for x in (g, h))
            lost, rows = lost + int((loss.astype(np.int64) * n).sum()), rows + int(n.sum())
            exact = int(n.sum()) * SCALE < 1 << 53
            for k, tree in enumerate(grown_):
                at = (tree.node(codes, level) - first) * bins
                for j in range(dim):
                    key = at + codes[:, j]
                    total[k, j, 0] += _added(key, g[:, k], nodes * bins, exact)
                    total[k, j, 1] += _added(key, h[:, k], nodes * bins, exact)
        if rows:
            found = {(k, j): total[k, j].reshape(-1) for k in range(classes) for j in range(dim)}
            yield _sum_rows(found | {(-1, 0): np.array([lost, rows])})

    def added(batches):
        total = _summed(batches)
        if total:
            yield _sum_rows(total)

    def cuts(batches):
        for (k, j), s in _summed(batches).items():
            if k < 0:
                columns = [np.array([x]) for x in (0, 0, 0.0, 0, 0, s[0], s[1])]
            else:
                g, h = s.reshape(2, nodes, bins)
                columns = [np.arange(nodes), *best_cuts(g, h, ridge)]
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            same = [pa.array(np.full(len(columns[0]), x), pa.int32()) for x in (k, j)]
            yield pa.RecordBatch.from_arrays([*same, *[pa.array(c).cast(t) for c, t in zip(columns, kinds)]], names=[c.split()[0] for c in CUTS.split(", ")])

    sums = state.mapInArrow(histograms, SUMS).repartition(max(1, isqrt(parts)), F.spark_partition_id()).mapInArrow(added, SUMS)
    found = sums.repartition("k", "j").mapInArrow(cuts, CUTS).collect()
    held.unpersist()
    return found


def _settle(tree: Tree, at: int, ridge: float, j: int, cut: int, gain: float, lg: int, lh: int, g: int, h: int) -> None:
    """Split node `at` by its best cut, or make a leaf of it."""
    leaf = lambda g, h: -g / SCALE / (h / SCALE + ridge) if h else 0.0
    if gain > 1e-9:
        tree.feature[at], tree.cut[at] = j, cut
        tree.value[2 * at + 1:2 * at + 3] = leaf(lg, lh), leaf(g - lg, h - lh)
    else:
        tree.value[2 * at + 1] = leaf(g, h)


def _grown(codes: np.ndarray, counts: np.ndarray, base: np.ndarray, rounds: int, depth: int, step: float, bins: int, ridge: float,
           tolerance: float, rewrite: int):
    """(loss before the round, trees) of each round, from rows of bins and their numbers by class. Scores are added up in the order of
    the passes in many tasks, so that the trees are the same."""
    (rows, dim), classes = codes.shape, counts.shape[1]
    flat, row, n = np.ascontiguousarray(codes.T).reshape(-1), np.arange(rows), counts.sum(axis=1)
    columns = [codes[:, j].astype(np.int64) for j in range(dim)]
    exact = int(n.sum()) * SCALE < 1 << 53
    scores, fresh, before = np.tile(base, (rows, 1)), np.zeros((rows, classes)), None
    for i in range(rounds):
        if i and i % rewrite == 0:
            scores, fresh = scores + fresh, np.zeros((rows, classes))
        p = softmax(scores + fresh)
        whole = lambda x: np.rint(x * SCALE).astype(np.int64)
        g, h = (n[:, None] - counts) * whole(p) + counts * whole(p - 1), n[:, None] * whole(p * (1 - p))
        loss = int((counts * whole(-np.log(np.maximum(p, 1e-300)))).sum()) / SCALE / int(n.sum())
        trees = []
        for k in range(classes):
            tree, at, gk, hk = Tree.empty(depth), np.zeros(rows, np.int64), np.ascontiguousarray(g[:, k]), np.ascontiguousarray(h[:, k])
            if exact:
                gk, hk = gk.astype(float), hk.astype(float)
            for level in range(depth):
                nodes, first, found = 1 << level, (1 << level) - 1, []
                for c in columns:
                    key = at * bins + c
                    found.append(best_cuts(*(_added(key, x, nodes * bins, exact).reshape(nodes, bins) for x in (gk, hk)), ridge))
                best = np.stack([f[1] for f in found]).argmax(axis=0).tolist()
                cuts = [[x.tolist() for x in f] for f in found]
                for node, j in enumerate(best):
                    _settle(tree, first + node, ridge, j, *(x[node] for x in cuts[j]))
                here = first + at
                at = 2 * at + (flat.take(tree.feature.take(here) * rows + row) > tree.cut.take(here))
            fresh[:, k] += step * tree.value.take(at + (1 << depth) - 1)
            trees.append(tree)
        yield loss, trees
        if before is not None and before - loss < tolerance:
            break
        before = loss


def _in_one_task(state: DataFrame, model: Model, *how) -> None:
    """All rounds in one task of the executors."""
    base, depth, step, dim = model.base, model.depth, model.step, len(model.edges)

    def grow(batches):
        table = pa.Table.from_batches([b.select(["codes", "y", "n"]) for b in batches if b.num_rows]).combine_chunks()
        coded = table["codes"].combine_chunks().dictionary_encode()
        codes = np.frombuffer(b"".join(coded.dictionary.to_pylist()), np.uint8).reshape(-1, dim)
        counts = np.zeros((len(codes), len(base)), np.int64)
        np.add.at(counts, (coded.indices.to_numpy(), table["y"].to_numpy()), table["n"].to_numpy())
        rounds, *rest = how
        for i, (loss, trees) in enumerate(_grown(codes, counts, base, rounds, depth, step, *rest)):
            arrays = [pa.array([getattr(t, a) for t in trees]) for a in ("feature", "cut", "value")]
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(trees), kind) for x, kind in ((i, pa.int32()), (loss, pa.float64()))] + [pa.array(range(len(trees)), pa.int32()), *arrays],
                                             names=["i", "loss", "k", "feature", "cut", "value"])
    found = state.coalesce(1).mapInArrow(grow, "i int, loss double, k int, feature array<long>, cut array<long>, value array<double>").collect()
    for r in sorted(found, key=lambda r: (r["i"], r["k"])):
        if r["k"] == 0:
            model.losses.append(r["loss"])
            model.rounds.append([])
        model.rounds[-1].append(Tree(*(np.array(r[a]) for a in ("feature", "cut", "value"))))


def fit(df: DataFrame, dim: int, classes: int, rounds: int = 500, depth: int = 6, step: float = 0.1, bins: int = 64, ridge: float = 1.0,
        features: str = "features", label: str = "label", edges: list | None = None, tolerance: float = 0.0, rewrite: int = 8, one_task: int = ONE_TASK) -> Model:
    """Boosted trees for classes 0 .. classes - 1.

    A cut is the one of the highest gain, of equal ones that of the first feature and lowest bin; a node without a
    gain above 1e-9 is a leaf. A leaf's value is -G / (H + ridge). Rounds end early once the mean loss falls by less
    than `tolerance` in one. At most 255 bins; `edges` gives their upper edges, else they are approximate quantiles. Rows with a null
    vector or label are left out, repeated rows count each time; a null or NaN element lies in the lowest bin; other
    classes are refused. A table without rows gives a model without trees and equal scores. The driver holds the trees.
    Up to `one_task` different rows x features x classes, one task grows all trees; they are the same.
    """
    if not 1 < bins < 256:
        raise ValueError("bins must lie between 2 and 255")
    x = F.transform(F.col(features), lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    src = df.select(x.alias("x"), F.col(label).cast("int").alias("y")).dropna()
    counts = {r["y"]: r["n"] for r in src.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if any(not 0 <= y < classes for y in counts):
        raise ValueError(f"classes must be 0 to {classes - 1}")
    edges = bin_edges(src, dim, bins, "x") if edges is None else [np.asarray(e, dtype=float) for e in edges]
    if any(len(e) >= bins for e in edges):
        raise ValueError("there are fewer edges than bins")
    n = sum(counts.values())
    base = np.log([max(counts.get(k, 0), 0.5) / n for k in range(classes)]) if n else np.zeros(classes)
    model = Model(edges, base, depth, step)
    if not n:
        return model

    def binned(batches):
        for batch in batches:
            if batch.num_rows:
                codes = codes_of(vectors.as_matrix(batch.column("x")), edges)
                same = pa.table({"codes": pa.array([c.tobytes() for c in codes], pa.binary()), "y": batch.column("y")}).group_by(["codes", "y"]).aggregate([([], "count_all")])
                yield from same.rename_columns(["codes", "y", "n"]).to_batches()
    columns = "codes binary, y int, n long, scores array<double>"
    alike = src.mapInArrow(binned, "codes binary, y int, n long").groupBy("codes", "y").agg(F.sum("n").alias("n"))
    parts = max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    start = alike.withColumn("scores", F.array(*[F.lit(float(v)) for v in base])).repartition(parts, "codes")
    state, fresh = Written.of(start, "boosting"), []
    if state.frame.count() * dim * classes <= one_task:
        _in_one_task(state.frame, model, rounds, bins, ridge, tolerance, rewrite)
        state.delete()
        return model
    parts = state.frame.rdd.getNumPartitions()
    for _ in range(rounds):
        if len(fresh) == rewrite:
            state = state.replaced(_scored(state.frame, fresh, model, columns))
            fresh = []
        grown = [Tree.empty(depth) for _ in range(classes)]
        for level in range(depth):
            best: dict = {}
            for r in _level(state.frame, model, fresh, grown, level, bins, ridge, parts):
                if r["k"] < 0:
                    loss = r["g"] / SCALE / r["h"]
                else:
                    best[r["k"], r["node"]] = min(best.get((r["k"], r["node"]), r), r, key=lambda c: (-c["gain"], c["j"]))
            for (k, node), r in best.items():
                _settle(grown[k], (1 << level) - 1 + node, ridge, *(r[c] for c in ("j", "cut", "gain", "lg", "lh", "g", "h")))
        model.losses.append(loss)
        model.rounds.append(grown)
        fresh.append(grown)
        if len(model.losses) > 1 and model.losses[-2] - loss < tolerance:
            break
    state.delete()
    return model


def _scored(state: DataFrame, fresh: list[list[Tree]], model: Model, columns: str) -> DataFrame:
    depth, step, classes = model.depth, model.step, len(model.base)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                codes, _, _, scores = _blocks(batch)
                scores = vectors.as_list_column(scores + _walked(fresh, codes, depth, step, classes))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("codes", "y", "n")), scores], names=["codes", "y", "n", "scores"])
    return state.mapInArrow(run, columns)
