"""Exact k-nearest-neighbour joins and their votes.

Training rows are assigned to the nearest of a few pivots (a cell). A query
first searches its home cells, which bounds the distance of its k-th
neighbour, and then only cells that the triangle inequality cannot rule out.
Cells are cut into blocks, so a crowded cell becomes many small tasks; a block
pair returns at most k rows per query and never its pairs. Copies of a vector
collapse to their k lowest ids before the search, which no result can miss.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions import rng, vectors
from ..sources.models import materialize
from .cluster import lp_distances
from .inverted import packed, unpacked

DECIMALS = 9
QUERY_CHUNK = 1024
#: Most rows of a screened column of queries; steps of a rounded element; elements that are compared one by one at once.
TILE, STEPS, EXACT = 128, 127, 1 << 20


class Dense:
    """L_p distance between array columns.

    In more than 8 dimensions a search screens the pairs of a block by lower bounds, which cost a few operations on
    small numbers a pair, and computes the distances of those that could be among the k nearest.
    """

    def __init__(self, p: int = 2, features: str = "features"):
        self.p, self.columns = p, [features]

    def stack(self, pdf: pd.DataFrame):
        return np.array(pdf[self.columns[0]].tolist(), dtype=float)

    def screen(self, a: np.ndarray, b: np.ndarray):
        """A `Screen` of the pairs of two blocks; None where plain distances are as good."""
        if not len(a) or not len(b) or a.shape[1] != b.shape[1] or not 8 < a.shape[1] <= 65535 // STEPS or self.p not in (1, 2, 3):
            return None
        # Neither NaN nor beyond single precision.
        return Screen(a, b, self.p) if np.abs(a).max() < 1e15 and np.abs(b).max() < 1e15 else None

    def distances(self, a, b) -> np.ndarray:
        if self.p == 2 and len(a) and a.shape[1] > 8:
            # Cheap inner products first, then plain differences where they cancel.
            d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
            close = np.argwhere(d2 < 1e-4 * (1 + np.abs(d2).max()))
            d2 = np.maximum(d2, 0)
            for s in range(0, len(close), 65536):
                i, j = close[s:s + 65536].T
                d2[i, j] = ((a[i] - b[j]) ** 2).sum(1)
            return np.sqrt(d2)
        return lp_distances(a, b, self.p)


class Screen:
    """Lower bounds of the L_p distances between two blocks, as sums of powers.

    p = 1: elements are rounded to STEPS steps, and the sum of the differences follows from that of the smaller elements;
    what a row lost by rounding is taken off. p = 2: squares from inner products in single precision, less their largest
    error. p = 3: the same, as |d|_p >= |d|_2 * dim ** (1 / p - 1 / 2).
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, p: int):
        self.a, self.b, self.p = a, b, p
        dim = a.shape[1]
        if p == 1:
            low = min(a.min(), b.min())
            step = max(a.max(), b.max()) - low
            step = step / STEPS if step > 0 else 1.0
            (qa, less_a), (qb, less_b) = self._rounded(a, low, step), self._rounded(b, low, step)
            self.bound = (less_a[:, None] + less_b[None, :]) - np.float32(2 * step) * _smaller(qa, qb)
        else:
            error = 1 - (dim + 8) * 2.0 ** -21
            norms = [((x * x).sum(1) * error).astype(np.float32) for x in (a, b)]
            self.bound = (-2 * a.astype(np.float32)) @ b.astype(np.float32).T
            self.bound += norms[0][:, None]
            self.bound += norms[1][None, :]

    @staticmethod
    def _rounded(x: np.ndarray, low: float, step: float) -> tuple[np.ndarray, np.ndarray]:
        """(steps by dimension, their sum as a length less what the row lost and the error of single precision)."""
        q = np.rint((x - low) / step)
        size = step * q.sum(1)
        lost = np.abs(x - (low + step * q)).sum(1) + 1e-6 * (size + step * STEPS * x.shape[1])
        return np.ascontiguousarray(q.T.astype(np.uint8)), (size - lost).astype(np.float32)

    def pairs(self, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of both blocks whose distance may be at most `reach` of the first one; NaN: any."""
        top = (reach + 2 * 10.0 ** -DECIMALS) * (1 + 1e-5)
        top = top if self.p == 1 else top * top * max(1.0, self.a.shape[1] ** (1 - 2 / self.p))
        with np.errstate(over="ignore"):
            top = top.astype(np.float32)[:, None]
        return np.divmod(np.flatnonzero(~(self.bound > top)), len(self.b))

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Distances of pairs of rows, from plain differences."""
        out, width = np.empty(len(i)), max(1, EXACT // self.a.shape[1])
        for s in range(0, len(i), width):
            d = np.abs(self.a[i[s:s + width]] - self.b[j[s:s + width]])
            out[s:s + width] = (d if self.p == 1 else d * d if self.p == 2 else d * d * d).sum(1)
        return np.round(out ** (1.0 / self.p), DECIMALS)

    def nearest(self, k: int, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, row, distance) of pairs among which are all that come in, and `best`, each row's k least distances so far."""
        n, m = self.bound.shape
        reach = best[:, -1].copy()
        new = np.flatnonzero(np.isinf(reach))
        if len(new) and m >= k:
            # No k-th distance yet: that of the rows of the k least bounds will do.
            pick = np.argpartition(self.bound[new], k - 1, axis=1)[:, :k]
            reach[new] = self.exact(np.repeat(new, k), pick.ravel()).reshape(-1, k).max(1)
        i, j = self.pairs(reach)
        d = self.exact(i, j)
        near = d <= reach[i]
        i, j, d = i[near], j[near], d[near]
        row, all_ = np.concatenate([np.repeat(np.arange(n), k), i]), np.concatenate([best.ravel(), d])
        order = np.lexsort((all_, row))
        first = np.searchsorted(row[order], np.arange(n))
        best = all_[order][first[:, None] + np.arange(k)]
        near = d <= best[i, -1]
        return i[near], j[near], d[near], best


def _smaller(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum over dimensions (rows) of the smaller of two elements, for all pairs of columns."""
    out = np.empty((a.shape[1], b.shape[1]), np.uint16)
    one, two = np.empty((2, TILE, b.shape[1]), np.uint8)
    for s in range(0, a.shape[1], TILE):
        here, sums = a[:, s:s + TILE, None], out[s:s + TILE]
        x, y = one[:len(sums)], two[:len(sums)]
        sums[:] = 0
        for d in range(0, len(a), 2):
            np.minimum(here[d], b[d], out=x)
            if d + 1 < len(a):
                np.minimum(here[d + 1], b[d + 1], out=y)
                np.add(x, y, out=x)  # two of at most STEPS fit a byte
            np.add(sums, x, out=sums)
    return out


class Sparse:
    """Euclidean distance between unit-length sparse rows: sorted term numbers and weights."""

    BYTES = 128 << 20

    def __init__(self, terms: str = "terms", weights: str = "weights"):
        self.columns = [terms, weights]

    def stack(self, pdf: pd.DataFrame):
        """(rows, row number, term, weight) with one entry per non-zero, in row order."""
        idx = [np.asarray(v, dtype=np.int64) for v in pdf[self.columns[0]]]
        val = [np.asarray(v, dtype=float) for v in pdf[self.columns[1]]]
        rows = np.repeat(np.arange(len(idx)), [len(v) for v in idx])
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return len(idx), rows, cat(idx, np.int64), cat(val, float)

    def distances(self, a, b) -> np.ndarray:
        (n, ra, ia, va), (m, rb, ib, vb) = a, b
        shared = np.intersect1d(ia, ib)
        dots = np.zeros((n, m))
        if len(shared):
            row, term, value = self._within(shared, ra, ia, va)
            col, place, weight = self._within(shared, rb, ib, vb)
            start = np.searchsorted(row, np.arange(n + 1))
            width = max(16, self.BYTES // (8 * len(shared)))
            for s in range(0, m, width):
                lo, hi = np.searchsorted(col, [s, s + width])
                block = np.zeros((len(shared), min(width, m - s)))
                block[place[lo:hi], col[lo:hi] - s] = weight[lo:hi]
                for q in range(n):
                    at = slice(start[q], start[q + 1])
                    dots[q, s:s + width] = value[at] @ block[term[at]]
        qa = np.bincount(ra, va * va, n) if len(ra) else np.zeros(n)
        qb = np.bincount(rb, vb * vb, m) if len(rb) else np.zeros(m)
        return np.sqrt(np.maximum(np.round(qa[:, None] + qb[None, :] - 2 * dots, 12), 0))

    @staticmethod
    def _within(shared, rows, terms, values):
        at = np.searchsorted(shared, terms)
        ok = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == terms)
        return rows[ok], at[ok], values[ok]


def _top_k(dist: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k least values per row; equal values keep column order."""
    if k == 1:
        return dist.argmin(1)[:, None]
    return np.argsort(dist, axis=1, kind="stable")[:, :k]


def _nearest(left: pd.DataFrame, right: pd.DataFrame, metric, k: int, carry: list[str]) -> pd.DataFrame:
    """(query_id, train_id, distance, carry...) of the k nearest of the right rows for each left one."""
    if left.empty or right.empty:
        return pd.DataFrame()
    right = right.sort_values("id", kind="stable").reset_index(drop=True)
    points, picks, dists = metric.stack(right), [], []
    for s in range(0, len(left), QUERY_CHUNK):
        dist = np.round(metric.distances(metric.stack(left[s:s + QUERY_CHUNK]), points), DECIMALS)
        pick = _top_k(dist, k)
        picks.append(pick)
        dists.append(np.take_along_axis(dist, pick, 1))
    pick, dist = np.concatenate(picks), np.concatenate(dists)
    out = {"query_id": np.repeat(left["id"].to_numpy(), pick.shape[1]),
           "train_id": right["id"].to_numpy()[pick.ravel()], "distance": dist.ravel()}
    for c in carry:
        out[c] = right[c].to_numpy()[pick.ravel()]
    return pd.DataFrame(out)


class _Asked:
    """A block of queries that meets blocks of rows one by one, and the k nearest rows of each query so far."""

    ROWS = 1 << 16

    def __init__(self, queries: pa.Table, metric, k: int, carry: list[str]):
        self.metric, self.k, self.carry = metric, k, carry
        self.frames, self.rows = [], 0
        self.parts = [queries.slice(s, QUERY_CHUNK) for s in range(0, len(queries), QUERY_CHUNK)]
        self.points = [vectors.as_matrix(q[metric.columns[0]]) if hasattr(metric, "screen") else None for q in self.parts]
        self.best = [np.full((len(q), k), np.inf) for q in self.parts]

    def meet(self, rows: pa.Table):
        points = vectors.as_matrix(rows[self.metric.columns[0]]) if hasattr(self.metric, "screen") else None
        for n, queries in enumerate(self.parts):
            screen = self.metric.screen(self.points[n], points) if points is not None else None
            if screen is None:
                self._keep(_nearest(queries.to_pandas(), rows.to_pandas(), self.metric, self.k, self.carry))
                continue
            i, j, d, self.best[n] = screen.nearest(self.k, self.best[n])
            i, j = pa.array(i), pa.array(j)
            out = {"query_id": queries["id"].take(i).to_pandas(), "train_id": rows["id"].take(j).to_pandas(), "distance": d}
            self._keep(pd.DataFrame(out | {c: rows[c].take(j).to_pandas() for c in self.carry}))

    def _keep(self, frame: pd.DataFrame):
        if len(frame):
            self.frames.append(frame)
            self.rows += len(frame)
        if self.rows > self.ROWS:
            self.frames = [self.found()]
            self.rows = len(self.frames[0]) // 2  # so that it is not sorted anew for each block

    def found(self) -> pd.DataFrame:
        if not self.frames:
            return pd.DataFrame()
        return (pd.concat(self.frames).sort_values(["query_id", "distance", "train_id"], kind="stable")
                .groupby("query_id", sort=False).head(self.k))


def _search_all(queries: DataFrame, train: DataFrame, rows: int, metric, k: int, block_rows: int, seed: int, carry: list[str]) -> DataFrame:
    """k nearest training rows of each query, and no fewer from each group of blocks.

    Both sides are packed in blocks and written once; tasks read the pairs of blocks, which are not shuffled. Of all
    blocks that a task pairs with some queries, only the k nearest rows of each query leave it.
    """
    blocks = lambda n: max(1, math.ceil(n / block_rows))
    place = lambda tag, n: F.floor(rng.uniform(seed, tag, "id") * n).cast("int")
    parts, held = blocks(queries.count()), blocks(rows)
    asking = packed(queries.withColumn("part", place("query-block", parts)), "part", parts, "asking")
    known = packed(train.withColumn("block", place("train-block", held)), "block", held, "held")
    schema = T.StructType([T.StructField("query_id", queries.schema["id"].dataType), T.StructField("train_id", train.schema["id"].dataType),
                           T.StructField("distance", T.DoubleType())] + [train.schema[c] for c in carry])

    def search(frames):
        here, asked = None, None
        for pdf in frames:
            for part, asking, held in zip(pdf["part"], pdf["asking"], pdf["held"]):
                if part != here:
                    if asked is not None:
                        yield asked.found()
                    here, asked = part, _Asked(unpacked(asking), metric, k, carry)
                asked.meet(unpacked(held))
        if asked is not None:
            yield asked.found()
    if held == 1:  # the only block, number 0, goes to all tasks
        pairs = asking.join(F.broadcast(known), F.least("part", F.lit(0)) == F.col("block"))
    else:
        pairs = asking.hint("shuffle_replicate_nl").crossJoin(known.hint("shuffle_replicate_nl"))
    return pairs.mapInPandas(search, schema)


def _search(queries: DataFrame, cells: DataFrame, count: dict, metric, k: int, pivots: int, block_rows: int,
            seed: int, carry: list[str]) -> DataFrame:
    """k nearest training rows of each query within the cell named in its row."""
    asked = {r["cell"]: r["count"] for r in queries.groupBy("cell").count().collect()}
    size = lambda n: max(1, math.ceil(n / block_rows))
    t_blocks = F.array(*[F.lit(size(count.get(c, 0))) for c in range(pivots)])
    q_blocks = F.array(*[F.lit(size(asked.get(c, 0))) for c in range(pivots)])
    nt, nq = F.element_at(t_blocks, F.col("cell") + 1), F.element_at(q_blocks, F.col("cell") + 1)
    place = lambda tag, n: F.floor(rng.uniform(seed, tag, "id") * n).cast("int")
    q = (queries.withColumn("qb", place("query-block", nq))
         .withColumn("tb", F.explode(F.sequence(F.lit(0), nt - 1))))
    t = (cells.withColumn("tb", place("train-block", nt))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), nq - 1))))
    schema = T.StructType([T.StructField("query_id", queries.schema["id"].dataType),
                           T.StructField("train_id", cells.schema["id"].dataType),
                           T.StructField("distance", T.DoubleType())] + [cells.schema[c] for c in carry])

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _nearest(left, right, metric, k, carry)

    keys = ["cell", "qb", "tb"]
    return q.groupBy(*keys).cogroup(t.groupBy(*keys)).applyInPandas(nearest, schema)


def knn_join(queries: DataFrame, train: DataFrame, k: int, metric=None, carry: list[str] | None = None,
             id_col: str = "id", pivots: int = 1, block_rows: int = 1024, seed: int = 42) -> DataFrame:
    """(query_id, rank, train_id, distance, carry...): the k nearest rows, lowest id on ties.

    Distances are compared at nine decimals. `pivots` above 1 cut the training
    rows into so many cells, of which a query skips those too far away: worth it
    in few dimensions; a block of `block_rows` rows of a cell then meets another in one
    task, and each row is copied once per block of the other side. Without, no row is copied.
    """
    metric = metric or Dense()
    carry = carry or []
    if k < 1:
        raise ValueError("k must be at least 1")
    q = queries.select(F.col(id_col).alias("id"), *metric.columns)
    t = train.select(F.col(id_col).alias("id"), *metric.columns, *carry)
    copies = Window.partitionBy(*metric.columns).orderBy("id")
    t = t.withColumn("_c", F.row_number().over(copies)).where(F.col("_c") <= k).drop("_c")
    rows = train.count()
    if rows == 0:
        raise ValueError("the training table is empty")
    if pivots == 1:
        # One cell: nothing to prune, so no pivot is needed.
        found = _search_all(q, t, rows, metric, k, block_rows, seed, carry)
        return _keep(found, k).select("query_id", "rank", "train_id", "distance", *carry)
    chosen = t.orderBy(rng.hash32(seed, "pivot", "id"), "id").limit(pivots).toPandas()
    pivots = len(chosen)
    points = metric.stack(chosen)

    def assign(frames):
        for pdf in frames:
            d = metric.distances(metric.stack(pdf), points)
            best = d.argmin(1)
            yield pdf.assign(cell=best.astype(np.int32), pd=d[np.arange(len(pdf)), best])

    cells = materialize(t.mapInPandas(assign, T.StructType(t.schema.fields + [
        T.StructField("cell", T.IntegerType()), T.StructField("pd", T.DoubleType())])), "cells")
    stats = cells.groupBy("cell").agg(F.count("*").alias("n"), F.min("pd").alias("lo"), F.max("pd").alias("hi")).collect()
    count = {r["cell"]: r["n"] for r in stats}
    n = np.array([count.get(c, 0) for c in range(pivots)])
    lo = np.array([next((r["lo"] for r in stats if r["cell"] == c), np.inf) for c in range(pivots)])
    hi = np.array([next((r["hi"] for r in stats if r["cell"] == c), -np.inf) for c in range(pivots)])
    visit = T.StructType(q.schema.fields + [T.StructField("cell", T.IntegerType())])

    def repeat(pdf, wanted):
        rows, cell = np.nonzero(wanted)
        return pdf.iloc[rows].reset_index(drop=True).assign(cell=cell.astype(np.int32))

    def homes(d):
        order = np.argsort(np.where(n > 0, d, np.inf), axis=1, kind="stable")
        held = np.cumsum(n[order], axis=1) - n[order]
        wanted = np.zeros(d.shape, dtype=bool)
        np.put_along_axis(wanted, order, held < k, axis=1)
        return wanted & (n > 0)

    def near(frames):
        for pdf in frames:
            out = repeat(pdf, homes(metric.distances(metric.stack(pdf), points)))
            if len(out):
                yield out

    def rest(frames):
        for pdf in frames:
            d = metric.distances(metric.stack(pdf), points)
            reach = pdf["reach"].fillna(np.inf).to_numpy()[:, None] + 1e-6
            bound = np.maximum(np.maximum(d - hi, lo - d), 0)
            out = repeat(pdf.drop(columns="reach"), (bound <= reach) & (n > 0) & ~homes(d))
            if len(out):
                yield out

    search = lambda visits: _search(visits, cells.drop("pd"), count, metric, k, pivots, block_rows, seed, carry)
    found = materialize(_keep(search(q.mapInPandas(near, visit)), k), "neighbors")
    if len(count) > 1:
        reach = (found.groupBy("query_id").agg(F.max("distance").alias("reach"), F.count("*").alias("held"))
                 .select(F.col("query_id").alias("id"), F.when(F.col("held") >= k, F.col("reach")).alias("reach")))
        found = found.drop("rank").unionByName(search(q.join(reach, "id", "left").mapInPandas(rest, visit)))
        found = _keep(found, k)
    return found.select("query_id", "rank", "train_id", "distance", *carry)


def _keep(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("distance", "train_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def vote(neighbors: DataFrame, weights: str = "uniform", label: str = "label") -> DataFrame:
    """(query_id, prediction) by majority, 1/distance or softmax(-distance).

    Ties go to the smallest class. A neighbour at distance 0 outweighs all
    others under 1/distance. Weights are compared at nine decimals.
    """
    d = F.col("distance")
    if weights == "uniform":
        weight, zero = F.lit(1.0), F.lit(0)
    elif weights == "inverse":
        weight, zero = F.coalesce(F.try_divide(F.lit(1.0), d), F.lit(0.0)), (d == 0).cast("int")
    elif weights == "softmax":
        weight, zero = F.exp(F.min(d).over(Window.partitionBy("query_id")) - d), F.lit(0)
    else:
        raise ValueError("weights must be uniform, inverse or softmax")
    sums = (neighbors.withColumn("_w", weight).withColumn("_z", zero)
            .groupBy("query_id", label).agg(F.sum("_w").alias("w"), F.max("_z").alias("z")))
    strength = F.struct(F.col("z"), F.when(F.col("z") == 1, 0.0).otherwise(F.round("w", DECIMALS)), (-F.col(label)))
    return sums.groupBy("query_id").agg(F.max_by(label, strength).alias("prediction"))


def classify(queries: DataFrame, train: DataFrame, k: int = 3, p: int = 2, weights: str = "inverse",
             label: str = "label", features: str = "features", id_col: str = "id", **options) -> DataFrame:
    """Predicted class of each query row."""
    found = knn_join(queries, train, k, Dense(p, features), [label], id_col, **options)
    return vote(found, weights, label)


def first_error_per_class(scored: DataFrame, neighbors: DataFrame, label: str = "label", pred: str = "prediction",
                          id_col: str = "id") -> DataFrame:
    """The lowest-id misclassified row of each true class, with its neighbours."""
    first = (scored.where(F.col(pred) != F.col(label)).groupBy(label)
             .agg(F.min(F.struct(F.col(id_col).alias("query_id"), F.col(pred).alias("prediction"))).alias("m"))
             .select(F.col(label).alias("true_label"), "m.*"))
    return neighbors.select("query_id", "rank", "train_id").join(first, "query_id")
