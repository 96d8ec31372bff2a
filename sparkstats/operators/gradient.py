"""Iterative fits: linear, logistic and softmax gradient descent, and the perceptron.

The driver holds the weights only. Each step is one aggregate over the same
input, so plans do not grow from step to step and a lost executor costs one
recomputed partition. Linear steps need cross-products only, so a whole epoch
of linear mini-batches is a single grouped aggregate.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import rng, vectors
from . import sampling
from .cache import held
from .gram import vector_moments
from .linear import LinearModel

MAX_BATCHES = 4096


def initial_weights(dim: int, classes: int = 1, low: float = -0.1, high: float = 0.1, seed: int = 42) -> np.ndarray:
    """(dim + 1) x classes uniform weights, the bias last."""
    draw = lambda d, k: low + (high - low) * rng.uniform_value(seed, "weights", d, k)
    return np.array([[draw(d, k) for k in range(classes)] for d in range(dim + 1)])


def with_ones(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def probabilities(kind: str, x1: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Model output for rows that already hold the constant feature."""
    z = x1 @ w
    if kind == "linear":
        return z
    if kind == "logistic":
        return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def step_sums(kind: str, w: np.ndarray, target: str):
    """A block function giving [rows, loss, hits, gradient...] summed over a block."""

    def block(x, cols):
        x1 = with_ones(x)
        t = np.asarray(cols[target], dtype=float)
        y = probabilities(kind, x1, w)
        if kind == "softmax":
            hot = t[:, None] == np.arange(w.shape[1])[None, :]
            own = np.clip(y[np.arange(len(t)), t.astype(int)], 1e-15, None)
            loss, hits, r = -np.log(own).sum(), (y.argmax(1) == t).sum(), y - hot
        else:
            r = y - t[:, None]
            if kind == "linear":
                loss, hits = (r ** 2).sum(), 0.0
            else:
                p = np.clip(y[:, 0], 1e-15, 1 - 1e-15)
                loss = -(t * np.log(p) + (1 - t) * np.log(1 - p)).sum()
                hits = (np.abs(r) <= 0.5).sum()
        return np.concatenate([[len(x), loss, hits], (x1.T @ r).ravel()])

    return block


def gradient(df: DataFrame, kind: str, w: np.ndarray, features: str = "features", target: str = "label") -> np.ndarray:
    """Mean per-row gradient at w: one aggregate."""
    size = 3 + w.size
    s = vectors.collect_sums(vectors.block_sums(df, step_sums(kind, w, target), features=features, extra=[target]), size)
    return (s[3:] / s[0]).reshape(w.shape)


def gradient_table(spark, g: np.ndarray, value: str = "gradient") -> DataFrame:
    rows = [(d, k, float(g[d, k])) for d in range(g.shape[0]) for k in range(g.shape[1])]
    return spark.createDataFrame(rows, f"feature int, class int, {value} double")


def fit(df: DataFrame, kind: str, dim: int, epochs: int, learning_rate: float, batches: int = 1,
        l2: float = 0.0, classes: int = 1, weights: np.ndarray | None = None, seed: int = 42,
        id_col: str = "id", features: str = "features", target: str = "label", is_test: str = "is_test",
        cache: bool = True):
    """Mini-batch gradient descent; returns (weights, curve).

    Rows fall into `batches` seeded batches, drawn anew each epoch. The curve
    has a row (epoch, is_test, loss, accuracy) per epoch and split; the loss is
    RMSE for linear fits and mean cross-entropy otherwise. The sums behind
    the metrics and the gradient of the next step come from the same pass.
    """
    if batches > MAX_BATCHES:
        raise ValueError("too many synchronous batches; use fit_local for tiny batch sizes")
    w = initial_weights(dim, classes, seed=seed) if weights is None else np.array(weights, dtype=float)
    if kind == "linear":
        with held(df.select(id_col, features, target, is_test), cache and batches > 1) as src:
            return _fit_linear(src, dim, epochs, learning_rate, batches, l2, w, seed, id_col, features, target, is_test)
    size = 3 + w.size
    curve = []
    with held(df.select(id_col, features, target, is_test), cache) as src:
        for epoch in range(epochs + 1):
            # Negative batch numbers mark test rows, so one key carries both.
            batch = sampling.batch_of(id_col, batches, epoch, seed) if batches > 1 else F.lit(0)
            keyed = src.withColumn("_b", F.when(F.col(is_test), F.lit(-1)).otherwise(batch).cast("int"))
            table = vectors.collect_sums(vectors.block_sums(
                keyed, step_sums(kind, w, target), group="_b", features=features, extra=[target]), size, "_b")
            if epoch:
                curve += _curve_rows(epoch, table)
            if epoch == epochs:
                break
            for b in range(batches):
                if b:
                    s = vectors.collect_sums(vectors.block_sums(
                        keyed.where(F.col("_b") == b), step_sums(kind, w, target), features=features, extra=[target]), size)
                else:
                    s = table.get(0, np.zeros(size))
                if s[0]:
                    w = w - learning_rate * ((s[3:] / s[0]).reshape(w.shape) + l2 * w)
    return w, curve


def _curve_rows(epoch: int, table: dict) -> list[tuple]:
    rows = []
    for test in (False, True):
        s = sum((v[:3] for b, v in table.items() if (b < 0) == test), np.zeros(3))
        if s[0]:
            rows.append((epoch, test, float(s[1] / s[0]), float(s[2] / s[0])))
    return rows


def _fit_linear(src, dim, epochs, learning_rate, batches, l2, w, seed, id_col, features, target, is_test):
    curve, parts = [], None
    for epoch in range(epochs):
        if parts is None or batches > 1:
            batch = sampling.batch_of(id_col, batches, epoch, seed) if batches > 1 else F.lit(0)
            keyed = src.withColumn("_b", F.when(F.col(is_test), F.lit(-1)).otherwise(batch).cast("int"))
            parts = vector_moments(keyed, dim, features, target, by="_b")
        for b in sorted(k for k in parts if k >= 0):
            m = parts[b]
            a = np.zeros((dim + 1, dim + 1))
            a[:dim, :dim], a[:dim, dim], a[dim, :dim], a[dim, dim] = m.cross[:dim, :dim], m.sums[:dim], m.sums[:dim], m.n
            rhs = np.append(m.cross[:dim, dim], m.sums[dim])
            w = w - learning_rate * ((a @ w[:, 0] - rhs) / m.n + l2 * w[:, 0])[:, None]
        model = LinearModel([str(i) for i in range(dim)], w[:-1, 0], float(w[-1, 0]))
        train = None
        for b, m in parts.items():
            if b >= 0:
                train = m if train is None else train + m
        curve.append((epoch + 1, False, model.rmse(train), None))
        if -1 in parts:
            curve.append((epoch + 1, True, model.rmse(parts[-1]), None))
    return w, curve


def fit_local(df: DataFrame, kind: str, dim: int, epochs: int, learning_rate: float, batch_size: int,
              shards: int, l2: float = 0.0, classes: int = 1, weights: np.ndarray | None = None, seed: int = 42,
              id_col: str = "id", features: str = "features", target: str = "label", cache: bool = True) -> np.ndarray:
    """Tiny batches: each hash shard runs its own epoch, then weights are averaged.

    One job per epoch. With one shard this is plain mini-batch descent in the
    order of a seeded permutation; a short last batch is averaged over its rows.
    """
    w = initial_weights(dim, classes, seed=seed) if weights is None else np.array(weights, dtype=float)
    src = (df.select(id_col, features, target)
           .withColumn("_s", F.floor(rng.uniform(seed, "shard", id_col) * shards).cast("int"))
           .repartition(shards, "_s"))

    def epoch_of(start):
        def run(batches_in):
            local: dict[int, list] = {}

            def step(state, x, t):
                x1 = with_ones(x)
                y = probabilities(kind, x1, state)
                r = y - (t[:, None] == np.arange(state.shape[1])[None, :] if kind == "softmax" else t[:, None])
                return state - learning_rate * (x1.T @ r / len(x) + l2 * state)

            for rb in batches_in:
                x = vectors.as_matrix(rb.column(rb.schema.get_field_index(features)))
                t = rb.column(rb.schema.get_field_index(target)).to_numpy(zero_copy_only=False).astype(float)
                s = rb.column(rb.schema.get_field_index("_s")).to_numpy()
                for shard in np.unique(s):
                    here = s == shard
                    state = local.setdefault(int(shard), [start.copy(), np.zeros((0, dim)), np.zeros(0), 0])
                    xs, ts = np.vstack([state[1], x[here]]), np.concatenate([state[2], t[here]])
                    full = len(xs) // batch_size * batch_size
                    for i in range(0, full, batch_size):
                        state[0] = step(state[0], xs[i:i + batch_size], ts[i:i + batch_size])
                    state[1], state[2] = xs[full:], ts[full:]
                    state[3] += int(here.sum())
            for shard, (state, x, t, n) in sorted(local.items()):
                if len(x):
                    state = step(state, x, t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int64()), vectors.as_list_column(state.reshape(1, -1))], names=["n", "w"])
        return run

    with held(src, cache) as src:
        for epoch in range(epochs):
            ordered = src.sortWithinPartitions("_s", rng.hash32(seed, f"epoch{epoch}", id_col), id_col)
            parts = ordered.mapInArrow(epoch_of(w), "n long, w array<double>")
            sums = (parts.select("n", F.posexplode("w").alias("i", "v")).groupBy("i")
                    .agg((F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("v")).collect())
            flat = np.zeros(w.size)
            for r in sums:
                flat[r["i"]] = r["v"]
            w = flat.reshape(w.shape)
    return w


def predict(df: DataFrame, kind: str, w: np.ndarray, features: str = "features") -> DataFrame:
    """Append `probability` (of class 1, or per class) and, for classifiers, `prediction`."""
    if kind == "linear":
        return vectors.map_vectors(df, lambda x: [probabilities(kind, with_ones(x), w)[:, 0]],
                                   [("prediction", T.DoubleType())], features)
    if kind == "logistic":
        def run(x):
            p = probabilities(kind, with_ones(x), w)[:, 0]
            return [p, (p >= 0.5).astype(int)]
        return vectors.map_vectors(df, run, [("probability", T.DoubleType()), ("prediction", T.IntegerType())], features)

    def run(x):
        p = probabilities(kind, with_ones(x), w)
        return [p, p.argmax(1)]
    return vectors.map_vectors(df, run, [("probability", vectors.VECTOR), ("prediction", T.IntegerType())], features)


def margin(columns: list[Column], w: np.ndarray) -> Column:
    """w·x with the bias weight last, as a native expression."""
    out = F.lit(float(w[-1]))
    for c, v in zip(columns, w):
        out = out + c * F.lit(float(v))
    return out


def misclassified(df: DataFrame, columns: list[str], target: str, w: np.ndarray) -> DataFrame:
    """Rows with t·y <= 0 (a zero margin counts as an error)."""
    return df.where(F.col(target) * margin([F.col(c) for c in columns], w) <= 0)


def perceptron(df: DataFrame, columns: list[str], target: str, max_rounds: int | None = None, seed: int = 42,
               id_col: str = "id", mode: str = "first", cache: bool = True):
    """Perceptron rounds until every row is on its side; returns (weights, rounds, done).

    `first`: each round adds the first misclassified row of that round's seeded
    permutation, found by one min aggregate. `batch`: each round adds the sum
    of all misclassified rows. Without `max_rounds` it goes on until no row is
    misclassified, which on classes that no plane separates is never.
    """
    w = np.zeros(len(columns) + 1)
    x = [F.col(c).cast("double") for c in columns]
    with held(df.select(id_col, F.col(target).cast("double").alias("_t"), *columns), cache) as src:
        for rounds in itertools.count() if max_rounds is None else range(max_rounds):
            wrong = misclassified(src, columns, "_t", w)
            if mode == "first":
                order = rng.hash32(seed, f"round{rounds}", id_col)
                row = wrong.agg(F.min(F.struct(order, F.col(id_col), F.col("_t"), *x)).alias("m")).first()["m"]
                if row is None:
                    return w, rounds, True
                t, point = row[2], np.array([*row[3:], 1.0])
                w = w + t * point
            else:
                row = wrong.agg(F.count("*"), *[F.sum(F.col("_t") * c) for c in x], F.sum("_t")).first()
                if row[0] == 0:
                    return w, rounds, True
                w = w + np.array(row[1:], dtype=float)
        return w, max_rounds, misclassified(src, columns, "_t", w).limit(1).count() == 0
