"""Distributed ranks, and the splits, folds, batches and resamples built on them.

No operator here sorts a whole table in one task. Rows are bucketed by a hash
(uniform) or by sampled boundaries (sorted values), buckets are counted, and
each bucket is numbered on its own. Only bucket counts reach the driver.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import rng
from ..sources.models import materialize

BUCKETS = 1024
MAX_BUCKETS = 1 << 16
ROWS_PER_BUCKET = 1 << 16
SELECT_ROWS = 4096
NATIVE_RANGES = 64


def _offset_table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """Offsets of buckets, of which there are at most MAX_BUCKETS."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def _bucket_number(rows: int) -> int:
    return min(MAX_BUCKETS, max(8, math.ceil(rows / ROWS_PER_BUCKET)))


def hash_rank(df: DataFrame, id_col: str, seed: int, tag: str, group: str | None = None,
              name: str = "rank", buckets: int | None = None) -> DataFrame:
    """Number rows 0, 1, 2, ... in the order of a seeded hash, per group if given."""
    buckets = buckets or _bucket_number(df.count())
    keyed = (df.withColumn("_h", rng.hash32(seed, tag, id_col))
             .withColumn("_b", F.floor(F.col("_h") * buckets / rng.TWO32).cast("int")))
    by = ([group] if group else []) + ["_b"]
    counts = keyed.groupBy(*by).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(group or F.col("_b").isNull()).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_at{c}") for c in by], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_o"))
    w = Window.partitionBy(*by).orderBy("_h", id_col)
    same = [F.col(c).eqNullSafe(F.col(f"_at{c}")) for c in by]
    return (keyed.withColumn("_r", F.row_number().over(w) - 1).join(offsets, same)
            .withColumn(name, F.col("_o") + F.col("_r")).select(*df.columns, name))


def hash_threshold(df: DataFrame, id_col: str, seed: int, tag: str, n: int):
    """The (hash, id) pair of the n-th row in hash order, by radix selection.

    Three passes at most over the id column, each returning bucket counts; the
    rows of one narrow hash range are then sorted. Nothing is shuffled by row.
    """
    keyed = df.select(F.col(id_col).alias("id"), rng.hash32(seed, tag, id_col).alias("h"))
    low, width, need = 0, rng.TWO32, n
    while width > 1:
        step = max(width // 2048, 1)
        inside = keyed.where((F.col("h") >= low) & (F.col("h") < low + width))
        counts = sorted((r["b"], r["count"]) for r in
                        inside.groupBy(F.expr(f"(h - {low}L) div {step}L").alias("b")).count().collect())
        for b, c in counts:
            if need <= c:
                low, width = low + b * step, step
                break
            need -= c
        else:
            return None
        if c <= SELECT_ROWS:
            break
    rows = keyed.where((F.col("h") >= low) & (F.col("h") < low + width)).orderBy("h", "id").limit(need).collect()
    return rows[-1]["h"], rows[-1]["id"]


def split_fraction(id_col, fraction: float, seed: int = 42, tag: str = "split") -> Column:
    """True for test rows: a scan-only split, its size right on average."""
    return rng.uniform(seed, tag, id_col) < F.lit(float(fraction))


def split_exact(df: DataFrame, id_col: str, size: int | float, seed: int = 42, tag: str = "split",
                name: str = "is_test") -> DataFrame:
    """Mark exactly `size` rows (int) or ceil(size * N) rows (float) as test."""
    n = size if isinstance(size, int) else math.ceil(size * df.count())
    edge = hash_threshold(df, id_col, seed, tag, n) if n > 0 else None
    h = rng.hash32(seed, tag, id_col)
    if n <= 0:
        flag = F.lit(False)
    elif edge is None:
        flag = F.lit(True)
    else:
        flag = (h < edge[0]) | ((h == edge[0]) & (F.col(id_col) <= F.lit(edge[1])))
    return df.withColumn(name, flag)


def sample_rows(df: DataFrame, id_col: str, k: int, seed: int = 42, tag: str = "sample") -> DataFrame:
    """k distinct rows, uniformly, without replacement (k is small: a top-k plan)."""
    return (df.withColumn("_h", rng.hash32(seed, tag, id_col))
            .orderBy("_h", id_col).limit(k).drop("_h"))


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """Spread the rows of each class evenly over k folds."""
    ranked = hash_rank(df, id_col, seed, "fold", group=label, name="_rank")
    return ranked.withColumn(name, (F.col("_rank") % k).cast("int")).drop("_rank")


def minibatches(df: DataFrame, id_col: str, batch_size: int, epoch: int = 0, seed: int = 42) -> DataFrame:
    """Consecutive batches of a seeded permutation; the last one may be short."""
    ranked = hash_rank(df, id_col, seed, f"epoch{epoch}", name="position")
    return ranked.withColumn("batch", F.expr(f"position div {batch_size}"))


def batch_of(id_col, batches: int, epoch: int | Column = 0, seed: int = 42) -> Column:
    """Assign rows to a fixed number of batches with no sort; sizes equal on average."""
    if isinstance(epoch, Column):
        u = rng.uniform(seed, "batch", epoch, id_col)
    else:
        u = rng.uniform(seed, "batch", F.lit(epoch), id_col)
    return F.floor(u * batches).cast("int")


def sorted_runs(df: DataFrame, value: str, seed: int = 42, buckets: int | None = None) -> DataFrame:
    """Distinct values in sorted order: (value, weight, first_rank, run_no).

    Copies collapse before anything is sorted, and bucket edges come from a
    hash sample of the distinct values, so no value and no group of copies can
    overload a bucket.
    """
    kind = df.schema[value].dataType
    runs = (df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value"))
            .agg(F.count("*").alias("weight")))
    runs = materialize(runs, "runs")
    buckets = buckets or _bucket_number(runs.count())
    sample = [r[0] for r in runs.orderBy(rng.digest(seed, "edges", "value")).select("value").limit(buckets * 4).collect()]
    edges = np.array(sorted(sample)[3::4], dtype=object if isinstance(kind, T.StringType) else None)

    @F.pandas_udf("int")
    def bucket(v: pd.Series) -> pd.Series:
        data = v.to_numpy(dtype=object) if edges.dtype == object else v.to_numpy()
        return pd.Series(np.searchsorted(edges, data, side="right").astype(np.int32))

    runs = runs.withColumn("_b", bucket("value"))
    rows, weight_before, runs_before = [], 0, 0
    for b, w, c in sorted(tuple(r) for r in runs.groupBy("_b").agg(F.sum("weight"), F.count("*")).collect()):
        rows.append((b, weight_before, runs_before))
        weight_before += w
        runs_before += c
    offsets = _offset_table(df.sparkSession, rows, "_b int, _w long, _c long")
    by_value = Window.partitionBy("_b").orderBy("value")
    before = F.sum("weight").over(by_value.rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight")
    return (runs.join(offsets, "_b")
            .withColumn("first_rank", F.col("_w") + before)
            .withColumn("run_no", F.col("_c") + F.row_number().over(by_value) - 1)
            .select("value", "weight", "first_rank", "run_no"))


def _bucket_counts(df: DataFrame, edges: np.ndarray) -> np.ndarray:
    """Rows per bucket; each task counts its own rows and returns one array."""

    def run(batches):
        total = np.zeros(len(edges) + 1, dtype=np.int64)
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False)
            total += np.bincount(np.searchsorted(edges, v, side="right"), minlength=len(edges) + 1)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n"])

    parts = df.mapInArrow(run, "n array<bigint>").select(F.posexplode("n").alias("b", "n"))
    out = np.zeros(len(edges) + 1, dtype=np.int64)
    for r in parts.groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[r["b"]] = r["n"]
    return out


def exact_quantiles(df: DataFrame, value: str, probabilities: list[float], buckets: int = BUCKETS) -> list[float]:
    """Exact quantiles with linear interpolation, without a single-task buffer.

    An approximate sketch gives bucket edges, one pass counts the rows of each
    bucket, and only the buckets that hold a wanted rank are sorted, after
    their copies have collapsed. The sketch decides balance, never the result;
    raise `buckets` for columns of many billion distinct values.
    """
    data = df.select(F.col(value).cast("double").alias("value")).where(F.col("value").isNotNull())
    marks = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    sketch = F.expr(f"percentile_approx(value, array({marks}), {10 * buckets})")
    edges = np.unique(np.array(data.agg(sketch).first()[0] or [], dtype=float))
    counts = _bucket_counts(data, edges)
    n = int(counts.sum())
    if n == 0:
        return [None] * len(probabilities)
    places = [p * (n - 1) for p in probabilities]
    wanted = np.array(sorted({r for x in places for r in (math.floor(x), math.ceil(x))}))
    before = np.cumsum(counts) - counts
    hit = sorted({int(i) for i in np.searchsorted(np.cumsum(counts), wanted, side="right")})

    def inside(b: int) -> str:
        low = f"value >= {float(edges[b - 1])!r}D" if b > 0 else "true"
        return f"({low} AND value < {float(edges[b])!r}D)" if b < len(edges) else f"({low})"

    if len(hit) <= NATIVE_RANGES:
        # Few ranges: plain predicates, which also reach the scan.
        rows = data.where(" OR ".join(inside(b) for b in hit))
        bucket = F.expr("CASE " + " ".join(f"WHEN {inside(b)} THEN {b}" for b in hit) + " END")
    else:
        @F.pandas_udf("int")
        def find(v: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(edges, v.to_numpy(), side="right").astype(np.int32))

        rows, bucket = data, find("value")
    runs = rows.groupBy("value").agg(F.count("*").alias("weight")).withColumn("_b", bucket)
    if len(hit) > NATIVE_RANGES:
        runs = runs.where(F.col("_b").isin(hit))
    offsets = _offset_table(df.sparkSession, [(b, int(before[b])) for b in hit], "_b int, _w long")
    by_value = Window.partitionBy("_b").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (runs.join(offsets, "_b")
              .withColumn("first_rank", F.col("_w") + F.sum("weight").over(by_value) - F.col("weight")))

    @F.pandas_udf("boolean")
    def holds(first: pd.Series, weight: pd.Series) -> pd.Series:
        at = np.searchsorted(wanted, first.to_numpy(), side="left")
        nearest = wanted[np.minimum(at, len(wanted) - 1)]
        return pd.Series((at < len(wanted)) & (nearest < (first + weight).to_numpy()))

    kept = sorted(tuple(r) for r in ranked.where(holds("first_rank", "weight")).select("first_rank", "value").collect())
    starts, values = np.array([s for s, _ in kept]), [v for _, v in kept]
    at_rank = lambda r: float(values[np.searchsorted(starts, r, side="right") - 1])
    out = []
    for x in places:
        low, high = at_rank(math.floor(x)), at_rank(math.ceil(x))
        out.append(low + (high - low) * (x - math.floor(x)))
    return out


def bootstrap_weights(df: DataFrame, id_col: str, samples: int, seed: int = 42) -> DataFrame:
    """One row per (row, sample) with its Poisson(1) multiplicity; zeros dropped.

    Meant to be aggregated by sample at once: the partial aggregate then
    shuffles one row per sample and task. Sample sizes vary around N.
    """
    groups = (samples + 3) // 4
    drawn = (df.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
             .withColumn("_d", rng.digest(seed, "bootstrap", "_g", id_col))
             .select("*", F.posexplode(rng.lanes(F.col("_d"))).alias("_l", "_h"))
             .withColumn("sample", F.col("_g") * 4 + F.col("_l"))
             .withColumn("times", rng.poisson1(F.col("_h"))))
    return drawn.where((F.col("times") > 0) & (F.col("sample") < samples)).drop("_g", "_d", "_l", "_h")


def bootstrap_exact(df: DataFrame, id_col: str, samples: int, seed: int = 42) -> DataFrame:
    """Samples of exactly N rows with replacement, as (row, sample, times)."""
    n = df.count()
    draws = (df.sparkSession.range(samples * n)
             .select(F.expr(f"id div {n}").cast("int").alias("sample"),
                     F.floor(rng.uniform(seed, "draw", "id") * n).alias("_rank")))
    counted = draws.groupBy("sample", "_rank").agg(F.count("*").cast("int").alias("times"))
    ranked = hash_rank(df, id_col, seed, "bootstrap-rank", name="_rank")
    return ranked.join(counted, "_rank").drop("_rank")
