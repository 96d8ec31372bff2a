"""Vector columns: native expressions for short arrays, Arrow blocks for long ones."""

from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

VECTOR = T.ArrayType(T.DoubleType())
ARROW_KEYS = {"integer": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def fold_sum(arr) -> Column:
    return F.aggregate(_col(arr), F.lit(0.0), lambda acc, v: acc + v)


def dot(a, b) -> Column:
    return fold_sum(F.zip_with(_col(a), _col(b), lambda x, y: x * y))


def lp_norm(arr, p: int = 2) -> Column:
    return F.pow(fold_sum(F.transform(_col(arr), lambda v: F.pow(F.abs(v), F.lit(float(p))))), F.lit(1.0 / p))


def let(value, fn) -> Column:
    """fn(value) with `value` evaluated once per row, also when fn uses it inside a lambda."""
    return F.get(F.transform(F.array(_col(value)), fn), F.lit(0))


def softmax(arr) -> Column:
    """exp(z - max z), scaled to sum one."""
    arr = _col(arr)
    shifted = let(F.array_max(arr), lambda top: F.transform(arr, lambda v: F.exp(v - top)))
    return let(shifted, lambda e: let(fold_sum(e), lambda total: F.transform(e, lambda v: v / total)))


def one_hot(label, k: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == _col(label)).cast("int"))


def with_bias(arr) -> Column:
    """Append the constant feature 1 last."""
    return F.concat(_col(arr), F.array(F.lit(1.0)))


def powers(x, order: int) -> Column:
    """[x, x**2, ..., x**order]."""
    return F.transform(F.sequence(F.lit(1), F.lit(order)), lambda i: F.pow(_col(x), i.cast("double")))


def prefix(arr, n: int) -> Column:
    return F.slice(_col(arr), 1, n)


def monomials(n: int, degree: int, include_bias: bool = False) -> list[tuple[int, ...]]:
    """Index tuples: all of degree 1, then all of degree 2, and so on."""
    start = 0 if include_bias else 1
    return [t for d in range(start, degree + 1) for t in combinations_with_replacement(range(n), d)]


def poly_columns(cols, degree: int, include_bias: bool = False) -> list[Column]:
    """Products of scalar columns in monomial order, as native expressions."""
    cols = [_col(c) for c in cols]
    out = []
    for term in monomials(len(cols), degree, include_bias):
        product = F.lit(1.0)
        for n, i in enumerate(term):
            product = cols[i] if n == 0 else product * cols[i]
        out.append(product)
    return out


def long_form(df: DataFrame, *keep: str, features: str = "features", by_udf: bool = False) -> DataFrame:
    """One row per vector element: (keep..., d, x).

    Features that come `by_udf` are made once: for posexplode Spark infers a filter on them, and makes them a second time for it.
    """
    if by_udf:
        return df.select(*keep, F.posexplode_outer(features).alias("d", "x")).where(F.col("d").isNotNull())
    return df.select(*keep, F.posexplode(features).alias("d", "x"))


def as_matrix(column: pa.Array) -> np.ndarray:
    """A list<double> Arrow column as an N x D array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if n == 0:
        return np.zeros((0, 0))
    if len(flat) % n or column.null_count:
        raise ValueError("every row must hold a vector of the same length")
    return flat.reshape(n, -1)


def as_list_column(m: np.ndarray) -> pa.Array:
    n, d = m.shape
    offsets = pa.array(np.arange(0, (n + 1) * d, d, dtype=np.int32) if d else np.zeros(n + 1, np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(m, dtype=np.float64).reshape(-1)))


def map_vectors(df: DataFrame, fn, fields: list[tuple[str, T.DataType]], features: str = "features",
                keep: list[str] | None = None) -> DataFrame:
    """Append columns that `fn` computes from each Arrow block of vectors.

    `fn` takes an N x D array and returns one array per new field.
    """
    keep = df.columns if keep is None else keep
    src = df.select(*dict.fromkeys([*keep, features]))
    schema = T.StructType([src.schema[c] for c in keep] + [T.StructField(n, t) for n, t in fields])

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out = fn(as_matrix(batch.column(batch.schema.get_field_index(features))))
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            for (_, kind), values in zip(fields, out):
                if isinstance(kind, T.ArrayType):
                    cols.append(as_list_column(values))
                elif isinstance(kind, T.DoubleType):
                    cols.append(pa.array(np.asarray(values, dtype=np.float64)))
                else:
                    cols.append(pa.array(np.asarray(values, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, *[n for n, _ in fields]])

    return src.mapInArrow(run, schema)


# Tasks that add up what all tasks have summed.
FAN = 8


def block_sums(df: DataFrame, fn, group: str | None = None, features: str = "features",
               extra: list[str] | None = None) -> DataFrame:
    """Sum, over all rows, a fixed-length array that `fn` computes per block.

    `fn(X, cols)` gets the N x D block and a dict of the extra columns and
    returns a flat array. Each task adds up its own blocks and emits one row
    per group value. FAN tasks add those up as arrays, as they arrive; only
    their sums are taken apart for the last sum. Result: (group, i, v).
    """
    keys = [group] if group else []
    extra = extra or []
    src = df.select(*dict.fromkeys([*keys, *extra, features]))
    schema = T.StructType([src.schema[g] for g in keys] + [T.StructField("s", VECTOR)])

    def run(batches):
        total: dict = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = as_matrix(batch.column(batch.schema.get_field_index(features)))
            cols = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in extra}
            if group:
                code = batch.column(batch.schema.get_field_index(group)).dictionary_encode()
                at = code.indices.to_numpy(zero_copy_only=False)
                parts = [(v, np.flatnonzero(at == n)) for n, v in enumerate(code.dictionary.to_pylist())]
            else:
                parts = [(None, slice(None))]
            for key, ix in parts:
                v = fn(x[ix], {c: a[ix] for c, a in cols.items()})
                total[key] = total[key] + v if key in total else v
        if total:
            arrays = [pa.array(list(total), type=ARROW_KEYS[kind])] if group else []
            arrays.append(as_list_column(np.stack(list(total.values()))))
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, "s"])

    def add(batches):
        total: dict = {}
        for batch in batches:
            sums = as_matrix(batch.column(len(keys)))
            for key, v in zip(batch.column(0).to_pylist() if group else [None] * len(sums), sums):
                total[key] = total[key] + v if key in total else v
        if total:
            arrays = [pa.array(list(total), type=ARROW_KEYS[kind])] if group else []
            yield pa.RecordBatch.from_arrays([*arrays, as_list_column(np.stack(list(total.values())))], names=[*keys, "s"])

    kind = src.schema[group].dataType.typeName() if group else None
    parts = src.mapInArrow(run, schema).repartition(FAN, F.spark_partition_id()).mapInArrow(add, schema)
    return (parts.select(*keys, F.posexplode("s").alias("i", "v"))
            .groupBy(*keys, "i").agg(F.sum("v").alias("v")))


def collect_sums(sums: DataFrame, size: int, group: str | None = None):
    """Bring `block_sums` to the driver: model-sized, `size` numbers per group."""
    rows = sums.collect()
    if group is None:
        out = np.zeros(size)
        for r in rows:
            out[r["i"]] = r["v"]
        return out
    table: dict = {}
    for r in rows:
        table.setdefault(r[group], np.zeros(size))[r["i"]] = r["v"]
    return table
