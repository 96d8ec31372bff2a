"""Run queries next to their SQL counterparts and compare the results.

    python tests/compare.py SF_DIR [name ...]
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def session(cpus: int = 8):
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("sparkstats")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns, types and rows; else what differs."""
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    types = dict(zip(cols, [str(c[1]) for c in rel.description]))
    theirs = rel.fetchall()
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    bad = {c: (t, types[c]) for c, t in df.dtypes if names.get(t) != types[c]}
    order = sorted(cols)
    at = [cols.index(c) for c in order]
    key = lambda row: tuple((v is None, str(type(v)), v) for v in row)
    a = sorted([tuple(_plain(r[c]) for c in order) for r in df.collect()], key=key)
    b = sorted([tuple(_plain(r[i]) for i in at) for r in theirs], key=key)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    off = [(x, y) for x, y in zip(a, b) if x != y]
    if off:
        return f"{len(off)} of {len(a)} rows differ, e.g. {str(off[0])[:300]}"
    if bad:
        return f"types {bad}"
    return None if a else "no rows"


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    spark, con = session(), database(sf)
    oracles, failed = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            verdict = difference(df, con, oracles[name]) if name in oracles else (None if df.count() else "no rows")
        except Exception as e:  # noqa: BLE001
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - t:.1f}s {'' if name in oracles else '(rows only) '}{verdict or ''}", flush=True)
        if verdict:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
