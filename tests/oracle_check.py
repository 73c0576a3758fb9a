"""Run every registered query on Spark and its oracle SQL on DuckDB; compare
row count, column names/types and an order-insensitive hash of the values.

Usage: python tests/oracle_check.py [sf_dir] [query-name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "smallint": "SMALLINT",
}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    return repr(v)


def digest(rows):
    lines = sorted("|".join(_norm(v) for v in r) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    s_rows = [tuple(r[c] for c in cols) for r in df.collect()]
    ts = time.time() - t
    if sql is None:
        return dict(name=name, rows=len(s_rows), oracle=False, spark_s=round(ts, 2))
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    d_all = rel.fetchall()
    idx = {c: i for i, c in enumerate(d_cols)}
    ok_cols = sorted(d_cols) == cols
    d_rows = [tuple(r[idx[c]] for c in cols) for r in d_all] if ok_cols else []
    return dict(
        name=name,
        rows=len(s_rows),
        oracle_rows=len(d_all),
        cols_match=ok_cols,
        types_match=ok_cols and all(s_types[c] == d_types[c] for c in cols),
        type_diff={c: (s_types[c], d_types.get(c)) for c in cols if s_types[c] != d_types.get(c)},
        hash_match=ok_cols and digest(s_rows) == digest(d_rows),
        spark_s=round(ts, 2),
    )


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import duckdb
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", os.environ.get("SESSION_TZ", "UTC"))
             .config("spark.ui.enabled", "false")
             .config("spark.sql.ansi.enabled", os.environ.get("SPARK_ANSI", "true"))
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, error=f"{type(e).__name__}: {str(e)[:400]}")
        good = r.get("hash_match", r.get("oracle") is False) and "error" not in r
        bad += not good
        print(("OK  " if good else "BAD ") + str(r), flush=True)
    print(f"{bad} failing", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
