"""Local stand-in for the driver's correctness gate: run a registered Spark
query and its DuckDB SQL on the same parquet tables and compare column names,
types, row counts and the sorted rows exactly."""

from __future__ import annotations

import datetime as dt
import math
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, list):
        return tuple(_canon(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = [SPARK_TO_DUCK.get(t, t) for _, t in sdf.dtypes]
    s_rows = [tuple(_canon(v) for v in r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = [tuple(_canon(v) for v in r) for r in rel.fetchall()]
    out = {"name": name, "rows_spark": len(s_rows), "rows_oracle": len(d_rows)}
    if sorted(s_cols) != sorted(d_cols):
        out["error"] = f"columns {s_cols} vs {d_cols}"
        return out
    order = [d_cols.index(c) for c in s_cols]
    d_types = [d_types[i] for i in order]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    if s_types != d_types:
        out["error"] = f"types {list(zip(s_cols, s_types))} vs {d_types}"
        return out
    if len(s_rows) != len(d_rows):
        out["error"] = "row count"
        return out
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    if diffs:
        out["error"] = f"{len(diffs)} differing rows, e.g. {diffs[0]}"
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from areapanel.session import get_session
    sf_dir = "/root/testdata/sf0.01"
    names = argv or list(E.queries())
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    sqls = E.oracle_sql()
    bad = 0
    for n in names:
        fn = E.queries()[n]
        if n not in sqls:
            rows = fn(spark, sf_dir).count()
            print(f"ROWS-ONLY {n}: {rows}")
            continue
        try:
            res = compare(spark, con, n, fn, sqls[n], sf_dir)
        except Exception as e:  # report and continue
            res = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = "error" not in res
        bad += not ok
        print(("OK   " if ok else "FAIL ") + n + ("" if ok else f": {res['error']}") +
              (f" rows={res.get('rows_spark')}" if ok else ""), flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
