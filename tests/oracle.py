"""Run registered queries in Spark and their SQL in DuckDB and compare the results.

    python -m tests.oracle [sf_dir] [name-part ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

from seriesmill.plans import all_queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    return v if isinstance(v, (int, str, bool)) else str(v)


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)].astype(object)
    return sorted((tuple(_cell(v) for v in r) for r in pdf.itertuples(index=False)), key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    query = all_queries()[name]
    df = query.run(spark, sf_dir)
    got = df.toPandas()
    if query.sql is None:
        return None if len(got) else "no rows"
    result = con.execute(query.sql)
    types = {d[0]: str(d[1]) for d in result.description}
    want = con.execute(query.sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    spark_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    differing = {c: (t, types[c]) for c, t in spark_types.items() if t != types[c]}
    if differing:
        return f"types {differing}"
    a, b = rows_of(got), rows_of(want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    from seriesmill.session import build_session

    sf_dir = next((a for a in sys.argv[1:] if a.startswith("/")), "/root/testdata/sf0.01")
    parts = [a for a in sys.argv[1:] if not a.startswith("/")]
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in all_queries():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as e:  # report every query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failures")


if __name__ == "__main__":
    main()
