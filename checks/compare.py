"""Run queries beside their SQL and report differences.

Usage: python -m checks.compare SF_DIR [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from checks.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, connection, name, sf):
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLE:
        return [] if got else ["no rows"]
    result = connection.sql(ORACLE[name])
    out = []
    kinds = {f.name: KINDS.get(f.dataType.simpleString()) for f in df.schema}
    expected = dict(zip(result.columns, map(str, result.types)))
    if kinds != expected:
        odd = {k for k in kinds.keys() | expected.keys() if kinds.get(k) != expected.get(k)}
        out.append("schema " + str({k: (kinds.get(k), expected.get(k)) for k in odd}))
    if set(result.columns) == set(df.columns):
        wanted = rows_of(result.columns, result.fetchall())
        if len(got) != len(wanted):
            out.append(f"{len(got)} rows, expected {len(wanted)}")
        bad = [(g, w) for g, w in zip(got, wanted) if g != w]
        if bad:
            out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out


def main(sf: str, names: list[str]) -> int:
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found = differences(spark, connection, name, sf)
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        mark = "FAIL" if found else ("ok  " if name in ORACLE else "rows")
        print(f"{mark} {name} {time.time() - start:.2f}s", *found, flush=True)
    print(f"{failed} failed")
    spark.stop()
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
