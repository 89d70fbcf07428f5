"""Compare registered queries with their SQL: names, types, row counts and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from tidelog.catalog import REGISTRY, SQL
from tidelog.sources.tables import SCHEMAS, table_path

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{table_path(sf_dir, name)}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None when equal, else what differs."""
    df = REGISTRY[name](spark, sf_dir)
    if name not in SQL:
        return None if df.count() > 0 else "no rows"
    result = con.execute(SQL[name])
    want_types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    got_types = dict(df.dtypes)
    if want_types != got_types:
        return f"schema: spark {got_types} sql {want_types}"
    columns = sorted(got_types)
    want = Counter(
        tuple(_cell(r[i]) for i in sorted(range(len(want_types)), key=lambda k: list(want_types)[k]))
        for r in result.fetchall()
    )
    got = Counter(tuple(_cell(r[c]) for c in columns) for r in df.collect())
    if not want:
        return "sql gives no rows"
    if want != got:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"rows {sum(got.values())} vs {sum(want.values())}; extra {extra}; missing {missing}"
    return None


def main() -> None:
    from tidelog.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in wanted or REGISTRY:
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} of {len(wanted or REGISTRY)} differ")


if __name__ == "__main__":
    main()
