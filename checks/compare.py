"""Compare queries with their SQL oracles: ``python -m checks.compare SF_DIR [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES, TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def rows_of(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, db: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> list[str]:
    """Nothing if the query and its oracle agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return []
    cursor = db.execute(ORACLES[name])
    titles = [d[0] for d in cursor.description]
    if sorted(titles) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} but oracle {sorted(titles)}"]
    want = rows_of(titles, cursor.fetchall())
    if got == want:
        return []
    return [
        f"rows {sum(got.values())} but oracle {sum(want.values())}",
        *[f"only query:  {row}" for row in list((got - want).elements())[:3]],
        *[f"only oracle: {row}" for row in list((want - got).elements())[:3]],
    ]


def main() -> int:
    sf_dir, *chosen = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    bad = 0
    for name in chosen or QUERIES:
        start = time.perf_counter()
        try:
            found = differences(spark, db, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - a failing query is a finding
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        mark = "DIFF" if found else ("ok" if name in ORACLES else "ran")
        print(f"{mark:5}{name:26}{time.perf_counter() - start:7.2f}s", *found, sep="\n      " if found else " ", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
