"""Runs registered queries against their SQL: ``python tests/compare.py <folder> [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """First difference between a frame and the rows of a statement, or None."""
    mine = _rows(df.columns, df.collect())
    answer = con.sql(sql)
    theirs = _rows(answer.columns, answer.fetchall())
    if sorted(df.columns) != sorted(answer.columns):
        return f"columns {sorted(df.columns)} and {sorted(answer.columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} and {len(theirs)} rows"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} and {b}"
    return None


def main() -> None:
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.monotonic()
        try:
            if name in oracle_sql():
                df = query(spark, folder)
                found = difference(df, con, oracle_sql()[name])
                result = "same" if found is None else f"DIFFERENT: {found}"
            else:
                result = f"{query(spark, folder).count()} rows"
        except Exception as error:  # noqa: BLE001
            result = f"FAILED: {str(error)[:600]}"
        print(f"{name}: {result} ({time.monotonic() - began:.1f} s)", flush=True)


if __name__ == "__main__":
    main()
