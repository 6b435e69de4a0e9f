"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python -m checks.compare FOLDER [NAME ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import all_sql
from checks.queries import all_queries


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    """A connection that sees every table of the folder."""
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value, dates as text."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if frame[name].dtype == object or "datetime" in str(frame[name].dtype):
            frame[name] = frame[name].map(lambda v: None if pd.isna(v) else str(v)[:1000])
            if name == "timestamp":
                frame[name] = frame[name].str[:10]
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(result: DataFrame, expected: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    want = expected.execute(sql).df()
    got = result.toPandas()
    if sorted(want.columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    want, got = canonical(want), canonical(got)
    if len(want) != len(got):
        return f"{len(got)} rows != {len(want)}"
    try:
        pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)
    except AssertionError as error:
        return str(error).replace("\n", " ")[:400]
    return None


def type_difference(result: DataFrame, expected: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """Which column types differ, or None."""
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    want = dict(d[:2] for d in expected.execute(f"select * from ({sql}) limit 0").description)
    got = {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
           for f in result.schema}
    wrong = [f"{n}: {got[n]} != {want[n]}" for n in got if got[n] != str(want[n])]
    return "types " + ", ".join(wrong) if wrong else None


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables, sql, wrong = duck(folder), all_sql(), 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        result = query(spark, folder)
        if name in sql:
            found = difference(result, tables, sql[name])
            found = found or type_difference(result, tables, sql[name])
        else:
            found = None if result.count() else "no rows"
        wrong += found is not None
        print(f"{name:40s} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
