"""Run registered queries next to their SQL and compare every row.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as entry
from tillframe.session import get_session


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


TYPES = {
    "boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def spark_rows(df) -> tuple[list[tuple[str, str]], list[tuple]]:
    columns = sorted(df.dtypes)
    columns = [(name, TYPES.get(kind, kind)) for name, kind in columns]
    return columns, [tuple(row) for row in df.select(*[name for name, _ in columns]).collect()]


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[tuple[str, str]], list[tuple]]:
    result = connection.execute(sql)
    columns = [(column[0], str(column[1])) for column in result.description]
    places = [columns.index(column) for column in sorted(columns)]
    return sorted(columns), [tuple(row[i] for i in places) for row in result.fetchall()]


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    columns, mine = spark_rows(df)
    other_columns, theirs = sql_rows(connection, sql)
    if columns != other_columns:
        return [f"columns {sorted(set(columns) ^ set(other_columns))}"]
    if len(mine) != len(theirs):
        return [f"rows {len(mine)} / {len(theirs)}"]
    unequal = [(a, b) for a, b in zip(ordered(mine), ordered(theirs)) if a != b]
    return [f"{len(unequal)} unequal rows, first {unequal[0]}"] if unequal else []


def main(sf_dir: str, *only: str) -> int:
    spark = get_session("compare", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = database(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        try:
            df = query(spark, sf_dir)
            problems = differences(df, connection, sql[name]) if name in sql else []
            if name not in sql:
                df.show(20, truncate=60)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':5}{name:28}{time.perf_counter() - start:7.2f}s", *problems, flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
