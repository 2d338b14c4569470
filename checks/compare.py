"""Run registered queries and their SQL side by side and compare the rows, order aside.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import tempfile
import time
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from tallywire.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str) -> tuple[bool, str]:
    started = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    seconds = time.perf_counter() - started
    if name not in ORACLE:
        return False, f"{len(ours)} rows, and no SQL to hold them against"
    relation = connection.execute(ORACLE[name])
    columns = [d[0] for d in relation.description]
    theirs = rows_of(columns, relation.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    if ours != theirs:
        only = [row for row in ours if row not in set(theirs)][:2]
        other = [row for row in theirs if row not in set(ours)][:2]
        return False, f"{len(ours)} against {len(theirs)} rows; only ours {only}; only SQL {other}"
    return True, f"{len(ours)} rows, {seconds:.1f} s"


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    shared = tempfile.mkdtemp(prefix="compare-")
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": shared}
    spark = build_session("local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        try:
            same, text = compare(spark, connection, args.sf, name)
        except Exception as error:  # noqa: BLE001
            same, text = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not same
        print("ok  " if same else "FAIL", name, text, flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
