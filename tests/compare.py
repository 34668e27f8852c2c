"""Run registered queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    """A value with its kind, so that 1, 1.0 and '1' stay apart."""
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return ("nan",) if math.isnan(number) else ("float", number)
    if isinstance(value, (dt.datetime, dt.date)):
        return ("time", str(value))
    return ("text", str(value))


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(spark, con, folder: str, run, sql: str) -> str | None:
    frame = run(spark, folder)
    names, ours = normal(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    wanted_names, wanted = normal([c[0] for c in result.description], result.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(ours) != len(wanted):
        return f"rows {len(ours)} != {len(wanted)}"
    for a, b in zip(ours, wanted):
        if a != b:
            return f"first difference\n  spark  {a}\n  duckdb {b}"
    return "no rows" if not ours else None


def main() -> None:
    from pyspark.sql import SparkSession

    from mercato.checks import ORACLES, QUERIES

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    chosen = [n for n in QUERIES if not sys.argv[1:] or any(a in n for a in sys.argv[1:])]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(folder)
    bad = 0
    for name in chosen:
        began = time.time()
        try:
            if name in ORACLES:
                problem = difference(spark, con, folder, QUERIES[name], ORACLES[name])
            else:
                problem = None if QUERIES[name](spark, folder).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")


if __name__ == "__main__":
    main()
