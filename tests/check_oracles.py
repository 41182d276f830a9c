"""Run registered queries against their SQL: ``python tests/check_oracles.py [folder] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb


def connect(folder: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def normalised(columns, rows):
    """Columns by name, rows sorted, cells exact (integers and equal floats compare alike)."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=lambda row: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row))


def compare(spark, connection, name, query, sql, folder):
    """Problem text, or an empty string when both sides agree cell for cell."""
    result = query(spark, folder)
    got = normalised(result.columns, [tuple(row) for row in result.collect()])
    relation = connection.sql(sql)
    want = normalised(relation.columns, relation.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, expected {len(want[1])}"
    wrong = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(wrong)} of {len(want[1])} rows differ, first {wrong[0]}" if wrong else ""


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles, failures = oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, connection, name, query, oracles[name], folder)
                label = "ok" if not problem else f"FAIL {problem}"
            else:
                rows = query(spark, folder).collect()
                label = f"rows only: {len(rows)}"
                problem = ""
        except Exception as error:  # report and go on with the next query
            problem = label = f"ERROR {str(error)[:600]}"
        failures += bool(problem)
        print(f"{name:32s} {time.time() - start:6.2f}s {label}", flush=True)
    unknown = set(oracles) - set(queries())
    print(f"queries {len(queries())}, oracles {len(oracles)}, failures {failures}, oracle without query {sorted(unknown)}")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main()))
