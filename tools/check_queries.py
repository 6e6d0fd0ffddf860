"""Run registered queries next to their SQL and compare rows.

    python tools/check_queries.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from classkit.plans import ORACLES, QUERIES  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in records)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for t in TABLES.split():
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    failed = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            mine = rows_of(df.columns, df.collect())
        except Exception as error:  # report and go on with the next query
            failed += 1
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - start
        if name not in ORACLES:
            print(f"rows {name}: {len(mine)} rows, {took:.2f}s", flush=True)
            continue
        try:
            result = duck.execute(ORACLES[name])
            theirs = rows_of([c[0] for c in result.description], result.fetchall())
        except Exception as error:
            failed += 1
            print(f"SQL  {name}: {str(error)[:800]}", flush=True)
            continue
        names = sorted(c[0] for c in result.description)
        types = {c[0]: str(c[1]) for c in result.description}
        if names == sorted(df.columns) and mine == theirs:
            print(f"ok   {name}: {len(mine)} rows, {took:.2f}s", flush=True)
        else:
            failed += 1
            print(f"DIFF {name}: {len(mine)} vs {len(theirs)} rows, columns {sorted(df.dtypes)} vs {sorted(types.items())}")
            shown = [(a, b) for a, b in zip(mine, theirs) if a != b][:3]
            for a, b in shown:
                print("   mine", a, "\n   sql ", b, flush=True)
    print(f"{failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
