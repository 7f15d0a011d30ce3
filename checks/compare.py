"""Run registered queries next to their SQL and compare the rows.

    python -m checks.compare [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

from checks.oracle import ORACLE
from checks.registered import QUERIES
from starlens.session import local_session

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def cell(value):
    """A comparable form that still tells numbers of different kinds apart."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("float", repr(value))
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    return (type(value).__name__, value)


def bag(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET timezone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


# Operators that would not scale: row-wise Python and joins without a key.
UNWANTED = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
            "BroadcastNestedLoopJoin")


def differences(spark, db, sf_dir: str, name: str) -> tuple[int, list[str]]:
    """Number of rows Spark returned and what differs from the SQL."""
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [operator for operator in UNWANTED if operator in plan]
    if found:
        return len(rows), [f"plan has {found}"]
    if name not in ORACLE:
        return len(rows), [] if rows else ["no rows"]
    result = db.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return len(rows), [f"columns {sorted(df.columns)} against {sorted(names)}"]
    got, expected = bag(rows, df.columns), bag(result.fetchall(), names)
    if got == expected:
        return len(rows), []
    extra, lacking = got - expected, expected - got
    return len(rows), [
        f"{sum(extra.values())} extra, {sum(lacking.values())} lacking",
        f"extra {list(extra)[:2]}",
        f"lacking {list(lacking)[:2]}",
    ]


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, db = local_session(8), connect(args.sf)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            n, problems = differences(spark, db, args.sf, name)
        except Exception as error:  # report and go on with the next query
            n, problems = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        kind = "sql " if name in ORACLE else "rows"
        print(f"{'ok  ' if not problems else 'FAIL'} {kind} {name} {n} {time.time() - start:.1f}s",
              flush=True)
        for problem in problems:
            print("     ", problem[:900], flush=True)
        failed += bool(problems)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
