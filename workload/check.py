"""Compare registered queries with their SQL: ``python -m workload.check <sf_dir> [names]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from workload.queries import QUERIES
from workload.sql import TABLES, oracle_sql

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


#: What no registered plan may hold.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "InPandas")


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, sf_dir: str, names=None):
    """Yield (name, verdict, row count, seconds)."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    oracle = oracle_sql()
    for name, run in QUERIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
        except Exception as error:  # report it and go on with the other queries
            yield name, f"FAILED {str(error)[:600]}", 0, time.time() - start
            continue
        seconds = time.time() - start
        plan = df._jdf.queryExecution().executedPlan().toString()
        if held := [operator for operator in FORBIDDEN if operator in plan]:
            yield name, f"PLAN {held}", len(got), seconds
            continue
        if name not in oracle:
            yield name, "rows only", len(got), seconds
            continue
        cursor = con.execute(oracle[name])
        columns = [d[0] for d in cursor.description]
        want = rows_of(columns, cursor.fetchall())
        if sorted(columns) != sorted(df.columns):
            verdict = f"COLUMNS {sorted(df.columns)} {sorted(columns)}"
        elif got == want:
            described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {oracle[name]}").fetchall()}
            types = [(c, t, described[c]) for c, t in df.dtypes if TYPES.get(t) != described[c]]
            verdict = f"TYPES {types}" if types else "ok"
        else:
            differing = [p for p in zip(got, want) if p[0] != p[1]][:3]
            verdict = f"DIFFERS {len(got)} {len(want)} {differing}"
        yield name, verdict, len(got), seconds


if __name__ == "__main__":
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    for name, verdict, count, seconds in compare(session, sys.argv[1], sys.argv[2:]):
        print(f"{name:32s} {seconds:6.2f}s {count:8d} {verdict}"[:900], flush=True)
