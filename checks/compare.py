"""Run registered queries beside their SQL: ``python -m checks.compare [dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


SPARK_TO_DUCKDB = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def differences(df, rows: list, relation) -> list[str]:
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} vs {sorted(relation.columns)}"]
    found = []
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in df.dtypes:
        if SPARK_TO_DUCKDB.get(kind) != kinds[name]:
            found.append(f"type of {name}: {kind} vs {kinds[name]}")
    left = sorted((tuple(r) for r in rows), key=_key)
    quoted = ", ".join(f'"{n}"' for n in names)
    right = sorted(relation.select(quoted).fetchall(), key=_key)
    if len(left) != len(right):
        return found + [f"{len(left)} rows vs {len(right)}"]
    for a, b in zip(left, right):
        if a != b and not all(
            x == y or (isinstance(x, float) and isinstance(y, float)
                       and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        ):
            return found + [f"{names}\n   spark {a}\n   duck  {b}"]
    return found


def main(sf_dir: str, chosen: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, function in QUERIES.items():
        if chosen and name not in chosen:
            continue
        started, taken = time.monotonic(), 0.0
        try:
            df = function(spark, sf_dir)
            if name in ORACLE:
                left = df.select(*sorted(df.columns)).collect()
                taken = time.monotonic() - started
                relation = con.sql(ORACLE[name])
                found = differences(df, left, relation)
                note = "ok" if not found else "DIFFERS"
            else:
                found, note = [], f"rows only: {df.count()}"
                taken = time.monotonic() - started
        except Exception as error:  # report and go on with the next query
            found, note = [str(error)[:1500]], "ERROR"
        bad += bool(found)
        print(f"{name:28s} {taken:6.2f}s of {time.monotonic() - started:6.2f}s {note}", *found, sep="\n   "
              if found else " ", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(folder, sys.argv[2:]))
