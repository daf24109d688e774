"""Verification helper (not part of the library): compare a catalog key with its DuckDB oracle.

Rows are compared as multisets, columns by sorted name, doubles rounded to 9
significant digits (both sides already round their computed measures).
"""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

from pyspark.sql import SparkSession

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def normalized_rows(records, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@dataclass
class Outcome:
    key: str
    ok: bool
    spark_rows: int
    oracle_rows: int
    detail: str = ""


def compare_key(spark: SparkSession, con, key: str, sf_dir: str, query, sql: str) -> Outcome:
    df = query(spark, sf_dir)
    names = df.columns
    got = normalized_rows(df.collect(), names)
    cur = con.execute(sql)
    oracle_names = [c[0] for c in cur.description]
    want = normalized_rows(cur.fetchall(), oracle_names)
    if sorted(names) != sorted(oracle_names):
        return Outcome(key, False, len(got), len(want), f"columns {sorted(names)} != {sorted(oracle_names)}")
    if got != want:
        only_spark = [r for r in got if r not in set(want)][:3]
        only_oracle = [r for r in want if r not in set(got)][:3]
        return Outcome(key, False, len(got), len(want), f"spark-only {only_spark} oracle-only {only_oracle}")
    return Outcome(key, True, len(got), len(want))
