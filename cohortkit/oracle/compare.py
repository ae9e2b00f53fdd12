"""Compare a Spark result with DuckDB text the way the driver does: column names (sorted),
row count and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from dataclasses import dataclass

import duckdb

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    from decimal import Decimal

    if isinstance(v, Decimal):
        return round(float(v), 6)
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


@dataclass
class Result:
    name: str
    ok: bool
    rows_spark: int
    rows_oracle: int
    cols_ok: bool
    hash_ok: bool
    note: str = ""


def compare(name: str, spark_df, con, sql: str) -> Result:
    srows = [tuple(r) for r in spark_df.collect()]
    scols = spark_df.columns
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    cols_ok = sorted(scols) == sorted(ocols)
    hash_ok = cols_ok and digest(scols, srows) == digest(ocols, orows)
    note = "" if cols_ok else f"spark-only {sorted(set(scols) - set(ocols))} oracle-only {sorted(set(ocols) - set(scols))}"
    return Result(name, cols_ok and hash_ok and len(srows) == len(orows), len(srows), len(orows), cols_ok, hash_ok, note)
