"""Order-insensitive comparison of a Spark result with a DuckDB result:
row count, column names (sorted) and the multiset of normalised rows."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from dataclasses import dataclass

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@dataclass
class Comparison:
    name: str
    spark_rows: int
    oracle_rows: int
    columns_match: bool
    values_match: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return (self.spark_rows == self.oracle_rows and self.columns_match
                and self.values_match)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def digest(columns, rows) -> str:
    h = hashlib.sha256()
    for r in _rows(columns, rows):
        h.update(repr(r).encode())
    return h.hexdigest()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES + ["events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(name: str, spark_df, con, sql: str) -> Comparison:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    cols_ok = sorted(s_cols) == sorted(o_cols)
    vals_ok = cols_ok and digest(s_cols, s_rows) == digest(o_cols, o_rows)
    detail = ""
    if not vals_ok:
        a = set(_rows(s_cols, s_rows)) if cols_ok else set()
        b = set(_rows(o_cols, o_rows)) if cols_ok else set()
        detail = (f"cols spark={sorted(s_cols)} oracle={sorted(o_cols)}; "
                  f"only_spark={sorted(a - b, key=repr)[:3]} only_oracle={sorted(b - a, key=repr)[:3]}")
    return Comparison(name, len(s_rows), len(o_rows), cols_ok, vals_ok, detail)
