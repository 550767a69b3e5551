"""Run a registered query and its SQL side by side and compare every value."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_decimal(t):
        return "decimal"
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{_kind(t.value_type)}>"
    return str(t)


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, list):
        return tuple(_cell(x) for x in v)
    return v


def as_rows(table: pa.Table):
    names = sorted(table.column_names)
    cols = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    kinds = {n: _kind(table.schema.field(n).type) for n in names}
    rows = sorted(zip(*cols), key=lambda r: tuple((x is not None, str(x)) for x in r))
    return names, kinds, rows


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences as text; an empty list means equal."""
    n1, k1, r1 = as_rows(spark_df.toArrow())
    n2, k2, r2 = as_rows(con.sql(sql).to_arrow_table())
    if n1 != n2:
        return [f"columns {n1} vs {n2}"]
    out = []
    if k1 != k2:
        out.append(f"types { {n: (k1[n], k2[n]) for n in n1 if k1[n] != k2[n]} }")
    if len(r1) != len(r2):
        out.append(f"rows {len(r1)} vs {len(r2)}")
    bad = [(a, b) for a, b in zip(r1, r2) if a != b]
    if bad:
        out.append(f"{len(bad)} rows differ, columns {n1}, first {bad[:3]}")
    return out
