"""Compares a Spark result with DuckDB rows, independent of row and column order."""

from __future__ import annotations

import datetime
import decimal

TESTDATA = "/root/testdata"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TESTDATA}/{sf}/{t}.parquet'")
    return con


def kind(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, decimal.Decimal):
        return "decimal"
    if isinstance(value, datetime.datetime):
        return "timestamp"
    if isinstance(value, datetime.date):
        return "date"
    return "str"


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple], dict[str, set]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = sorted((tuple(repr(r[i]) for i in order) for r in rows))
    kinds = {columns[i]: {kind(r[i]) for r in rows} - {"null"} for i in order}
    return [columns[i] for i in order], out, kinds


def differences(df, con, sql: str) -> list[str]:
    got_cols, got, got_kinds = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want, want_kinds = canonical([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return [f"columns {got_cols} vs {want_cols}"]
    found = []
    for c in got_cols:
        if got_kinds[c] != want_kinds[c]:
            found.append(f"type of {c}: {got_kinds[c]} vs {want_kinds[c]}")
    if len(got) != len(want):
        found.append(f"{len(got)} rows vs {len(want)}")
    extra, missing = set(got) - set(want), set(want) - set(got)
    if extra or missing:
        found.append(f"{len(extra)} extra, {len(missing)} missing; "
                     f"{sorted(extra)[:2]} vs {sorted(missing)[:2]}")
    return found
