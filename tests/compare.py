"""Side-by-side comparison of a registered query with its SQL twin."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, datetime.datetime):
        return ("datetime", value)
    if isinstance(value, bool):
        return int(value)
    return value


def _key(row):
    return [(v is None, str(type(v)), v if v is not None else 0) for v in row]


def as_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns in name order, rows sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=_key)


_FAMILY = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "bigint", "double": "double",
           "string": "text", "date": "date", "boolean": "boolean",
           "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "text", "DATE": "date",
           "BOOLEAN": "boolean"}


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    df = query(spark, sf_dir)
    ours = as_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    theirs = as_rows(list(described), result.fetchall())
    found = []
    if ours[0] != theirs[0]:
        return [f"columns {sorted(set(ours[0]) ^ set(theirs[0]))}"]
    for name, kind in df.dtypes:
        if _FAMILY.get(kind, kind) != _FAMILY.get(described[name], described[name]):
            found.append(f"type of {name}: {kind} / {described[name]}")
    if len(ours[1]) != len(theirs[1]):
        found.append(f"rows {len(ours[1])} / {len(theirs[1])}")
    elif ours[1] != theirs[1]:
        bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
        cells = {ours[0][i] for a, b in bad for i in range(len(a)) if a[i] != b[i]}
        sample = next([(n, x, y) for n, x, y in zip(ours[0], a, b) if x != y] for a, b in bad)
        found.append(f"{len(bad)} rows differ in {sorted(cells)[:8]}, e.g. {sample[:4]}")
    return found
