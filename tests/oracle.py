"""Run a registered query and its SQL twin on the same tables and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    return v


def spark_rows(df) -> tuple[list[str], Counter, dict]:
    cols = sorted(df.columns)
    rows = Counter(tuple(_value(r[c]) for c in cols) for r in df.select(*cols).collect())
    return cols, rows, {f.name: f.dataType.simpleString() for f in df.schema}


def sql_rows(con, sql: str) -> tuple[list[str], Counter, dict]:
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_value(r[i]) for i in order) for r in rel.fetchall())
    return sorted(names), rows, dict(zip(names, map(str, rel.types)))


TYPES = {"bigint": ("BIGINT", "INTEGER"), "int": ("INTEGER",), "double": ("DOUBLE",), "string": ("VARCHAR",), "boolean": ("BOOLEAN",)}


def differences(df, con, sql: str) -> list[str]:
    s_cols, s_rows, s_types = spark_rows(df)
    d_cols, d_rows, d_types = sql_rows(con, sql)
    if s_cols != d_cols:
        return [f"columns {s_cols} != {d_cols}"]
    out = [f"type of {c}: {s_types[c]} != {d_types[c]}" for c in s_cols if d_types[c] not in TYPES.get(s_types[c], ())]
    if s_rows != d_rows:
        only_s, only_d = s_rows - d_rows, d_rows - s_rows
        out.append(f"{s_rows.total()} vs {d_rows.total()} rows; only spark {only_s.total()}, only sql {only_d.total()}")
        out += [f"spark: {str(r)[:400]}" for r in list(only_s)[:2]] + [f"sql:   {str(r)[:400]}" for r in list(only_d)[:2]]
    if not s_rows and not out:
        out.append("warning: no rows")
    return out
