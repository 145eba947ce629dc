"""Compare a Spark query with its DuckDB oracle: row count, column names, values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is None:
            return v
        return float(f"{v:.{digits}g}")
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def _rows(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def compare(spark_df, con, sql: str, digits: int | None = 12) -> dict:
    s_cols = spark_df.columns
    s_types = dict(spark_df.dtypes)
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = [c for c in rel.columns]
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    res = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
    }
    if not res["cols_match"]:
        res["cols"] = (sorted(s_cols), sorted(d_cols))
    a, b = _rows(s_cols, s_rows, digits), _rows(d_cols, d_rows, digits)
    res["values_match"] = res["cols_match"] and a == b
    if not res["values_match"] and res["cols_match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(sa - sb, key=str)[:3]
        res["only_oracle"] = sorted(sb - sa, key=str)[:3]
    res["types_match"] = all(SPARK_TO_DUCK.get(s_types[c], s_types[c]) == d_types.get(c) for c in s_cols)
    if not res["types_match"]:
        res["types"] = {c: (s_types[c], d_types.get(c)) for c in s_cols}
    res["ok"] = res["values_match"] and res["types_match"] and res["rows_spark"] == res["rows_oracle"]
    return res
