"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's gate).

Columns are sorted by name; rows are compared as a multiset after rounding
doubles to ``digits`` significant decimals.
"""

from __future__ import annotations

import math

from ..sources.tables import TABLES, table_path


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _canon(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return round(v, digits) + 0.0
    if hasattr(v, "item"):
        return _canon(v.item(), digits)
    return v


def _rows(cols, records, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in records:
        out.append(tuple(_canon(r[i], digits) for i in order))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, sql: str, sf_dir: str, con=None, digits: int = 6) -> dict:
    con = con or duck_connect(sf_dir)
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "spark_rows": len(s_rows),
        "duck_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_cols": sorted(s_cols),
        "duck_cols": sorted(d_cols),
    }
    a, b = _rows(s_cols, s_rows, digits), _rows(d_cols, d_rows, digits)
    out["values_match"] = a == b
    if not out["values_match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diff
    s_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    d_types = {d[0]: str(d[1]).upper() for d in res.description}
    mism = {c: (s_types[c], d_types.get(c)) for c in s_types
            if c in d_types and TYPE_MAP.get(s_types[c], s_types[c].upper()) != d_types[c]}
    out["types_match"] = not mism
    if mism:
        out["type_diffs"] = mism
    out["ok"] = out["cols_match"] and out["values_match"] and len(s_rows) == len(d_rows) and out["types_match"]
    return out


TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "float": "FLOAT",
            "boolean": "BOOLEAN", "tinyint": "TINYINT", "smallint": "SMALLINT"}
