"""Compare a Spark DataFrame with a DuckDB query, the way the driver does:
columns sorted by name, row count, schema, order-insensitive value hash."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import hashlib
import math
import os

import duckdb
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

_SPARK_TYPES = {
    T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT",
    T.ByteType: "TINYINT", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT",
    T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN", T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.DateType: "DATE",
}


def spark_type_name(t) -> str:
    for cls, name in _SPARK_TYPES.items():
        if isinstance(t, cls):
            return name
    if isinstance(t, T.ArrayType):
        return spark_type_name(t.elementType) + "[]"
    if isinstance(t, T.DecimalType):
        return "DECIMAL"
    return t.simpleString().upper()


def duck_type_name(t: str) -> str:
    t = str(t).upper()
    if t.startswith("DECIMAL"):
        return "DECIMAL"
    return t


def family(name: str) -> str:
    if name.endswith("[]"):
        return "array"
    if name in ("BIGINT", "INTEGER", "SMALLINT", "TINYINT", "HUGEINT", "UBIGINT"):
        return "int"
    if name in ("DOUBLE", "FLOAT", "DECIMAL"):
        return "float"
    return name


def norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if digits is None:
            return repr(v)
        if v == 0:
            return 0.0
        return float(f"{v:.{digits}g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    return v


def _hash(rows) -> str:
    h = hashlib.sha256()
    for r in sorted(repr(x) for x in rows):
        h.update(r.encode())
    return h.hexdigest()


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if glob.glob(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(sdf, sql: str, con, digits: int = 12) -> dict:
    s_cols = list(sdf.columns)
    s_types = {f.name: spark_type_name(f.dataType) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_types = {d[0]: duck_type_name(d[1]) for d in cur.description}
    d_rows = cur.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        out["ok"] = False
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    out["type_diffs"] = {c: (s_types[c], d_types[c]) for c in order
                         if s_types[c] != d_types[c]}
    out["family_match"] = all(family(s_types[c]) == family(d_types[c]) for c in order)
    for label, digits_ in (("hash_match", digits), ("exact_match", None)):
        sn = [tuple(norm(r[i], digits_) for i in si) for r in s_rows]
        dn = [tuple(norm(r[i], digits_) for i in di) for r in d_rows]
        out[label] = _hash(sn) == _hash(dn)
        if label == "hash_match" and not out[label]:
            ss, ds = set(map(repr, sn)), set(map(repr, dn))
            out["only_spark"] = sorted(ss - ds)[:3]
            out["only_oracle"] = sorted(ds - ss)[:3]
    out["ok"] = (out["hash_match"] and out["family_match"]
                 and len(s_rows) == len(d_rows))
    return out
