"""Compare a Spark result with a DuckDB query over the same parquet tables."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) if v != v.to_integral_value() else int(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = list(spark_df.columns)
    s_rows = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = rows_of(d_cols, res.fetchall())
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"values differ: spark-only={only_s} duck-only={only_d}"
    return True, f"{len(s_rows)} rows"
