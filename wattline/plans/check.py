"""Local twin of the driver's correctness gate: Spark query vs DuckDB oracle.

Used by the tests and during development; compares row count, column names
and an order-insensitive multiset of canonicalised rows.
"""

from __future__ import annotations

import datetime as _dt
import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v + 0.0)  # exact: queries already round as round(x + 1e-9, 6)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    if isinstance(v, dict):
        return repr(sorted((str(k), _canon(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return repr([_canon(x) for x in v])
    return str(v)


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "VARCHAR[]": "array<string>"}


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    res = {"name": name, "rows": len(rows)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    otypes = {d[0]: DUCK_TO_SPARK.get(str(d[1]), str(d[1])) for d in cur.description}
    stypes = dict(df.dtypes)
    tdiff = {c: (stypes[c], otypes[c]) for c in cols if c in otypes and stypes[c] != otypes[c]}
    if tdiff:
        res["type_diff"] = tdiff
    orows = cur.fetchall()
    res["oracle_rows"] = len(orows)
    if sorted(cols) != sorted(ocols):
        res["status"] = f"COLUMNS {sorted(set(cols) ^ set(ocols))}"
        return res
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    oi = [ocols.index(c) for c in order]
    a = sorted(tuple(_canon(r[i]) for i in si) for r in rows)
    b = sorted(tuple(_canon(r[i]) for i in oi) for r in orows)
    if a == b:
        res["status"] = "match"
    else:
        res["status"] = "MISMATCH"
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        res["example"] = [dict(zip(order, x)) for pair in diff for x in pair][:2]
        if diff:
            d0 = {c: (p, q) for c, p, q in zip(order, diff[0][0], diff[0][1]) if p != q}
            res["diff_cols"] = d0
    return res
