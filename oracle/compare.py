"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date, int, str, bool)):
        return str(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def digest(cols, rows):
    """(sorted column names, sha256 of sorted normalised rows, the rows)."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark_df, con, sql: str):
    """Return (ok, message)."""
    srows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sh, sl = digest(spark_df.columns, srows)
    dc, dh, dl = digest(dcols, drows)
    if len(srows) == len(drows) and sc == dc and sh == dh:
        return True, f"{len(srows)} rows"
    dset, sset = set(dl), set(sl)
    return False, (f"spark {len(srows)} rows {sc} / duckdb {len(drows)} rows {dc}; "
                   f"spark-only {[x for x in sl if x not in dset][:2]} "
                   f"duckdb-only {[x for x in dl if x not in sset][:2]}")
