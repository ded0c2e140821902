"""Small fixed tables as inline relations (``VALUES``), evaluated in the JVM.

``spark.createDataFrame(list)`` goes through a Python RDD, so every job that
touches such a table starts Python workers.  An inline ``VALUES`` table is a
local relation: Catalyst folds it into the plan and a broadcast of it costs
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, dict):
        return "named_struct(" + ", ".join(f"'{k}', {_literal(x)}" for k, x in v.items()) + ")"
    if isinstance(v, (list, tuple)):
        return "array(" + ", ".join(_literal(x) for x in v) + ")"
    raise TypeError(f"unsupported literal {v!r}")


def local_table(spark: SparkSession, rows: list[tuple], columns: list[tuple[str, str]]) -> DataFrame:
    """Rows + ``[(name, sql_type)]`` -> DataFrame backed by an inline table."""
    names = [n for n, _ in columns]
    if not rows:
        cols = ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in columns)
        return spark.sql(f"SELECT {cols}").limit(0)
    values = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    select = ", ".join(f"CAST(c{i} AS {t}) AS `{n}`" for i, (n, t) in enumerate(columns))
    return spark.sql(f"SELECT {select} FROM VALUES {values} AS t({aliases})")
