"""Independent DuckDB SQL for every registered query (the correctness oracle)."""

from oracle.duckdb_sql import ORACLE_SQL, oracle_sql

__all__ = ["ORACLE_SQL", "oracle_sql"]
