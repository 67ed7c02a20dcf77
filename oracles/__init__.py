"""Independent SQL answers for every registered query, on the same parquet tables."""

from oracles.answers import oracle_sql

__all__ = ["oracle_sql"]
