"""Surrogate keys and audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def surrogate_key(*columns: str) -> Column:
    """Tenant-scoped key ``a-b-...``; NULL as soon as one part is NULL."""
    parts: list[Column] = []
    for position, column in enumerate(columns):
        if position:
            parts.append(F.lit("-"))
        parts.append(F.col(column).cast("string"))
    return F.concat(*parts)


def with_audit(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Stamp the build time every mart carries; tests inject a fixed one."""
    return df.withColumn("dbt_loaded_at", F.current_timestamp() if loaded_at is None else loaded_at)
