"""Small result tables turned from long to wide and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivoted(df: DataFrame, row: str, column: str, value: str, labels: Sequence[str], fill: float | int) -> DataFrame:
    """One row per ``row`` value and one column per given label; absent cells get ``fill``."""
    return df.groupBy(row).pivot(column, list(labels)).agg(F.sum(value)).fillna(fill, list(labels))


def completed(df: DataFrame, row: str, column: str, value: str, fill: float | int) -> DataFrame:
    """Every ``row`` label with every ``column`` label, summed; absent cells get ``fill``.

    All column labels travel as one array and each row label brings its cells as one map, so
    labels are data: any number, NULL and any characters.  Both are one entry per label.
    """
    label = F.struct(F.col(column).alias("label"))
    cells = df.groupBy(row, column).agg(F.sum(value).alias("cell"))
    labels = df.agg(F.sort_array(F.collect_set(label))).scalar()
    known = F.map_from_entries(F.collect_list(F.struct(label.alias("key"), F.col("cell").alias("value"))))
    return (
        cells.groupBy(row)
        .agg(known.alias("_cells"))
        .select(row, "_cells", F.explode(labels).alias("_at"))
        .select(row, F.col("_at.label").alias(column), F.coalesce(F.try_element_at("_cells", F.col("_at")), F.lit(fill)).alias(value))
    )
