"""Reading tenant configuration and source tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.sources.catalog import TableSpec

FETCH_ROWS = 5000


@dataclass(frozen=True)
class Tenant:
    tenant_id: str
    schema: str
    display_name: str


def read_tenants(spark: SparkSession, path: str) -> list[Tenant]:
    """Tenants of a ``{"tenants": [...]}`` JSON file; an empty list is an error."""
    text = T.StringType()
    entry = T.StructType([T.StructField(n, text) for n in ("tenant_id", "schema", "display_name")])
    layout = T.StructType([T.StructField("tenants", T.ArrayType(entry))])
    config = spark.read.schema(layout).option("multiLine", True).json(path)
    rows = config.select(F.explode("tenants").alias("t")).select("t.*").collect()
    if not rows:
        raise ValueError(f"no tenants configured in {path}")
    return [Tenant(*row) for row in rows]


def jdbc_source(
    spark: SparkSession,
    url: str,
    tenant: Tenant,
    spec: TableSpec,
    splits: int = 16,
    key_range: tuple[int, int] | None = None,
    **options: str,
) -> DataFrame:
    """One tenant's table in its source database.

    Spark pushes the catalog's column list and any ``updated_at > ...`` filter into the
    database.  The key splits the scan into ``splits`` parallel reads, over ``key_range`` or
    the smallest and largest key, which the database is asked for.
    """
    if splits > 1 and key_range is None:
        bounds = (
            spark.read.format("jdbc")
            .option("url", url)
            .option("query", f'SELECT min("{spec.key}") AS low, max("{spec.key}") AS high FROM "{tenant.schema}"."{spec.name}"')
            .options(**options)
            .load()
            .first()
        )
        key_range = (int(bounds[0]), int(bounds[1])) if bounds and bounds[0] is not None else None
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", f'"{tenant.schema}"."{spec.name}"')
        .option("fetchsize", FETCH_ROWS)
        .options(**options)
    )
    if key_range and splits > 1:
        reader = (
            reader.option("partitionColumn", spec.key)
            .option("lowerBound", key_range[0])
            .option("upperBound", key_range[1])
            .option("numPartitions", splits)
        )
    return reader.load().select(*spec.column_names)


def parquet_source(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """A source table exported as parquet, read with its declared schema."""
    return spark.read.schema(spec.source_schema).parquet(path)
