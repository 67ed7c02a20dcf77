"""Structured Streaming ingestion into the landing zone.

The stream keeps no state: micro-batches are landed as they come and versions are resolved
when the table is read, so memory does not grow with the number of keys and late versions
need no watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.sources.catalog import TENANT
from storelake.sources.landing import LandingZone


def file_changes(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000
) -> DataFrame:
    """Newly arrived parquet files as a stream."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def ingest_available(changes: DataFrame, zone: LandingZone, name: str, checkpoint: str, mode: str = "append") -> None:
    """Land everything that has arrived since the last run, then stop.

    Each micro-batch is one generation of the table, which also says that the batch is in: a
    batch that is replayed after a crash lands once, whether the crash was before or after its
    commit.  The stream's id is part of its checkpoint.  Without that checkpoint it is another
    stream, which lands what is still there again; reads collapse the repeats by version."""

    def land(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        zone.append_batch(batch, name, stream, batch_id)

    query = (
        changes.writeStream.foreachBatch(land)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def streamed(zone: LandingZone, name: str) -> DataFrame:
    """What streams landed, without the landing time."""
    return zone[name].select(TENANT, *[F.col(c) for c in zone.spec(name).column_names])
