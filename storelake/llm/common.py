"""Helpers the training-data operators share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.session import apply_settings

# A word is a run of anything but ASCII blanks; ``bytes.split()`` cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

# A Python task holds one Arrow batch at a time, so its memory follows these, not the partition.
BATCH_ROWS = "500"
BATCH_BYTES = "16777216"


def prepared(spark: SparkSession) -> SparkSession:
    """Settings for the Python stages, and this checkout on the workers' import path.

    The path matters only where workers share the driver's files and were not started in
    this folder; clusters ship the package with ``--py-files`` as usual.
    """
    apply_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = root + (os.pathsep + known if known else "")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_bucket(buckets: int) -> Column:
    """crc32 of the document id as text, modulo ``buckets``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % buckets


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def same(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    """Equality of all keys where null equals null."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition
