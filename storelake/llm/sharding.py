"""Sharding by a two-pass external shuffle.

Pass one scatters records into buckets by seeded hashes of their ids: a consistent hash picks
the shard (one more shard takes rows only into itself), further bits one of the shard's buckets,
as many as keep a bucket memory-sized.  Pass two reads one bucket at a time, puts it into a
fixed order, applies a Fisher-Yates shuffle seeded by the bucket, and hands out slots that
follow on from the shard's earlier buckets.

Defined results
    null text         size 8, the checksum of the empty text
    null id           an id like any other
    repeated rows     rows of their own; equal rows share a shard, and a bucket
    very long text    a record like any other; a bucket is never smaller than its largest record
    empty table       no rows
    clashing columns  ``shard`` and ``slot`` replace columns of the same name
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

SHARDS = 24
SEED = 7
BUCKET_BYTES = 16 << 20
ROW_BYTES = 8


def record_size() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES


def shard_of(shards: int, seed: int = SEED) -> Column:
    """Highest random weight: the shard with the largest hash of (id, shard) takes the row.

    A further shard only wins rows for itself, because the other weights stay as they are.
    """
    weights = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("w"), F.lit(s).alias("s")) for s in range(shards)]
    return F.greatest(*weights)["s"] if shards > 1 else F.lit(0)


def _fisher_yates(seed: int, order: list[str], drop: list[str]):
    def shuffled(key: tuple[pa.Scalar, ...], bucket: pa.Table) -> pa.Table:
        # A fixed order first: what arrives depends on which map task ended when.
        bucket = bucket.take(pc.sort_indices(bucket, sort_keys=[(c, "ascending") for c in order]))
        shard, part = bucket["_shard"][0].as_py(), bucket["_bucket"][0].as_py()
        places = np.random.default_rng([seed, shard, part]).permutation(bucket.num_rows)
        slots = pa.array(bucket["_offset"][0].as_py() + np.arange(bucket.num_rows, dtype="int64"))
        bucket = bucket.take(pa.array(places))
        shards = pa.array(np.full(bucket.num_rows, shard, dtype="int32"))
        return bucket.drop_columns(drop).append_column("shard", shards).append_column("slot", slots)

    return shuffled


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (gapless from 0 in each shard), every shard in random order."""
    keep = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    content = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], shard_of(shards, seed).alias("_shard"), content.alias("_content"))
    total = docs.agg(F.sum(record_size()).alias("b")).first()["b"] or 0
    parts = max(1, -(-total // (bucket_bytes * shards)))
    rows = rows.withColumn("_bucket", F.pmod(F.col("_content"), F.lit(parts)).cast("int"))

    counts = rows.groupBy("_shard", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_shard", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    order = ["_content", *(f.name for f in schema.fields[:-2] if isinstance(f.dataType, (T.StringType, T.IntegralType)))]
    return (
        rows.join(offsets, ["_shard", "_bucket"])
        .select(*[F.col(f"`{c}`") for c in keep], "_shard", "_bucket", "_content", "_offset")
        .groupBy("_shard", "_bucket")
        .applyInArrow(_fisher_yates(seed, order, ["_shard", "_bucket", "_content", "_offset"]), schema)
    )


def written_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the shards as ``shard=<n>`` folders; the slot orders the records inside one.

    Every task writes the buckets it shuffled, so no shard is gathered in one task.
    """
    sharded(docs, **options).write.partitionBy("shard").parquet(path)
