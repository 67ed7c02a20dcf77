"""Keyed upsert streams: a state per key lets only versions through that are newer than all before.

The state is a streaming aggregation: the newest row of each key, with its version's rank and the batch it
came in, kept in the session's state store on disk and in the checkpoint.  Rows collapse to one per key
where they are read, and the state is read and written by the JVM, without a call per key.  Late and
repeated versions stop here, so a landing table fed by this stream holds few versions per key.  The state
grows with the keys, a row each; use it for tables whose keys come back, and the stateless stream of
``changes`` for others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.sources.catalog import TENANT, TableSpec
from storelake.sources.landing import LandingZone
from storelake.streaming.changes import ingest_available

STORE = "spark.sql.streaming.stateStore.providerClass"
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ranks(column: str) -> tuple[Column, Column]:
    """A value's rank: nulls are older than anything."""
    return F.col(column).isNotNull(), F.col(column)


def newest_changes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows of a change stream that were their key's newest version when they came; to be written
    in update mode.

    Equal stamps are settled by the table's tie-break columns; a repeat of the stored version is
    not newer.  Columns are the tenant and the table's own."""
    own = [c for c in spec.column_names if c != spec.key]
    # The same for all rows of a micro-batch, also when it is replayed, and later in the next one.
    batch = F.unix_millis(F.current_timestamp())
    rows = changes.select(TENANT, *spec.column_names).withColumn("_batch", batch)
    order = [r for c in (spec.version, *spec.tie_break) for r in _ranks(c)]
    # Of equal versions the one that came first stays.
    newest = F.max_by(F.struct("_batch", *own), F.struct(*order, -F.col("_batch")))
    newer = rows.groupBy(TENANT, spec.key).agg(newest.alias("newest")).filter(F.col("newest._batch") == batch)
    value = {c: F.col(f"newest.{c}") for c in own}
    return newer.select(TENANT, *[value[c].alias(c) if c in value else c for c in spec.column_names])


def upsert_available(changes: DataFrame, zone: LandingZone, name: str, checkpoint: str) -> None:
    """Land the newer versions among all that has arrived since the last run, then stop.

    State and offsets are restored from the checkpoint, so a run that died is taken up where its
    last whole micro-batch ended; a batch that is replayed lands once."""
    conf = changes.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, ON_DISK)
    try:
        ingest_available(newest_changes(changes, zone.spec(name)), zone, name, checkpoint, "update")
    finally:
        conf.set(STORE, before) if before else conf.unset(STORE)
