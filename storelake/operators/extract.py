"""From source rows to landed rows: tagging, typing and change selection."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.sources.catalog import TENANT, TableSpec

EPOCH = datetime.datetime(1970, 1, 1)


def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp")


def tagged(df: DataFrame, tenant_id: str) -> DataFrame:
    """Tenant column first."""
    return df.select(F.lit(tenant_id).alias(TENANT), "*")


def tenant_union(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All tenants' rows of one table, each tagged with its tenant."""
    out: DataFrame | None = None
    for tenant_id, df in frames.items():
        part = tagged(df, tenant_id)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no tenants")
    return out


def conformed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Catalog columns only, in catalog order and type (tenant column kept when present)."""
    lead = [TENANT] if TENANT in df.columns else []
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.source_schema.fields]
    return df.select(*lead, *columns)


def micros(moment: datetime.datetime | int) -> int:
    """Microseconds since 1970 in UTC; a zone-less datetime is taken as UTC.

    Watermarks stay numbers in Python: a zone-less datetime goes through the machine's zone,
    whose repeated hour in autumn is ambiguous."""
    if isinstance(moment, int):
        return moment
    zero = EPOCH if moment.tzinfo is None else EPOCH.replace(tzinfo=datetime.timezone.utc)
    return (moment - zero) // datetime.timedelta(microseconds=1)


def instant(moment: datetime.datetime | int) -> Column:
    """A time stamp literal, folded by the optimizer and so pushed down."""
    return F.timestamp_micros(F.lit(micros(moment)).cast("long"))


def changed_since(df: DataFrame, version: str, since: datetime.datetime | int) -> DataFrame:
    """One tenant's rows strictly newer than the watermark; a literal, so it is pushed down."""
    return df.filter(F.col(version) > instant(since))


def incremental_extract(df: DataFrame, state: DataFrame, version: str = "updated_at") -> DataFrame:
    """Changed rows of all tenants at once.

    ``state``: ``tenant_id, watermark``, one row per tenant.  A tenant without state starts
    at the epoch.  Rows equal to the watermark stay out.  The state becomes literals (one
    comparison per tenant), so the cut-offs reach the scan of the source."""
    marks = state.groupBy(TENANT).agg(F.max(F.unix_micros("watermark")).alias("mark")).collect()
    known = {r[TENANT]: r["mark"] or 0 for r in marks if r[TENANT] is not None}
    newer = F.col(version) > instant(0)
    if not known:
        return df.filter(newer)
    condition = newer & (F.col(TENANT).isNull() | ~F.col(TENANT).isin(list(known)))
    for tenant, mark in known.items():
        condition = condition | ((F.col(TENANT) == tenant) & (F.col(version) > instant(mark)))
    return df.filter(condition)


def advanced_watermarks(
    extracted: DataFrame, state: DataFrame, version: str = "updated_at"
) -> DataFrame:
    """Rows pulled and the new watermark per tenant; without rows it stays where it was."""
    pulled = extracted.groupBy(TENANT).agg(
        F.count(F.lit(1)).alias("rows"), F.max(version).alias("_newest")
    )
    since = F.coalesce("watermark", epoch())
    return pulled.join(state.select(TENANT, "watermark"), TENANT, "full").select(
        TENANT,
        F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
        F.greatest(since, F.coalesce("_newest", since)).alias("watermark"),
    )


def watermark_state(log: DataFrame, grid: DataFrame) -> DataFrame:
    """Current watermark of every ``(tenant_id, table_name)`` in ``grid``.

    ``log`` is append-only.  The greatest entry counts, to the second; none, or one not
    after 1970, reads as the epoch."""
    keys = [TENANT, "table_name"]
    best = log.groupBy(*keys).agg(F.max("watermark").alias("_best"))
    stored = F.date_trunc("second", F.col("_best"))
    return grid.select(*keys).join(best, keys, "left").select(
        *keys,
        F.when(F.year(stored) > 1970, stored).otherwise(epoch()).alias("watermark"),
    )


def load_audit(counts: DataFrame) -> DataFrame:
    """Rows per tenant and table with subtotals per tenant and a grand total (``ALL``)."""
    return (
        counts.rollup(TENANT, "table_name")
        .agg(F.sum("rows").alias("rows"), F.grouping_id().alias("_level"))
        .select(
            F.when(F.col("_level") == 3, "ALL").otherwise(F.col(TENANT)).alias(TENANT),
            F.when(F.col("_level") > 0, "ALL").otherwise(F.col("table_name")).alias("table_name"),
            "rows",
        )
    )
