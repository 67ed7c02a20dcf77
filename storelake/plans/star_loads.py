"""The loading operators applied to the star-schema tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.operators import differences, extract, loads
from storelake.operators.checks import union_all
from storelake.operators.versions import latest_version
from storelake.plans.quality import on_grid, source_counts
from storelake.plans.refresh import PROMOTION_USES, REFRESHED, STOCK_LINES, Refresh
from storelake.plans.warehouse import Warehouse
from storelake.session import scratch_path
from storelake.sources.bases import Bases
from storelake.sources.catalog import CATALOG, TableSpec, columns_of, spec_of
from storelake.sources.changes import tenant_changes
from storelake.sources.landing import LandingZone
from storelake.sources.retail_star import TENANTS, RetailStar, star_schema
from storelake.streaming.changes import file_changes, ingest_available, streamed
from storelake.streaming.upserts import upsert_available

# The event types act as tenants of a change log keyed by user.
EVENT_TENANTS = ["click", "error", "purchase", "signup", "view"]
EVENT_SPEC = TableSpec(
    "events",
    "user_id",
    columns_of("user_id long, event_id long, ts timestamp, value double?, props string?"),
    version="ts",
    tie_break=("event_id",),
)
MOVEMENTS = ["transactions", "transaction_items", "transaction_promotions"]


def _events_of(star: RetailStar, tenant: str) -> DataFrame:
    mine = star.star("events").filter(F.col("event_type") == tenant)
    return mine.select(*EVENT_SPEC.column_names)


def tenant_union(star: RetailStar) -> DataFrame:
    return extract.tenant_union({t: _events_of(star, t) for t in EVENT_TENANTS})


def raw_typed(star: RetailStar) -> DataFrame:
    """Orders as their source delivers them (floats, narrow ids, extra columns), conformed."""
    delivered = star["transactions"].withColumns(
        {
            "total_amount": F.col("total_amount").cast("double"),
            "customer_id": F.col("customer_id").cast("int"),
            "store_id": F.col("store_id").cast("int"),
            "internal_note": F.lit("not in the catalog"),
        }
    )
    return extract.conformed(delivered, spec_of("transactions"))


def full_load(star: RetailStar) -> DataFrame:
    """Load all tenants, then reload tenant_02 (completed rows only) and tenant_03 (empty)."""
    zone = LandingZone(star.spark, scratch_path(star.spark, "full"), _only("transactions")).create()
    source = star["transactions"]
    at = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    loads.full_load(zone, {"transactions": source}, TENANTS, landed_at=at)
    reduced = source.filter((F.col("tenant_id") == "tenant_02") & (F.col("status") == "completed"))
    again = at + datetime.timedelta(hours=1)
    loads.full_load(zone, {"transactions": reduced}, ["tenant_02", "tenant_03"], landed_at=again)
    return zone["transactions"].select(
        "tenant_id", "transaction_id", "status", "total_amount", "updated_at"
    )


def full_load_catalog(star: RetailStar) -> DataFrame:
    """All twelve tables: streamed in, loaded in full, then tenant_02 again with its versions
    before 1998 and tenant_03 with none.  Rows and newest version per tenant and table."""
    zone = LandingZone(star.spark, scratch_path(star.spark, "catalog")).create()
    at = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    tables = {name: star[name] for name in CATALOG}
    zone.append_batch(tables["transactions"], "transactions", "pos", 0)
    loads.full_load(zone, tables, TENANTS, landed_at=at)
    old = (F.col("tenant_id") == "tenant_02") & (F.col("updated_at") < F.lit("1998-01-01").cast("timestamp"))
    again = {name: df.filter(old) for name, df in tables.items()}
    loads.full_load(zone, again, ["tenant_02", "tenant_03"], landed_at=at + datetime.timedelta(hours=1))
    return union_all(
        zone[name]
        .groupBy("tenant_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("updated_at").alias("newest"))
        .select("tenant_id", F.lit(name).alias("table_name"), "rows", "newest")
        for name in CATALOG
    )


def _only(*tables: str) -> dict[str, TableSpec]:
    return {name: CATALOG[name] for name in tables}


def incremental_extract(star: RetailStar) -> DataFrame:
    """Rows pulled and new watermark per tenant and table.  tenant_03 has no state yet and
    the lines of tenant_02 are already ahead of the data."""
    spark = star.spark
    states = {
        "transactions": [("tenant_01", "1998-01-01"), ("tenant_02", "2000-06-15")],
        "transaction_items": [("tenant_01", "1999-03-01"), ("tenant_02", "2030-01-01")],
    }
    parts = []
    for name, rows in states.items():
        state = spark.createDataFrame(rows, "tenant_id string, day string").select(
            "tenant_id", F.col("day").cast("timestamp").alias("watermark")
        )
        moved = extract.incremental_extract(star[name], state)
        parts.append(
            extract.advanced_watermarks(moved, state).withColumn("table_name", F.lit(name))
        )
    return union_all(parts)


def watermark_state(star: RetailStar) -> DataFrame:
    """One watermark entry per tenant, table and year; customers were never loaded."""
    log = union_all(
        star[name]
        .groupBy("tenant_id", F.trunc("updated_at", "year").alias("year"))
        .agg(F.max("updated_at").alias("watermark"))
        .select("tenant_id", F.lit(name).alias("table_name"), "watermark")
        for name in MOVEMENTS
    )
    # Sources stamp microseconds; the state keeps whole seconds.
    exact = F.timestamp_add("MICROSECOND", F.lit(750_000), F.col("watermark"))
    grid = star.spark.createDataFrame(
        [(t, n) for t in TENANTS for n in [*MOVEMENTS, "customers"]],
        "tenant_id string, table_name string",
    )
    return extract.watermark_state(log.withColumn("watermark", exact), grid)


def latest_events(star: RetailStar) -> DataFrame:
    events = star.star("events")
    return latest_version(events, ["event_type", "user_id"], "ts", ["event_id"])


def incremental_merge(star: RetailStar) -> DataFrame:
    """Three runs over the event log: half of it, the rest, and a repeat with a look-back."""
    spark = star.spark
    zone = LandingZone(spark, scratch_path(spark, "merge"), {"events": EVENT_SPEC}).create()
    half = F.lit("2024-01-15").cast("timestamp")

    def first_half(tenant: str, _: str) -> DataFrame:
        return _events_of(star, tenant).filter(F.col("ts") < half)

    def everything(tenant: str, _: str) -> DataFrame:
        return _events_of(star, tenant)

    for number, source in enumerate((first_half, everything, everything)):
        back = datetime.timedelta(days=3 if number == 2 else 0)
        loads.incremental_load(zone, source, EVENT_TENANTS, lookback=back)
    return zone.current("events").drop("_extracted_at")


def current_over_base(star: RetailStar) -> DataFrame:
    """Newest event per user from a bucketed base of the first half and what landed since; the
    clicks were loaded anew in between, so their base rows no longer count."""
    spark = star.spark
    zone = LandingZone(spark, scratch_path(spark, "based"), {"events": EVENT_SPEC}).create()
    half = F.lit("2024-01-15").cast("timestamp")
    events = tenant_union(star)
    zone.append(events.filter(F.col("ts") < half), "events")
    bases = Bases(zone)
    bases.build("events")
    at = datetime.datetime(2024, 2, 1, tzinfo=datetime.timezone.utc)
    zone.replace_tenants(events.filter((F.col("tenant_id") == "click") & (F.col("ts") < half)), "events", ["click"], at)
    zone.append(events.filter(F.col("ts") >= half), "events")
    return bases.current("events").drop("_extracted_at")


def incremental_partial(star: RetailStar) -> DataFrame:
    """Per-table commits: the lines of tenant_02 cannot be read, so its later tables wait."""
    spark = star.spark
    zone = LandingZone(spark, scratch_path(spark, "partial"), _only(*MOVEMENTS)).create()

    def source(tenant: str, name: str) -> DataFrame:
        if (tenant, name) == ("tenant_02", "transaction_items"):
            raise ConnectionError("source unreachable")
        return star[name].filter(F.col("tenant_id") == tenant).drop("tenant_id")

    loads.incremental_load(zone, source, TENANTS, MOVEMENTS, commit="table", raise_failures=False)
    landed = source_counts({name: zone[name] for name in MOVEMENTS})
    return (
        zone.watermarks(TENANTS, MOVEMENTS)
        .join(landed, ["tenant_id", "table_name"], "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))
    )


def row_differences(star: RetailStar) -> DataFrame:
    """Lines whose landed copy differs from the source: lines of a few keys are lost, changed or
    landed under another key."""
    spec = spec_of("transaction_items")
    source = star["transaction_items"].select("tenant_id", *spec.column_names)
    key = F.col(spec.key)
    landed = (
        source.where(key % 4999 != 17)
        .withColumn("quantity", F.when(key % 5003 == 29, F.col("quantity") + 1).otherwise(F.col("quantity")))
        .withColumn(spec.key, F.when(key % 5009 == 31, -key).otherwise(key))
    )
    return differences.row_differences(source, landed, spec.key, spec.column_names)


def _refreshed(name: str):
    """A fact stored as of 1998 and refreshed with all versions since then."""

    def query(star: RetailStar) -> DataFrame:
        cut = F.lit("1998-01-01").cast("timestamp")
        before = Warehouse({t: df.filter(F.col("updated_at") < cut) for t, df in star.items()})
        lines = "fact_sales" if name == "fact_sales" else "int_sales_enriched"
        # Of facts that are not refreshed themselves, only what a refresh reads is stored.
        uses = before["fact_promotion_usage"].select(*PROMOTION_USES, "dbt_loaded_at")
        if name == "fact_inventory_movement":
            before.over({lines: before[lines].select(*STOCK_LINES, "dbt_loaded_at")})
        before.over({"fact_promotion_usage": uses})
        before.materialize(scratch_path(star.spark, "before"), names={lines, "fact_promotion_usage", name})
        changes = {t: df.filter(F.col("updated_at") >= cut) for t, df in star.items()}
        work = Refresh(before, star, changes, lines, read_once=name == lines)
        return getattr(work, name)().drop("dbt_loaded_at")

    query.__name__ = f"refresh_{name}"
    return query


def load_audit(star: RetailStar) -> DataFrame:
    """Rows per tenant and table of all twelve tables, with totals."""
    return extract.load_audit(on_grid(source_counts(star), TENANTS, list(CATALOG), "rows"))


def _event_stream(star: RetailStar, purpose: str) -> DataFrame:
    spark = star.spark
    schema = star_schema("events")
    zone = LandingZone(spark, scratch_path(spark, purpose), {"events": EVENT_SPEC}).create()
    checkpoint = scratch_path(spark, f"{purpose}-state")
    # A glob, so that one file and a folder of part files are both accepted.
    changes = file_changes(spark, f"{star.folder}/events.parquet*", schema)
    for _ in range(2):  # the second run finds nothing new
        ingest_available(changes.withColumnRenamed("event_type", "tenant_id"), zone, "events", checkpoint)
    landed = streamed(zone, "events").withColumnRenamed("tenant_id", "event_type")
    return landed.select(*schema.names)


def stream_incremental_load(star: RetailStar) -> DataFrame:
    return _event_stream(star, "stream")


def stream_latest_version(star: RetailStar) -> DataFrame:
    landed = _event_stream(star, "stream-latest")
    return latest_version(landed, ["event_type", "user_id"], "ts", ["event_id"])


def stream_keyed_upsert(star: RetailStar) -> DataFrame:
    """Newest event per user through keyed state: the later half of the log comes first, the older
    half by the same checkpoint after it, where it only adds users the later half lacks."""
    spark = star.spark
    events = tenant_union(star)
    half = F.lit("2024-01-15").cast("timestamp")
    zone = LandingZone(spark, scratch_path(spark, "upsert"), {"events": EVENT_SPEC}).create()
    arrived, checkpoint = scratch_path(spark, "upsert-arrived"), scratch_path(spark, "upsert-state")
    for part in (events.filter(F.col("ts") >= half), events.filter(F.col("ts") < half)):
        part.write.mode("append").parquet(arrived)
        upsert_available(file_changes(spark, arrived, events.schema), zone, "events", checkpoint)
    return zone.current("events").drop("_extracted_at")


def stream_tenant_changes(star: RetailStar) -> DataFrame:
    """Newest event per user through the source whose offsets are watermarks: half of the log is
    exported and streamed, then the rest, from the same checkpoint."""
    spark = star.spark
    events = tenant_union(star)
    half = F.lit("2024-01-15").cast("timestamp")
    zone = LandingZone(spark, scratch_path(spark, "changes"), {"events": EVENT_SPEC}).create()
    exported, checkpoint = scratch_path(spark, "exported"), scratch_path(spark, "changes-state")
    for part in (events.filter(F.col("ts") < half), events.filter(F.col("ts") >= half)):
        part.write.mode("append").partitionBy("tenant_id").parquet(exported)
        ingest_available(tenant_changes(spark, exported, EVENT_SPEC), zone, "events", checkpoint)
    return zone.current("events").drop("_extracted_at")


STAR_LOADS = {
    fn.__name__: fn
    for fn in (
        tenant_union,
        raw_typed,
        full_load,
        full_load_catalog,
        incremental_extract,
        watermark_state,
        incremental_merge,
        current_over_base,
        incremental_partial,
        load_audit,
        row_differences,
        stream_incremental_load,
        stream_latest_version,
        stream_keyed_upsert,
        stream_tenant_changes,
        *map(_refreshed, REFRESHED),
    )
} | {"latest_version": latest_events}
