"""The quality operators applied to the star-schema warehouse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.operators.checks import gate_states, union_all
from storelake.plans import quality
from storelake.plans.warehouse import Warehouse
from storelake.sources.catalog import CATALOG
from storelake.sources.retail_star import TENANTS, RetailStar


def loyalty_tier_members(wh: Warehouse) -> DataFrame:
    """The tier dimension with the number of loyalty records in each tier."""
    members = wh["fact_loyalty_activity"].groupBy("tier_sk").agg(
        F.count(F.lit(1)).alias("members")
    )
    return (
        wh["dim_loyalty_tier"]
        .join(members, "tier_sk", "left")
        .withColumn("members", F.coalesce("members", F.lit(0).cast("long")))
    )


def dq_not_null(wh: Warehouse) -> DataFrame:
    return quality.run_checks(wh, quality.checked("not_null"))


def dq_unique(wh: Warehouse) -> DataFrame:
    return quality.run_checks(wh, quality.checked("unique"))


def dq_relationships(wh: Warehouse) -> DataFrame:
    return quality.run_checks(wh, quality.checked("relationships"))


def dq_accepted_values(wh: Warehouse) -> DataFrame:
    return quality.run_checks(wh, quality.checked("accepted_values"))


def dq_severity(wh: Warehouse) -> DataFrame:
    """Checks by severity and outcome: a failing warn-check is never a failure."""
    return (
        quality.run_checks(wh, quality.staging_checks() + quality.mart_checks())
        .groupBy("severity", "status")
        .agg(F.count(F.lit(1)).alias("checks"), F.sum("failures").alias("failures"))
    )


def _source_rows(star: RetailStar) -> dict[str, DataFrame]:
    """What the source systems report for all twelve tables: one row per order, every line
    sent, one promotion per urgent order, one row per key of the others."""
    tenant = F.concat(F.lit("tenant_0"), (F.col("o_orderkey") % 3 + 1).cast("string"))
    orders = star.star("orders").withColumn("tenant_id", tenant)
    movements = {
        "transactions": orders,
        "transaction_items": star["transaction_items"],
        "transaction_promotions": orders.filter(F.col("o_orderpriority") == "1-URGENT"),
    }
    keys = {n: star[n].select("tenant_id", spec.key).distinct() for n, spec in CATALOG.items() if n not in movements}
    return movements | keys


def dq_row_count_reconcile(wh: Warehouse) -> DataFrame:
    """Repeated lines collapse on landing (FAIL), second promotions appear (WARN)."""
    return quality.reconcile_landing(_source_rows(wh.raw), wh.raw, tenants=TENANTS)


def source_counts(wh: Warehouse) -> DataFrame:
    """Rows per tenant and table, tables without rows included."""
    return quality.on_grid(quality.source_counts(_source_rows(wh.raw)), TENANTS, list(CATALOG), "rows")


def dq_revenue_reconcile(wh: Warehouse) -> DataFrame:
    return quality.revenue_reconcile(wh)


# The models count as loaded at the newest change of a transaction and are checked so much later.
_CHECKED_AFTER_HOURS = 12


def _dated(wh: Warehouse) -> tuple[Warehouse, Column]:
    """The warehouse loaded at a moment the data gives, and the moment of the check."""
    newest = wh.raw["transactions"].agg(F.max("updated_at")).scalar()
    return Warehouse(wh.raw, loaded_at=newest), F.timestamp_add("HOUR", F.lit(_CHECKED_AFTER_HOURS), newest)


def dq_freshness(wh: Warehouse) -> DataFrame:
    dated, now = _dated(wh)
    return quality.sales_freshness(dated, now)


def dq_gate(wh: Warehouse) -> DataFrame:
    """State of every gate: landing counts, staging, marts, over newest rows that are sorted out once."""
    dated, now = _dated(wh)
    dated = quality.sorted_out(dated)
    counts = quality.reconcile_landing(_source_rows(wh.raw), wh.raw, tenants=TENANTS, newest=dated.newest)
    landing = counts.select(
        F.lit("raw").alias("layer"),
        F.col("table_name").alias("model"),
        F.col("tenant_id").alias("column"),
        F.lit("row_count").alias("check"),
        F.lit("error").alias("severity"),
        F.abs(F.col("source_rows") - F.col("landed_rows")).alias("failures"),
        F.when(F.col("status") == "FAIL", "fail")
        .when(F.col("status") == "WARN", "warn")
        .otherwise("pass")
        .alias("status"),
    )
    results = union_all(
        [landing, *[quality.layer_results(dated, layer, now) for layer in quality.GATES]]
    )
    return gate_states(results, ["raw", *quality.GATES])


AUDITS = {
    fn.__name__: fn
    for fn in (
        loyalty_tier_members,
        dq_not_null,
        dq_unique,
        dq_relationships,
        dq_accepted_values,
        dq_severity,
        dq_row_count_reconcile,
        source_counts,
        dq_revenue_reconcile,
        dq_freshness,
        dq_gate,
    )
}
