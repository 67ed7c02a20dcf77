"""Business rules that fill derived source columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions import as_double
from storelake.operators.versions import current_rows
from storelake.plans.marts import LOYALTY_TIERS
from storelake.plans.warehouse import Warehouse
from storelake.sources.catalog import spec_of


def subtotal_of(quantity: Column, price: Column, discount_pct: Column) -> Column:
    """Line amount after discount, in exact decimal arithmetic, two digits."""
    kept = (F.lit(100).cast("decimal(5,2)") - discount_pct.cast("decimal(5,2)")) * F.lit(
        "0.01"
    ).cast("decimal(3,2)")
    return F.round(quantity.cast("decimal(10,0)") * price * kept, 2).cast("decimal(18,2)")


def line_subtotal(wh: Warehouse) -> DataFrame:
    amount = subtotal_of(F.col("quantity"), F.col("unit_price"), F.col("discount"))
    return wh["stg_transaction_items"].select("item_sk", amount.alias("subtotal"))


def header_total_rollup(wh: Warehouse) -> DataFrame:
    """Total of each transaction, whatever its status, from its lines (0 without lines)."""
    key = ["transaction_id", "tenant_id"]
    sums = wh["stg_transaction_items"].groupBy(*key).agg(F.sum("subtotal").alias("total"))
    headers = current_rows(wh.raw["transactions"], spec_of("transactions")).select(*key, "status")
    total = F.coalesce("total", F.lit("0").cast("decimal(28,2)"))
    return headers.join(sums, key, "left").select(*key, "status", total.alias("total_amount"))


def tier_for(spend: Column) -> Column:
    """The highest tier whose minimum the spend reaches."""
    tier: Column | None = None
    for name, _, minimum in sorted(LOYALTY_TIERS, key=lambda t: -t[1]):
        reached = spend >= F.lit(minimum).cast("decimal(18,2)")
        tier = F.when(reached, name) if tier is None else tier.when(reached, name)
    return tier.otherwise(LOYALTY_TIERS[0][0])


def loyalty_tier_assignment(wh: Warehouse) -> DataFrame:
    """Tier and points of every customer from completed spend; no spend means bronze."""
    spend = (
        wh["fact_sales"].groupBy("customer_sk").agg(F.sum("net_amount").alias("spend"))
    )
    amount = F.coalesce("spend", F.lit("0").cast("decimal(28,2)"))
    return (
        wh["stg_customers"]
        .select("customer_sk", "tenant_id", "customer_id")
        .join(spend, "customer_sk", "left")
        .select(
            "customer_sk",
            "tenant_id",
            "customer_id",
            tier_for(amount).alias("tier"),
            F.floor(as_double(amount) / 1000).cast("long").alias("points"),
            amount.alias("total_spend"),
        )
    )


def units_sold(wh: Warehouse) -> DataFrame:
    """Units per store and product over completed transactions."""
    return (
        wh["fact_sales"]
        .groupBy("tenant_id", "store_sk", "product_sk")
        .agg(F.sum("quantity").alias("units"))
    )


RULES = {
    fn.__name__: fn
    for fn in (line_subtotal, header_total_rollup, loyalty_tier_assignment, units_sold)
}
