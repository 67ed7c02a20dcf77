"""Intermediate tables, conformed dimensions and facts.

Lines are the largest table, so a model moves them once: everything known per
transaction is gathered on the header first, everything known per product in one lookup.
Lines and headers move with their ids; the texts of their surrogate keys are made after the last join.
No side is broadcast by hint; Spark decides that from the measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.functions import as_double, date_key, half_up, iso_weekday, surrogate_key, with_audit, year_month
from storelake.operators.joins import attach
from storelake.plans.warehouse import Warehouse, model

_ZERO = "0.00"


def _zero() -> Column:
    return F.lit(_ZERO).cast("decimal(18,2)")


@model("intermediate")
def int_primary_cost(wh: Warehouse) -> DataFrame:
    """Primary supplier and its cost per product, both from the same (newest) link."""
    newest = F.max_by(
        F.struct("supplier_sk", "cost_price"), F.struct("updated_at", "product_supplier_id")
    )
    return (
        wh["stg_product_supplier"]
        .filter("is_primary and product_id is not null")
        .groupBy("product_id", "tenant_id")
        .agg(newest.alias("pick"), F.first("product_sk").alias("product_sk"))
        .select(
            "product_sk",
            "tenant_id",
            "product_id",
            F.col("pick.supplier_sk").alias("primary_supplier_sk"),
            F.col("pick.cost_price").alias("cost_price"),
        )
    )


def _lines(wh: Warehouse) -> DataFrame:
    return wh["stg_transaction_items"].drop("created_at", "updated_at", "item_sk", "transaction_sk", "product_sk")


def _headers(wh: Warehouse) -> DataFrame:
    keys = [f"{entity}_sk" for entity in ("transaction", "customer", "store", "employee")]
    return wh["stg_transactions"].drop("created_at", "updated_at", "date_key", *keys)


def _key(entity: str, name: str | None = None) -> Column:
    return surrogate_key("tenant_id", f"{entity}_id").alias(name or f"{entity}_sk")


def _product_lookup(wh: Warehouse) -> DataFrame:
    """Name, category, primary supplier and cost per product, known to either source.

    Union and grouping instead of a full join: one shuffle, and the key is visibly unique.
    """
    named = wh["stg_products"].select(
        "product_id", "tenant_id", "product_name", "category"
    )
    costed = wh["int_primary_cost"].select(
        "product_id",
        "tenant_id",
        "primary_supplier_sk",
        F.col("cost_price").alias("known_cost"),
    )
    facts = ["product_name", "category", "primary_supplier_sk", "known_cost"]
    return (
        named.unionByName(costed, allowMissingColumns=True)
        .groupBy("product_id", "tenant_id")
        .agg(*[F.max(c).alias(c) for c in facts])
    )


@model("intermediate")
def int_sales_enriched(wh: Warehouse) -> DataFrame:
    """One row per line of a completed transaction with product, store, clerk and cost."""
    stores = wh["stg_stores"].select(
        "store_id", "tenant_id", F.col("city").alias("store_city")
    )
    clerks = wh["stg_employees"].select(
        "employee_id",
        "tenant_id",
        "employee_name",
        F.col("role").alias("employee_role"),
    )
    headers = attach(attach(_headers(wh), stores, "store"), clerks, "employee")
    sold = attach(_lines(wh), headers, "transaction", "inner")
    unit_cost = F.coalesce("known_cost", _zero())
    rows = attach(sold, _product_lookup(wh), "product").select(
        _key("item", "sales_sk"),
        "tenant_id",
        _key("transaction"),
        "transaction_id",
        date_key("transaction_date").alias("date_key"),
        "transaction_date",
        _key("customer"),
        _key("store"),
        "store_city",
        _key("employee"),
        "employee_name",
        "employee_role",
        _key("product"),
        "product_name",
        "category",
        "primary_supplier_sk",
        "quantity",
        "unit_price",
        F.col("subtotal").alias("net_amount"),
        (F.col("quantity") * F.col("unit_price")).alias("gross_amount"),
        unit_cost.alias("cost_price"),
        (F.col("quantity") * unit_cost).alias("cost_amount"),
        (F.col("subtotal") - F.col("quantity") * unit_cost).alias("margin_amount"),
    )
    return with_audit(rows, wh.loaded_at)


def _dimension(wh: Warehouse, source: str, *columns: str | Column) -> DataFrame:
    return with_audit(wh[source].select(*columns), wh.loaded_at)


@model("marts")
def dim_customer(wh: Warehouse) -> DataFrame:
    return _dimension(
        wh,
        "stg_customers",
        "customer_sk",
        "tenant_id",
        "customer_id",
        "customer_name",
        "phone",
        "email",
        "gender",
        "city",
        F.col("created_at").alias("customer_since"),
    )


@model("marts")
def dim_product(wh: Warehouse) -> DataFrame:
    return _dimension(
        wh,
        "stg_products",
        "product_sk",
        "tenant_id",
        "product_id",
        "product_name",
        "category",
        "brand",
        "unit_price",
        "is_active",
    )


@model("marts")
def dim_store(wh: Warehouse) -> DataFrame:
    return _dimension(
        wh,
        "stg_stores",
        "store_sk",
        "tenant_id",
        "store_id",
        "store_name",
        "city",
        "province",
        "store_type",
        "opened_at",
        "is_active",
    )


@model("marts")
def dim_promotion(wh: Warehouse) -> DataFrame:
    return _dimension(
        wh,
        "stg_promotions",
        "promo_sk",
        "tenant_id",
        "promo_id",
        "promo_name",
        "promo_type",
        "discount_pct",
        "start_date",
        "end_date",
        "min_purchase",
    )


@model("marts")
def dim_employee(wh: Warehouse) -> DataFrame:
    return _dimension(
        wh,
        "stg_employees",
        "employee_sk",
        "tenant_id",
        "employee_id",
        "store_sk",
        "store_id",
        "employee_name",
        "role",
        "hire_date",
        "is_active",
    )


@model("marts")
def dim_supplier(wh: Warehouse) -> DataFrame:
    return _dimension(
        wh,
        "stg_suppliers",
        "supplier_sk",
        "tenant_id",
        "supplier_id",
        "supplier_name",
        "contact_name",
        "city",
        "country",
    )


@model("marts")
def dim_date(wh: Warehouse) -> DataFrame:
    """One row per day between the first and last completed transaction, gaps included.

    No completed transaction: no row."""
    span = wh["stg_transactions"].agg(
        F.to_date(F.min("transaction_date")).alias("first_day"),
        F.to_date(F.max("transaction_date")).alias("last_day"),
    )
    days = span.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date_day")
    )
    weekday = iso_weekday("date_day")
    rows = days.select(
        date_key("date_day").alias("date_key"),
        "date_day",
        F.year("date_day").alias("year"),
        F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"),
        year_month("date_day").alias("year_month"),
        F.date_format("date_day", "MMM").alias("month_name"),
        F.dayofmonth("date_day").alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format("date_day", "E").alias("day_name"),
        F.when(weekday >= 6, 1).otherwise(0).alias("is_weekend"),
    )
    return with_audit(rows, wh.loaded_at)


# The loyalty tiers, their rank and the spend that reaches them.
LOYALTY_TIERS = [
    ("bronze", 1, "0"),
    ("silver", 2, "500000"),
    ("gold", 3, "1500000"),
    ("platinum", 4, "3000000"),
]


@model("marts")
def dim_loyalty_tier(wh: Warehouse) -> DataFrame:
    spark = SparkSession.active()
    values = ", ".join(
        f"('{tier}', '{tier}', {rank}, CAST({spend} AS DECIMAL(18,2)))"
        for tier, rank, spend in LOYALTY_TIERS
    )
    rows = spark.sql(f"SELECT * FROM VALUES {values} AS t(tier_sk, tier, tier_rank, min_spend)")
    return with_audit(rows, wh.loaded_at)


@model("marts")
def fact_sales(wh: Warehouse) -> DataFrame:
    """One row per line of a completed transaction.

    ``txn_promo_discount`` belongs to the whole transaction and repeats on its lines:
    never sum it over lines."""
    promos = (
        wh["stg_transaction_promotions"]
        .groupBy("transaction_id", "tenant_id")
        .agg(
            F.sum("discount_applied").alias("promo_discount_total"),
            F.count(F.lit(1)).alias("promo_count"),
        )
    )
    # Both sides have one row per transaction and the same partitioning: no exchange here.
    headers = _headers(wh).join(promos, ["transaction_id", "tenant_id"], "left")
    rows = attach(_lines(wh), headers, "transaction", "inner").select(
        _key("item", "sales_sk"),
        "tenant_id",
        _key("transaction"),
        "transaction_id",
        date_key("transaction_date").alias("date_key"),
        "transaction_date",
        _key("customer"),
        _key("store"),
        _key("employee"),
        _key("product"),
        "product_id",
        "quantity",
        "unit_price",
        F.col("discount").alias("line_discount_pct"),
        (F.col("quantity") * F.col("unit_price")).alias("gross_amount"),
        F.col("subtotal").alias("net_amount"),
        "payment_method",
        F.coalesce("promo_discount_total", _zero()).alias("txn_promo_discount"),
        F.when(F.col("promo_count") > 0, 1).otherwise(0).alias("is_promo_transaction"),
    )
    return with_audit(rows, wh.loaded_at)


@model("marts")
def fact_promotion_usage(wh: Warehouse) -> DataFrame:
    """One row per promotion used on a completed transaction."""
    uses = wh["stg_transaction_promotions"].drop("transaction_sk")
    headers = wh["stg_transactions"].select(
        "transaction_id",
        "tenant_id",
        "store_sk",
        "customer_sk",
        "date_key",
        "transaction_date",
        F.col("total_amount").alias("transaction_amount"),
    )
    rows = attach(uses, headers, "transaction", "inner").select(
        "txn_promo_sk",
        "tenant_id",
        _key("transaction"),
        "transaction_id",
        "promo_sk",
        "store_sk",
        "customer_sk",
        "date_key",
        "transaction_date",
        "discount_applied",
        "transaction_amount",
    )
    return with_audit(rows, wh.loaded_at)


@model("marts")
def fact_inventory_movement(wh: Warehouse) -> DataFrame:
    """Stock position per store and product, with the units that left it.

    Sales collapse to one row per store and product before they meet the stock table.
    They are grouped by fewer keys than the join has, for the reason ``attach`` gives.
    """
    sold = (
        wh["int_sales_enriched"]
        .groupBy("product_sk", "store_sk")
        .agg(F.sum("quantity").alias("units"), F.max("tenant_id").alias("tenant_id"))
    )
    units = F.coalesce("units", F.lit(0).cast("long"))
    stock = F.col("stock_qty")
    turnover = half_up(as_double(units) / as_double(stock), 4)
    rows = (
        wh["stg_inventory"]
        .join(sold, ["product_sk", "store_sk", "tenant_id"], "left")
        .select(
            "inventory_sk",
            "tenant_id",
            "store_sk",
            "product_sk",
            "supplier_sk",
            "stock_qty",
            "reorder_level",
            units.alias("qty_sold"),
            F.when(stock > 0, turnover).otherwise(0.0).alias("turnover_rate"),
            F.when(stock <= F.col("reorder_level"), 1).otherwise(0).alias("below_reorder"),
            "last_restocked",
        )
    )
    return with_audit(rows, wh.loaded_at)


@model("marts")
def fact_loyalty_activity(wh: Warehouse) -> DataFrame:
    """One row per loyalty record (a snapshot)."""
    return _dimension(
        wh,
        "stg_customer_loyalty",
        "loyalty_sk",
        "tenant_id",
        "customer_sk",
        "customer_id",
        F.col("tier").alias("tier_sk"),
        "tier",
        "points",
        F.col("total_spend").alias("recorded_total_spend"),
        "member_since",
    )
