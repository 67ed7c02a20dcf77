"""The analytic questions.

Facts are first collapsed to the grain of their own surrogate keys and only then meet
a dimension: the map-side combine removes hot keys before anything is shuffled, and
no fact row is ever shuffled for a dimension join.  Orders end with enough columns to
be total, so top-k results do not depend on the run.

``tenant`` restricts a question to one tenant (default: all); the filter reaches the
scans, because every step below keeps the tenant as a grouping or join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.functions import (
    as_double,
    date_key,
    half_up,
    ratio,
    year_quarter,
)
from storelake.functions.calendar import month_number
from storelake.operators.quantiles import approx_quantiles, exact_quantiles
from storelake.plans.warehouse import Warehouse
from storelake.session import written


def _scoped(df: DataFrame, tenant: str | None) -> DataFrame:
    return df if tenant is None else df.filter(F.col("tenant_id") == tenant)


def _money(value: Column | str) -> Column:
    """A sum of two-digit amounts is exact; only the type changes."""
    return as_double(value)


def _top_per_group(df: DataFrame, group: str, k: int, *order: Column) -> DataFrame:
    """Rows ranked 1..k inside each group (column ``rn``)."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rn", rank).filter(F.col("rn") <= k)


def _days(wh: Warehouse, *columns: str) -> DataFrame:
    return wh["dim_date"].select("date_key", *columns)


# -- one tenant's overview ---------------------------------------------------


def top_products_per_category(
    wh: Warehouse, tenant: str | None = "tenant_01", k: int = 5
) -> DataFrame:
    """Best sellers by units inside each category; equal names are one product."""
    units = (
        _scoped(wh["fact_sales"], tenant).groupBy("product_sk").agg(F.sum("quantity").alias("qty"))
    )
    names = wh["dim_product"].select("product_sk", "category", "product_name")
    merged = (
        units.join(names, "product_sk").groupBy("category", "product_name").agg(F.sum("qty").alias("qty"))
    )
    best = _top_per_group(merged, "category", k, F.desc("qty"), F.asc("product_name"))
    return best.select("category", "product_name", "qty").orderBy(
        F.asc_nulls_last("category"), F.desc("qty"), "product_name"
    )


def monthly_revenue(wh: Warehouse, tenant: str | None = "tenant_01") -> DataFrame:
    daily = (
        _scoped(wh["fact_sales"], tenant).groupBy("date_key").agg(F.sum("net_amount").alias("net"))
    )
    return (
        daily.join(_days(wh, "year_month"), "date_key")
        .groupBy("year_month")
        .agg(_money(F.sum("net")).alias("revenue"))
        .orderBy("year_month")
    )


def payment_mix(wh: Warehouse, tenant: str | None = "tenant_01") -> DataFrame:
    """Transactions per payment method and their share of all, in percent."""
    mix = (
        _scoped(wh["fact_sales"], tenant)
        .groupBy("payment_method")
        .agg(F.count_distinct("transaction_sk").alias("transactions"))
    )
    total = mix.agg(F.sum("transactions")).scalar()
    share = half_up(ratio(F.col("transactions"), total) * 100, 1)
    return mix.select("payment_method", "transactions", share.alias("pct")).orderBy(
        F.desc("transactions"), "payment_method"
    )


# -- stores, promotions, customers -------------------------------------------


def revenue_by_store(
    wh: Warehouse, tenant: str | None = None, months: int = 6
) -> DataFrame:
    """Revenue per store and month since the same day ``months`` months before the last day."""
    days = wh["dim_date"]
    since = days.agg(F.add_months(F.max("date_day"), -months)).scalar()
    # date_key grows with the day, so the cut-off also holds on the fact itself and
    # can skip its row groups.
    recent = _scoped(wh["fact_sales"], tenant).filter(F.col("date_key") >= date_key(since))
    daily = recent.groupBy("store_sk", "date_key").agg(F.sum("net_amount").alias("net"))
    window = days.filter(F.col("date_day") >= since).select("date_key", "year_month")
    stores = wh["dim_store"].select("store_sk", "store_name", "city")
    return (
        daily.join(window, "date_key")
        .groupBy("store_sk", "year_month")
        .agg(F.sum("net").alias("net"))
        .join(stores, "store_sk")
        .groupBy("store_name", "city", "year_month")
        .agg(_money(F.sum("net")).alias("revenue"))
        .orderBy("year_month", "store_name", "city")
    )


def promotion_effectiveness(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    """Discount, transactions and mean transaction value per promotion.

    The mean is over usage rows: a transaction that used a promotion twice counts twice."""
    used = _scoped(wh["fact_promotion_usage"], tenant)
    # Usage rows of one transaction collapse first: the exact distinct count then needs
    # no second shuffle of the fact.
    per_use = used.groupBy("promo_sk", "transaction_sk").agg(
        F.sum("discount_applied").alias("discount"),
        F.sum("transaction_amount").alias("amount"),
        F.count("transaction_amount").alias("amounts"),
    )
    per_promo = per_use.groupBy("promo_sk").agg(
        F.sum("discount").alias("discount"),
        F.count("transaction_sk").alias("transactions"),
        F.sum("amount").alias("amount"),
        F.sum("amounts").alias("amounts"),
    )
    promos = wh["dim_promotion"].select("promo_sk", "promo_name", "promo_type")
    return (
        per_promo.join(promos, "promo_sk")
        .select(
            "promo_name",
            "promo_type",
            _money("discount").alias("total_discount"),
            "transactions",
            half_up(ratio(F.col("amount"), F.col("amounts")), 2).alias("avg_txn_value"),
        )
        .orderBy(F.desc_nulls_last("total_discount"), "promo_name", "promo_type", "avg_txn_value")
    )


def promo_avg_comparison(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    """Mean value and number of transactions with and without a promotion."""
    baskets = (
        _scoped(wh["fact_sales"], tenant)
        .groupBy("transaction_id", "tenant_id")
        .agg(
            F.max("is_promo_transaction").alias("promo"),
            F.sum("net_amount").alias("amount"),
        )
    )
    bucket = F.when(F.col("promo") == 1, "with_promo").otherwise("without_promo")
    return (
        baskets.groupBy(bucket.alias("bucket"))
        .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("transactions"))
        .select(
            "bucket",
            half_up(ratio(F.col("amount"), F.col("transactions")), 2).alias("avg_transaction_value"),
            "transactions",
        )
    )


def ranked_products_by_city(wh: Warehouse, tenant: str | None = None, k: int = 3) -> DataFrame:
    per_pair = (
        _scoped(wh["fact_sales"], tenant)
        .groupBy("store_sk", "product_sk")
        .agg(F.sum("net_amount").alias("net"))
    )
    stores = wh["dim_store"].select("store_sk", "city")
    products = wh["dim_product"].select("product_sk", "product_name")
    merged = (
        per_pair.join(stores, "store_sk")
        .groupBy("city", "product_sk")
        .agg(F.sum("net").alias("net"))
        .join(products, "product_sk")
        .groupBy("city", "product_name")
        .agg(F.sum("net").alias("net"))
    )
    return _top_per_group(merged, "city", k, F.desc("net"), F.asc("product_name")).select(
        "city", "product_name", _money("net").alias("revenue"), "rn"
    )


def top_products_by_city(wh: Warehouse, tenant: str | None = None, k: int = 3) -> DataFrame:
    """The ``k`` products with most revenue in each store city."""
    return (
        ranked_products_by_city(wh, tenant, k)
        .drop("rn")
        .orderBy(F.asc_nulls_last("city"), F.desc("revenue"), "product_name")
    )


def customer_segments(
    wh: Warehouse,
    tenant: str | None = None,
    low: float = 0.33,
    high: float = 0.66,
    exact: bool = True,
) -> DataFrame:
    """High / Medium / Low spenders per city; the two cut-offs are over all customers."""
    spend = (
        _scoped(wh["fact_sales"], tenant)
        .groupBy("customer_sk")
        .agg(F.sum("net_amount").alias("spend"))
    )
    homes = wh["dim_customer"].select("customer_sk", "city")
    # One row per customer is stored, because the cut-offs and the counts both read it.
    customers = written(
        spend.join(homes, "customer_sk").select("customer_sk", "city", "spend"), "spend"
    )
    quantiles = exact_quantiles if exact else approx_quantiles
    low_cut, high_cut = quantiles(customers, "spend", [low, high])
    amount = as_double("spend")
    segment = (
        F.when(amount >= F.lit(high_cut), "High")
        .when(amount >= F.lit(low_cut), "Medium")
        .otherwise("Low")
    )
    return (
        customers.groupBy("city", segment.alias("segment"))
        .agg(F.count(F.lit(1)).alias("customers"), _money(F.sum("spend")).alias("total_spend"))
        .orderBy(F.asc_nulls_last("city"), "segment")
    )


def transactions_by_day(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    """Transactions and revenue by weekday.  A transaction has one date, so distinct
    counts of single dates add up."""
    daily = (
        _scoped(wh["fact_sales"], tenant)
        .groupBy("transaction_id", "tenant_id", "date_key")
        .agg(F.sum("net_amount").alias("net"))
        .groupBy("date_key")
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum("net").alias("net"))
    )
    return (
        daily.join(_days(wh, "day_of_week", "day_name"), "date_key")
        .groupBy("day_of_week", "day_name")
        .agg(F.sum("transactions").alias("transactions"), _money(F.sum("net")).alias("revenue"))
        .orderBy("day_of_week")
    )


# -- margin, value, turnover, staff, suppliers, retention ---------------------


def revenue_margin(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    """Revenue, margin and margin percentage per category and quarter."""
    daily = (
        _scoped(wh["int_sales_enriched"], tenant)
        .filter(F.col("category") != "")
        .groupBy("category", "date_key")
        .agg(F.sum("net_amount").alias("net"), F.sum("margin_amount").alias("margin"))
    )
    quarter = year_quarter("year", "quarter")
    return (
        daily.join(_days(wh, "year", "quarter"), "date_key")
        .groupBy("category", quarter.alias("quarter"))
        .agg(F.sum("net").alias("net"), F.sum("margin").alias("margin"))
        .select(
            "category",
            "quarter",
            _money("net").alias("revenue"),
            _money("margin").alias("margin"),
            half_up(ratio(F.col("margin"), F.col("net")) * 100, 1).alias("margin_pct"),
        )
        .orderBy("quarter", F.desc("revenue"), "category")
    )


def customer_ltv(wh: Warehouse, tenant: str | None = None, k: int = 20) -> DataFrame:
    """The ``k`` customers with the highest lifetime spend and their current tier."""
    spend = (
        _scoped(wh["fact_sales"], tenant)
        .groupBy("transaction_id", "tenant_id", "customer_sk")
        .agg(F.sum("net_amount").alias("net"))
        .groupBy("customer_sk")
        .agg(F.sum("net").alias("net"), F.count(F.lit(1)).alias("transactions"))
    )
    # One tier per customer (the newest card), so the join cannot multiply spend.
    tiers = wh["fact_loyalty_activity"].groupBy("customer_sk").agg(
        F.max_by("tier", F.struct("member_since", "loyalty_sk")).alias("tier")
    )
    homes = wh["dim_customer"].select("customer_sk", "customer_name", "city")
    # Ranking needs a customer row but not its tier: cut to k rows before that join.
    best = spend.join(homes, "customer_sk").orderBy(F.desc("net"), "customer_sk").limit(k)
    return (
        best.join(tiers, "customer_sk", "left")
        .orderBy(F.desc("net"), "customer_sk")
        .select(
            "customer_name",
            "city",
            F.coalesce("tier", F.lit("none")).alias("tier"),
            _money("net").alias("lifetime_value"),
            "transactions",
        )
    )


def inventory_turnover(wh: Warehouse, tenant: str | None = None, k: int = 20) -> DataFrame:
    """The ``k`` slowest store / product pairs that still hold stock."""
    stock = _scoped(wh["fact_inventory_movement"], tenant).filter(F.col("stock_qty") > 0)
    stores = wh["dim_store"].select("store_sk", "store_name")
    products = wh["dim_product"].select("product_sk", "product_name")
    return (
        stock.join(stores, "store_sk")
        .join(products, "product_sk")
        .select(
            "store_name",
            "product_name",
            "stock_qty",
            "qty_sold",
            half_up(F.col("turnover_rate"), 3).alias("turnover_rate"),
            "inventory_sk",
        )
        .orderBy(F.asc_nulls_last("turnover_rate"), "inventory_sk")
        .limit(k)
        .drop("inventory_sk")
    )


def employee_performance(wh: Warehouse, tenant: str | None = None, k: int = 15) -> DataFrame:
    """The ``k`` best staff by mean transaction value.  People are told apart by name,
    role and store city only; all roles take part."""
    group = ["employee_name", "employee_role", "store_city"]
    totals = (
        _scoped(wh["int_sales_enriched"], tenant)
        .filter(F.col("employee_name") != "")
        .groupBy("transaction_id", "tenant_id", *group)
        .agg(F.sum("net_amount").alias("net"), F.sum("margin_amount").alias("margin"))
        .groupBy(*group)
        .agg(
            F.sum("net").alias("net"),
            F.sum("margin").alias("margin"),
            F.count(F.lit(1)).alias("transactions"),
        )
    )
    return (
        totals.select(
            "employee_name",
            F.col("employee_role").alias("role"),
            "store_city",
            _money("net").alias("revenue"),
            _money("margin").alias("margin"),
            "transactions",
            half_up(ratio(F.col("net"), F.col("transactions")), 2).alias("avg_txn_value"),
        )
        .orderBy(F.desc_nulls_last("avg_txn_value"), "employee_name", "role", "store_city")
        .limit(k)
    )


def promotion_roi(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    """Revenue above the non-promoted mean, per unit of discount, for each promotion."""
    pairs = (
        _scoped(wh["fact_promotion_usage"], tenant)
        .groupBy("promo_sk", "transaction_sk")
        .agg(
            F.max("transaction_amount").alias("amount"),
            F.sum("discount_applied").alias("discount"),
        )
    )
    per_promo = pairs.groupBy("promo_sk").agg(
        F.sum("amount").alias("amount"),
        F.sum("discount").alias("discount"),
        F.count(F.lit(1)).alias("promo_txns"),
    )
    plain = (
        _scoped(wh["fact_sales"], tenant)
        .filter(F.col("is_promo_transaction") == 0)
        .groupBy("transaction_id", "tenant_id")
        .agg(F.sum("net_amount").alias("amount"))
        .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
        .select(ratio(F.col("amount"), F.col("n")))
        .scalar()
    )
    promos = wh["dim_promotion"].select("promo_sk", "promo_name", "promo_type")
    lift = (ratio(F.col("amount"), F.col("promo_txns")) - F.col("plain")) * F.col("promo_txns")
    return (
        per_promo.join(promos, "promo_sk")
        .withColumn("plain", plain)
        .select(
            "promo_name",
            "promo_type",
            _money("amount").alias("promo_revenue"),
            _money("discount").alias("total_discount"),
            "promo_txns",
            half_up(lift, 2).alias("incremental_revenue"),
            half_up(ratio(lift, F.col("discount")), 2).alias("roi"),
            "promo_sk",
        )
        .orderBy(F.desc_nulls_last("roi"), "promo_sk")
        .drop("promo_sk")
    )


def supplier_dependency(wh: Warehouse, tenant: str | None = None, k: int = 20) -> DataFrame:
    """Of the ``k`` products with most revenue: from how many suppliers can each come?"""
    best = (
        _scoped(wh["fact_sales"], tenant)
        .groupBy("product_sk")
        .agg(F.sum("net_amount").alias("net"), F.sum("quantity").alias("qty_sold"))
        .orderBy(F.desc("net"), F.asc_nulls_last("product_sk"))
        .limit(k)
    )
    products = wh["dim_product"].select("product_sk", "product_name", "category")
    makers = wh["stg_product_supplier"].groupBy("product_sk").agg(
        F.count_distinct("supplier_sk").alias("suppliers")
    )
    suppliers = F.coalesce("suppliers", F.lit(0).cast("long"))
    return (
        best.join(products, "product_sk")
        .join(makers, "product_sk", "left")
        .orderBy(F.desc("net"), "product_sk")
        .select(
            "product_name",
            "category",
            _money("net").alias("revenue"),
            "qty_sold",
            suppliers.alias("supplier_count"),
            F.when(suppliers <= 1, "single-source").otherwise("multi-source").alias("sourcing"),
        )
    )


def cohort_retention(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    """Share of each first-purchase-month cohort that buys again n months later.

    A customer's months are gathered as a set: its size is bounded by the months in the
    calendar, it is built map-side, and one shuffle by customer answers everything.
    """
    month = month_number("transaction_date")
    customers = (
        _scoped(wh["fact_sales"], tenant)
        .filter(F.col("customer_sk").isNotNull())
        .groupBy("customer_sk")
        .agg(F.collect_set(month).alias("months"))
    )
    moves = customers.select(
        F.array_min("months").alias("cohort"), F.explode("months").alias("active")
    )
    cells = moves.groupBy("cohort", (F.col("active") - F.col("cohort")).alias("month_offset")).agg(
        F.count(F.lit(1)).alias("active_customers")
    )
    # Everybody is active in the first month, so offset 0 holds the cohort size.
    first = F.max(F.when(F.col("month_offset") == 0, F.col("active_customers")))
    size = first.over(Window.partitionBy("cohort"))
    label = F.format_string(
        "%04d-%02d", F.floor(F.col("cohort") / 12).cast("int"), F.col("cohort") % 12 + 1
    )
    return (
        cells.withColumn("cohort_size", size)
        .select(
            label.alias("cohort_month"),
            "month_offset",
            "cohort_size",
            "active_customers",
            half_up(ratio(F.col("active_customers"), F.col("cohort_size")) * 100, 1).alias(
                "retention_pct"
            ),
        )
        .orderBy("cohort_month", "month_offset")
    )


QUESTIONS = {
    fn.__name__: fn
    for fn in (
        top_products_per_category,
        monthly_revenue,
        payment_mix,
        revenue_by_store,
        promotion_effectiveness,
        promo_avg_comparison,
        top_products_by_city,
        customer_segments,
        transactions_by_day,
        revenue_margin,
        customer_ltv,
        inventory_turnover,
        employee_performance,
        promotion_roi,
        supplier_dependency,
        cohort_retention,
    )
}
