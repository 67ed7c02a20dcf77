"""Chart-ready reshapes of question results.

Each works on a finished question result; labels that come from the data stay data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.operators.pivots import completed, pivoted
from storelake.plans import questions as q
from storelake.plans.warehouse import Warehouse


def pivot_store_month(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    """Every store with every month, 0 where nothing was sold."""
    return completed(q.revenue_by_store(wh, tenant), "store_name", "year_month", "revenue", 0.0)


def top_promotions(wh: Warehouse, tenant: str | None = None, k: int = 10) -> DataFrame:
    return q.promotion_effectiveness(wh, tenant).select("promo_name", "total_discount").limit(k)


def pivot_city_rank(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    """Revenue of the three best products side by side, per city."""
    ranked = q.ranked_products_by_city(wh, tenant, 3)
    cell = [
        F.coalesce(F.sum(F.when(F.col("rn") == k, F.col("revenue"))), F.lit(0.0)).alias(f"rank_{k}")
        for k in (1, 2, 3)
    ]
    return ranked.groupBy("city").agg(*cell)


def pivot_city_segment(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    segments = q.customer_segments(wh, tenant)
    return pivoted(segments, "city", "segment", "customers", ["High", "Medium", "Low"], 0)


def pivot_category_quarter(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    return completed(q.revenue_margin(wh, tenant), "category", "quarter", "revenue", 0.0)


def cohort_matrix(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    """A point per cohort and month offset that has activity, with the cohort's size."""
    return q.cohort_retention(wh, tenant).select("cohort_month", "month_offset", "retention_pct", "cohort_size")


def roi_sign_flag(wh: Warehouse, tenant: str | None = None) -> DataFrame:
    """Sign of each promotion's return; a missing return counts as zero."""
    positive = F.coalesce("roi", F.lit(0.0)) >= 0
    return q.promotion_roi(wh, tenant).select(
        "promo_name",
        "promo_type",
        "roi",
        F.when(positive, "positive").otherwise("negative").alias("sign"),
    )


RESHAPES = {
    fn.__name__: fn
    for fn in (
        pivot_store_month,
        top_promotions,
        pivot_city_rank,
        pivot_city_segment,
        pivot_category_quarter,
        cohort_matrix,
        roi_sign_flag,
    )
}
