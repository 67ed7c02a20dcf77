"""Stored daily summaries of sales whose distinct counts and quantiles merge.

``daily_summaries`` has one row per tenant, day and payment method: lines, revenue, theta
sketches of the transactions and of the customers, and a KLL sketch of the line amounts.  Any
coarser grain is a union of those sketches, so a question over years reads a few kilobytes a day
and no line, and a changed month is rebuilt alone.  All of it runs as Spark's own aggregates.

Errors.  A theta sketch is exact up to ``2**LOG_ENTRIES`` (4,096) distinct values; beyond that its
estimate is off by at most ``DISTINCT_ERROR`` of the count in all but one of a million cases (five
standard deviations of 1 / sqrt(4,096)).  A quantile's rank is off by at most ``RANK_ERROR`` of the
rows (about three times the 99 % bound of ``KLL_ITEMS``).  Counts of lines and revenue are exact.
The exact questions stay the default; these are asked for by name.

Sales without a customer do not count as a customer.  A day without sales has no row; an empty
fact gives no rows anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.functions import as_double, half_up, ratio
from storelake.operators.checks import union_all
from storelake.plans.warehouse import Warehouse
from storelake.session import scratch_path, written

LOG_ENTRIES, DISTINCT_ERROR = 12, 0.08
KLL_ITEMS, RANK_ERROR = 800, 0.01
GRAIN = ["tenant_id", "date_key", "payment_method"]
_MONTH = "month_key"
# Declared, because types inferred from partition folders would turn a tenant "007" into 7.
_STORED = (
    "date_key int, payment_method string, lines long, net decimal(28,2), "
    "transactions binary, customers binary, amounts binary, tenant_id string, month_key int"
)


def daily_summaries(sales: DataFrame) -> DataFrame:
    """``fact_sales`` rows summarized per ``GRAIN``."""
    return sales.groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("net_amount").cast("decimal(28,2)").alias("net"),
        F.theta_sketch_agg("transaction_sk", LOG_ENTRIES).alias("transactions"),
        F.theta_sketch_agg("customer_sk", LOG_ENTRIES).alias("customers"),
        F.kll_sketch_agg_double(as_double("net_amount"), KLL_ITEMS).alias("amounts"),
    )


def merged(summaries: DataFrame, *keys: str) -> DataFrame:
    """Summaries at a coarser grain (no keys: of everything)."""
    return summaries.groupBy(*keys).agg(
        F.sum("lines").alias("lines"),
        F.sum("net").cast("decimal(28,2)").alias("net"),
        F.theta_union_agg("transactions", LOG_ENTRIES).alias("transactions"),
        F.theta_union_agg("customers", LOG_ENTRIES).alias("customers"),
        F.kll_merge_agg_double("amounts", KLL_ITEMS).alias("amounts"),
    )


class SummaryStore:
    """Daily summaries in a folder, partitioned by tenant and month.

    ``build`` replaces everything, ``rebuild`` the given months only (a month whose sales are
    gone becomes empty).  Writes go through Spark's dynamic partition overwrite."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def build(self, sales: DataFrame) -> None:
        self._write(daily_summaries(sales), "static")

    def rebuild(self, sales: DataFrame, months: Sequence[int]) -> None:
        """``months``: like 202403; only their days of ``sales`` are read."""
        days = [F.col("date_key").between(m * 100 + 1, m * 100 + 31) for m in sorted(set(months))]
        if not days:
            return
        inside = days[0]
        for other in days[1:]:
            inside = inside | other
        fresh = daily_summaries(sales.filter(inside))
        # A month without a sale left must be overwritten by something.
        stale = self.read().filter(F.col(_MONTH).isin(sorted(set(months)))).select("tenant_id", _MONTH).distinct()
        blank = stale.select(
            "tenant_id",
            (F.col(_MONTH) * 100).cast(fresh.schema["date_key"].dataType).alias("date_key"),
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in fresh.schema.fields if f.name not in GRAIN[:2]],
        )
        self._write(union_all([fresh, blank]), "dynamic")

    def read(self) -> DataFrame:
        rows = self.spark.read.schema(_STORED).parquet(self.path)
        return rows.filter(F.col("lines").isNotNull())

    def _write(self, rows: DataFrame, mode: str) -> None:
        spread = rows.withColumn(_MONTH, F.floor(F.col("date_key") / 100).cast("int")).repartition("tenant_id", _MONTH)
        spread.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("tenant_id", _MONTH).parquet(self.path)


# -- questions over summaries -----------------------------------------------------------------------


def _scoped(summaries: DataFrame, tenant: str | None) -> DataFrame:
    return summaries if tenant is None else summaries.filter(F.col("tenant_id") == tenant)


def payment_mix(summaries: DataFrame, tenant: str | None = "tenant_01") -> DataFrame:
    """Like ``questions.payment_mix``, each count within ``DISTINCT_ERROR``."""
    mix = merged(_scoped(summaries, tenant), "payment_method").select(
        "payment_method", F.theta_sketch_estimate("transactions").alias("transactions")
    )
    share = half_up(ratio(F.col("transactions"), mix.agg(F.sum("transactions")).scalar()) * 100, 1)
    return mix.select("payment_method", "transactions", share.alias("pct")).orderBy(
        F.desc("transactions"), "payment_method"
    )


def transactions_by_day(summaries: DataFrame, days: DataFrame, tenant: str | None = None) -> DataFrame:
    """Like ``questions.transactions_by_day``; revenue is exact, each count within ``DISTINCT_ERROR``.

    ``days`` is the calendar (``dim_date``)."""
    named = _scoped(summaries, tenant).join(days.select("date_key", "day_of_week", "day_name"), "date_key")
    return (
        merged(named, "day_of_week", "day_name")
        .select(
            "day_of_week",
            "day_name",
            F.theta_sketch_estimate("transactions").alias("transactions"),
            half_up(as_double("net"), 2).alias("revenue"),
        )
        .orderBy("day_of_week")
    )


def amount_quantiles(summaries: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Line amounts at the given ranks per ``keys``, columns ``q0``, ``q1``, ..."""
    found = merged(summaries, *keys)
    ranks = [
        F.when(F.kll_sketch_get_n_double("amounts") > 0, F.kll_sketch_get_quantile_double("amounts", F.lit(float(p))))
        .alias(f"q{i}")
        for i, p in enumerate(probabilities)
    ]
    return found.select(*keys, "lines", *ranks)


def returning_customers(summaries: DataFrame, tenant: str | None = None) -> DataFrame:
    """Customers per tenant and month, and how many of them also bought in the month before.

    The overlap is a theta intersection; its error is ``DISTINCT_ERROR`` of both months together."""
    months = merged(_scoped(summaries, tenant), "tenant_id", _MONTH).select("tenant_id", _MONTH, "customers")
    number = F.floor(F.col(_MONTH) / 100) * 12 + F.col(_MONTH) % 100
    before = months.select("tenant_id", (number + 1).alias("at"), F.col("customers").alias("earlier"))
    overlap = F.theta_sketch_estimate(F.theta_intersection("customers", "earlier"))
    return (
        months.withColumn("at", number)
        .join(before, ["tenant_id", "at"], "left")
        .select(
            "tenant_id",
            _MONTH,
            F.theta_sketch_estimate("customers").alias("customers"),
            F.coalesce(F.when(F.col("earlier").isNotNull(), overlap), F.lit(0).cast("long")).alias("returning"),
        )
        .orderBy("tenant_id", _MONTH)
    )


def _within(estimate: str, exact: str) -> Column:
    return F.abs(F.col(estimate) - F.col(exact)) <= F.ceil(F.col(exact) * DISTINCT_ERROR)


def summary_accuracy(wh: Warehouse) -> DataFrame:
    """Per tenant and year: what stored summaries say exactly, and whether their estimates keep the
    stated errors against the fact.  Three months are missing at first and rebuilt on their own."""
    # Five passes read these columns, so the fact is composed once for all of them.
    columns = ["tenant_id", "date_key", "payment_method", "transaction_sk", "customer_sk", "net_amount"]
    sales = wh["fact_sales"].select(*columns)
    if "fact_sales" not in wh.stored:
        sales = written(sales, "summarized")
    months = [199701, 199702, 199703]
    store = SummaryStore(sales.sparkSession, scratch_path(sales.sparkSession, "summaries"))
    store.build(sales.filter(~F.floor(F.col("date_key") / 100).isin(months)))
    store.rebuild(sales, months)
    year = F.floor(F.col("date_key") / 10000).cast("int")
    keys = ["tenant_id", "year"]
    said = amount_quantiles(store.read().withColumn("year", year), keys, [0.5]).join(
        merged(store.read().withColumn("year", year), *keys).select(
            *keys,
            "net",
            F.theta_sketch_estimate("transactions").alias("transactions"),
            F.theta_sketch_estimate("customers").alias("customers"),
        ),
        keys,
    )
    dated = sales.withColumn("year", year)
    # Distinct values by grouping twice, so that no task holds a set.
    counts = [
        dated.filter(F.col(key).isNotNull()).groupBy(*keys, key).agg(F.lit(1).alias("one"))
        .groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        for key, name in (("transaction_sk", "true_transactions"), ("customer_sk", "true_customers"))
    ]
    ranks = (
        dated.select(*keys, as_double("net_amount").alias("amount"))
        .join(said.select(*keys, "q0"), keys)
        .groupBy(*keys)
        .agg(
            F.avg((F.col("amount") < F.col("q0")).cast("double")).alias("below"),
            F.avg((F.col("amount") <= F.col("q0")).cast("double")).alias("upto"),
        )
    )
    checked = said.join(ranks, keys).join(counts[0], keys).join(counts[1], keys)
    return checked.select(
        *keys,
        "lines",
        "net",
        _within("transactions", "true_transactions").alias("transactions_within"),
        _within("customers", "true_customers").alias("customers_within"),
        ((F.col("below") <= 0.5 + RANK_ERROR) & (F.col("upto") >= 0.5 - RANK_ERROR)).alias("median_within"),
    )


SUMMARIES = {"summary_accuracy": summary_accuracy}
