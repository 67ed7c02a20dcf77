"""One key with a third of all rows, dimensions too large to broadcast."""

import pytest
from pyspark.sql import functions as F

from shop import sale, shop

TINY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def tiny_limits(spark):
    before = {k: spark.conf.get(k, None) for k in TINY}
    for key, value in TINY.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, lines=60_000):
    """A third of the lines in transaction 0, another third of them for product 0."""
    wh = shop(
        spark,
        transactions=[sale(i, store=i % 5) for i in range(300)],
        products=[dict(product_id=i, product_name=f"p{i}", category="c") for i in range(300)],
    )
    n = F.col("id")
    items = spark.range(lines).repartition(8).select(
        F.concat(F.lit("t"), F.when(n >= 0, 1).otherwise(n).cast("string")).alias("tenant_id"),
        n.alias("item_id"),
        F.when(n % 3 == 0, 0).otherwise(n % 300).alias("transaction_id"),
        F.when(n % 3 == 1, 0).otherwise(n % 300).alias("product_id"),
        F.lit(1).cast("long").alias("quantity"),
        F.lit(2).cast("decimal(18,2)").alias("unit_price"),
        F.lit(0).cast("decimal(18,2)").alias("discount"),
        F.lit(2).cast("decimal(18,2)").alias("subtotal"),
        F.lit("2024-01-01").cast("timestamp").alias("created_at"),
        F.lit("2024-01-01").cast("timestamp").alias("updated_at"),
    )
    wh.raw["transaction_items"] = items
    return wh


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("model, splits", [("fact_sales", 1), ("int_sales_enriched", 2)])
def test_hot_keys_are_split(spark, tiny_limits, model, splits):
    df = hot(spark)[model].drop("dbt_loaded_at")
    plan = final_plan(df).split("Initial Plan")[0]
    assert plan.count("SortMergeJoin(skew=true)") >= splits, plan
    assert df.count() == 60_000


def test_totals_with_hot_keys(spark, tiny_limits):
    wh = hot(spark)
    row = wh["int_sales_enriched"].agg(F.sum("net_amount"), F.count("product_name")).first()
    assert (int(row[0]), row[1]) == (120_000, 60_000)


