"""Derive the twelve raw tables from an order/line-item star schema on parquet.

Every raw table is a projection of one large input (or of a large input and the
``nation`` / ``region`` lookups), so no row of ``orders`` or ``lineitem`` moves
between executors before the first real operator.  Reference tables make up to nine rows of
one, and their files may be a single split, so their rows are first dealt to tasks in
proportion to the file (``SPREAD_BYTES``); what a task sorts stays the same at any size.
Ids are 1-based.

    tenant       order key (or, for reference data, all three tenants)
    store        block of 50 customers          employee  block of 10 customers
    campaign     block of 15 customers          supplier  block of 20 products
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.session import size_of
from storelake.sources.catalog import CATALOG, spec_of

# Parquet bytes of a reference table whose rows one task unfolds.
SPREAD_BYTES = 1 << 19

TENANTS = ["tenant_01", "tenant_02", "tenant_03"]

_L, _I, _D, _S, _TS = (
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.StringType(),
    T.TimestampType(),
)

# Declared, never inferred; zone-less parquet timestamps are read as UTC instants.
SCHEMAS = {
    "region": [("r_regionkey", _I), ("r_name", _S)],
    "nation": [("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)],
    "customer": [
        ("c_custkey", _L),
        ("c_name", _S),
        ("c_nationkey", _I),
        ("c_acctbal", _D),
        ("c_mktsegment", _S),
    ],
    "supplier": [("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)],
    "part": [
        ("p_partkey", _L),
        ("p_name", _S),
        ("p_brand", _S),
        ("p_type", _S),
        ("p_size", _I),
        ("p_retailprice", _D),
    ],
    "orders": [
        ("o_orderkey", _L),
        ("o_custkey", _L),
        ("o_orderstatus", _S),
        ("o_totalprice", _D),
        ("o_orderdate", _TS),
        ("o_orderpriority", _S),
    ],
    "lineitem": [
        ("l_orderkey", _L),
        ("l_partkey", _L),
        ("l_suppkey", _L),
        ("l_linenumber", _I),
        ("l_quantity", _D),
        ("l_extendedprice", _D),
        ("l_discount", _D),
        ("l_tax", _D),
        ("l_returnflag", _S),
        ("l_linestatus", _S),
        ("l_shipdate", _TS),
    ],
    "events": [
        ("event_id", _L),
        ("ts", _TS),
        ("user_id", _L),
        ("event_type", _S),
        ("value", _D),
        ("props", _S),
    ],
}


def star_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(column, kind) for column, kind in SCHEMAS[name]])


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(star_schema(name)).parquet(f"{folder}/{name}.parquet")


_EVERY_TENANT = "explode(array({})) AS tenant_id".format(", ".join(f"'{t}'" for t in TENANTS))


def _tenant_of(key: str) -> str:
    return f"concat('tenant_0', CAST({key} % 3 + 1 AS STRING)) AS tenant_id"


def _day(start: str, key: str, spread: int) -> str:
    return f"date_add(DATE'{start}', CAST({key} % {spread} AS INT))"


def _at(start: str, key: str, spread: int) -> str:
    return f"CAST({_day(start, key, spread)} AS TIMESTAMP)"


def _stamps(key: str, start: str = "1993-01-01", spread: int = 700) -> list[str]:
    at = _at(start, key, spread)
    return [f"{at} AS created_at", f"{at} AS updated_at"]


def _percent_of(money: str, percent: str) -> str:
    """``percent`` (a small integer) of an amount, without leaving decimal arithmetic."""
    exact = f"CAST({money} AS DECIMAL(18,2)) * CAST({percent} AS DECIMAL(5,0))"
    return f"CAST(round({exact} * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2))"


class RetailStar(Mapping[str, DataFrame]):
    """The raw tables of one input folder by name, with all row versions."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def star(self, name: str) -> DataFrame:
        return star_table(self.spark, self.folder, name)

    def _spread(self, name: str, *columns: str) -> DataFrame:
        """A reference table dealt to tasks by ``columns``; a small one stays as it is read."""
        tasks = -(-size_of(self.spark, f"{self.folder}/{name}.parquet") // SPREAD_BYTES)
        rows = self.star(name)
        return rows.repartition(tasks, *columns) if tasks > 1 else rows

    def __getitem__(self, name: str) -> DataFrame:
        spec_of(name)
        return getattr(self, f"_{name}")()

    def __iter__(self) -> Iterator[str]:
        return iter(CATALOG)

    def __len__(self) -> int:
        return len(CATALOG)

    # -- reference data -------------------------------------------------

    def _customers(self) -> DataFrame:
        # BUILDING customers were renamed: an older version precedes the current one.
        joined = self._spread("customer", "c_custkey", "c_name").join(
            self.star("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        versions = "explode(if(c_mktsegment = 'BUILDING', array(0, 1), array(1))) AS version"
        first = _day("1993-01-01", "c_custkey", 700)
        return joined.selectExpr("*", _EVERY_TENANT).selectExpr("*", versions).selectExpr(
            "tenant_id",
            "c_custkey + 1 AS customer_id",
            "if(version = 0, concat('old ', c_name), concat('  ', c_name, ' ')) AS name",
            "concat('08', lpad(CAST(c_custkey AS STRING), 10, '0')) AS phone",
            "upper(concat('c', CAST(c_custkey AS STRING), '@mail.test')) AS email",
            "CASE WHEN c_custkey % 53 = 0 THEN 'Other' WHEN c_custkey % 2 = 0 THEN 'Female'"
            " ELSE 'Male' END AS gender",
            "n_name AS city",
            f"CAST({first} AS TIMESTAMP) AS created_at",
            f"CAST(date_add({first}, version * 30) AS TIMESTAMP) AS updated_at",
        )

    def _products(self) -> DataFrame:
        return self._spread("part", "p_partkey", "p_name").selectExpr(
            _EVERY_TENANT,
            "p_partkey + 1 AS product_id",
            "concat(' ', p_name, '  ') AS product_name",
            "CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 41 = 0 THEN ''"
            " ELSE p_type END AS category",
            "p_brand AS brand",
            "CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price",
            "p_partkey % 19 <> 0 AS is_active",
            *_stamps("p_partkey"),
        )

    def _stores(self) -> DataFrame:
        blocks = (
            self.star("customer")
            .groupBy(F.expr("c_custkey div 50 AS block"))
            .agg(F.min_by("c_nationkey", "c_custkey").alias("home_nation"))
            .join(self.star("nation"), F.col("home_nation") == F.col("n_nationkey"))
            .join(self.star("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return blocks.selectExpr(
            _EVERY_TENANT,
            "block + 1 AS store_id",
            "concat(' Store ', CAST(block + 1 AS STRING), ' ') AS store_name",
            "n_name AS city",
            "r_name AS province",
            "CASE WHEN block % 11 = 10 THEN 'kiosk' WHEN block % 3 = 0 THEN 'minimarket'"
            " WHEN block % 3 = 1 THEN 'supermarket' ELSE 'express' END AS store_type",
            f"{_day('1990-01-01', 'block', 900)} AS opened_at",
            "true AS is_active",
            *_stamps("block"),
        )

    def _employees(self) -> DataFrame:
        crew = self.star("customer").groupBy(F.expr("c_custkey div 10 AS block")).agg(
            F.min("c_custkey").alias("first_customer")
        )
        return crew.selectExpr(
            _EVERY_TENANT,
            "block + 1 AS employee_id",
            "first_customer div 50 + 1 AS store_id",
            "concat(' Clerk ', CAST(block % 40 AS STRING), ' ') AS name",
            "CASE WHEN block % 23 = 22 THEN 'Trainee' WHEN block % 5 = 0 THEN 'Manager'"
            " WHEN block % 5 = 1 THEN 'SUPERVISOR' ELSE 'Cashier' END AS role",
            f"{_day('1991-01-01', 'block', 800)} AS hire_date",
            "block % 17 <> 0 AS is_active",
            *_stamps("block"),
        )

    def _suppliers(self) -> DataFrame:
        makers = (
            self.star("supplier")
            .join(self.star("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.star("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return makers.selectExpr(
            _EVERY_TENANT,
            "s_suppkey + 1 AS supplier_id",
            "s_name AS supplier_name",
            "concat('Contact ', CAST(s_suppkey AS STRING)) AS contact_name",
            "n_name AS city",
            "r_name AS country",
            *_stamps("s_suppkey"),
        )

    def _promotions(self) -> DataFrame:
        campaigns = self.star("customer").groupBy(F.expr("c_custkey div 15 AS block")).agg(
            F.count(F.lit(1)).alias("members")
        )
        start = _day("1995-01-01", "block", 900)
        return campaigns.selectExpr(
            _EVERY_TENANT,
            "block + 1 AS promo_id",
            "concat('Campaign ', CAST(block + 1 AS STRING)) AS promo_name",
            "CASE block % 3 WHEN 0 THEN 'discount' WHEN 1 THEN 'bundle' ELSE 'cashback' END"
            " AS promo_type",
            "CAST(3 + block % 13 AS DECIMAL(18,2)) AS discount_pct",
            f"{start} AS start_date",
            f"date_add({start}, 90) AS end_date",
            "CAST(members * 1000 AS DECIMAL(18,2)) AS min_purchase",
            *_stamps("block"),
        )

    def _product_supplier(self) -> DataFrame:
        # 0 to 3 suppliers per product, the first of them primary.
        links = "least(p_size % 4, p_partkey div 20 + 1)"
        slots = f"explode(if({links} > 0, sequence(0, CAST({links} - 1 AS INT)), array())) AS slot"
        supplier = "p_partkey div 20 - slot"
        bridge = self._spread("part", "p_partkey", "p_name").selectExpr("*", slots)
        return bridge.selectExpr(
            _EVERY_TENANT,
            "p_partkey * 4 + slot + 1 AS id",
            "p_partkey + 1 AS product_id",
            f"{supplier} + 1 AS supplier_id",
            f"{_percent_of('p_retailprice', f'(55 + ({supplier}) % 26)')} AS cost_price",
            "CAST(2 + slot * 3 AS BIGINT) AS lead_time_days",
            "slot = 0 AS is_primary",
            *_stamps("p_partkey"),
        )

    def _inventory(self) -> DataFrame:
        # A product is stocked in its home store, the one before it and store 1.
        home = "(p_partkey div 67 + 1)"
        places = f"array_distinct(array({home}, greatest({home} - 1, 1L), 1L))"
        stock = self._spread("part", "p_partkey", "p_name").selectExpr("*", f"posexplode({places}) AS (slot, store)")
        return stock.selectExpr(
            _EVERY_TENANT,
            "p_partkey * 3 + slot + 1 AS inventory_id",
            "p_partkey + 1 AS product_id",
            "store AS store_id",
            "p_partkey div 20 + 1 AS supplier_id",
            "(p_partkey * 7 + slot * 13) % 60 AS stock_qty",
            "5 + p_partkey % 16 AS reorder_level",
            f"if(p_partkey % 17 <> 0, {_at('2001-01-01', 'p_partkey', 200)}, NULL)"
            " AS last_restocked",
            *_stamps("p_partkey"),
        )

    def _customer_loyalty(self) -> DataFrame:
        # MACHINERY customers never joined; AUTOMOBILE customers hold two cards.
        cards = (
            self._spread("customer", "c_custkey", "c_name")
            .filter("c_mktsegment <> 'MACHINERY'")
            .selectExpr(
                "*",
                "greatest(CAST(c_acctbal AS DECIMAL(18,2)), 0) * 400 AS spend",
                "explode(if(c_mktsegment = 'AUTOMOBILE', array(0, 1), array(0))) AS card",
            )
        )
        return cards.selectExpr(
            _EVERY_TENANT,
            "c_custkey * 2 + card + 1 AS loyalty_id",
            "c_custkey + 1 AS customer_id",
            "CASE WHEN card = 1 THEN 'BRONZE' WHEN spend >= 3000000 THEN 'platinum'"
            " WHEN spend >= 1500000 THEN 'Gold' WHEN spend >= 500000 THEN 'SILVER'"
            " ELSE 'bronze' END AS tier",
            "floor(CAST(spend AS DOUBLE) / 1000) AS points",
            "CAST(spend AS DECIMAL(18,2)) AS total_spend",
            f"date_add({_day('1994-01-01', 'c_custkey', 500)}, card * 40) AS member_since",
            *_stamps("c_custkey", "1994-01-01", 500),
        )

    # -- movements ------------------------------------------------------

    def _transactions(self) -> DataFrame:
        # Low-priority orders were first stored as pending, a day before their final state.
        versions = "explode(if(o_orderpriority = '5-LOW', array(0, 1), array(1))) AS version"
        return self.star("orders").selectExpr("*", versions).selectExpr(
            _tenant_of("o_orderkey"),
            "o_orderkey + 1 AS transaction_id",
            "if(o_orderkey % 89 <> 0, o_custkey + 1, NULL) AS customer_id",
            "if(o_orderkey % 97 <> 0, o_custkey div 50 + 1, NULL) AS store_id",
            "if(o_orderkey % 50 <> 0, o_custkey div 10 + 1, NULL) AS employee_id",
            "timestampadd(SECOND, CAST(o_orderkey % 86400 AS INT), o_orderdate)"
            " AS transaction_date",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit' WHEN '2-HIGH' THEN 'DEBIT'"
            " WHEN '3-MEDIUM' THEN 'e-Wallet' ELSE 'Cash' END AS payment_method",
            "CASE WHEN version = 0 THEN 'pending' WHEN o_orderstatus = 'P' THEN 'cancelled'"
            " ELSE 'completed' END AS status",
            "o_orderdate AS created_at",
            "timestampadd(DAY, version, o_orderdate) AS updated_at",
        )

    def _transaction_items(self) -> DataFrame:
        # (order, line number) repeats: those rows are versions, ordered by ship date.
        kept = "(CAST(1 AS DECIMAL(5,2)) - CAST(l_discount AS DECIMAL(4,2)))"
        return self.star("lineitem").selectExpr(
            _tenant_of("l_orderkey"),
            "l_orderkey * 10 + l_linenumber AS item_id",
            "l_orderkey + 1 AS transaction_id",
            "l_partkey + 1 AS product_id",
            "CAST(l_quantity AS BIGINT) AS quantity",
            "CAST(floor(l_extendedprice / l_quantity * 100D + 0.5D) / 100D AS DECIMAL(18,2))"
            " AS unit_price",
            "CAST(l_discount * 100D AS DECIMAL(18,2)) AS discount",
            f"CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * {kept}, 2) AS DECIMAL(18,2))"
            " AS subtotal",
            "l_shipdate AS created_at",
            "l_shipdate AS updated_at",
        )

    def _transaction_promotions(self) -> DataFrame:
        # Urgent orders used their customer's campaign; large ones one more.
        # Every eighth campaign stays unused.
        first = "(o_custkey div 15 - if(o_custkey div 15 % 8 = 7, 1, 0))"
        second = f"greatest({first} - 2, 0L)"
        campaigns = f"if(o_totalprice > 300000, array({first}, {second}), array({first}))"
        uses = (
            self.star("orders")
            .filter("o_orderpriority = '1-URGENT'")
            .selectExpr("*", f"posexplode({campaigns}) AS (slot, campaign)")
        )
        return uses.selectExpr(
            _tenant_of("o_orderkey"),
            "o_orderkey * 2 + slot + 1 AS id",
            "o_orderkey + 1 AS transaction_id",
            "campaign + 1 AS promo_id",
            f"{_percent_of('o_totalprice', '(3 + (o_orderkey + slot) % 13)')} AS discount_applied",
            "o_orderdate AS created_at",
            "o_orderdate AS updated_at",
        )
