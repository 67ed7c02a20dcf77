from decimal import Decimal

from pyspark.sql import functions as F

from shop import by_key, day, line, rows, sale, shop, ts


def sales_shop(spark, **more):
    tables = dict(
        transactions=[
            sale(1),
            sale(2, status="cancelled"),
            sale(3, status="Completed"),
            sale(4, status=None),
            sale(5, customer=None, store=None, employee=None, payment="E-Wallet"),
        ],
        transaction_items=[
            line(10, 1, product=1, qty=3, price="10", subtotal="27"),
            line(11, 1, product=2, qty=1, price="5"),
            line(12, 1, product=99, qty=2, price="1", subtotal="2"),
            line(20, 2),
            line(30, 3),
            line(40, 4),
            line(50, 5, product=None),
        ],
        products=[
            dict(product_id=1, product_name=" Tea ", category="drinks"),
            dict(product_id=2, product_name="Rice", category=""),
        ],
        stores=[dict(store_id=1, store_name=" Main ", city="Oslo")],
        employees=[dict(employee_id=1, store_id=1, name=" Ann ", role="Cashier")],
        product_supplier=[
            dict(id=1, product_id=1, supplier_id=7, cost_price="4", is_primary=True),
            dict(id=2, product_id=1, supplier_id=8, cost_price="9", is_primary=False),
        ],
        transaction_promotions=[
            dict(id=1, transaction_id=1, promo_id=1, discount_applied="1.50"),
            dict(id=2, transaction_id=1, promo_id=2, discount_applied="2"),
            dict(id=3, transaction_id=2, promo_id=1, discount_applied="3"),
        ],
    )
    tables.update(more)
    return shop(spark, **tables)


def test_only_completed_case_sensitive(spark):
    assert sorted(r.transaction_id for r in sales_shop(spark)["stg_transactions"].collect()) == [1, 5]


def test_newest_status_decides_before_the_filter(spark):
    wh = shop(
        spark,
        transactions=[
            sale(1, updated_at=ts("2024-01-01")),
            sale(1, status="cancelled", updated_at=ts("2024-01-02")),
        ],
    )
    assert wh["stg_transactions"].count() == 0


def test_staging_cleans_text_and_builds_keys(spark):
    wh = shop(
        spark,
        customers=[dict(customer_id=3, name="  Bo ", email="BO@X.NO")],
        customer_loyalty=[dict(loyalty_id=1, customer_id=None, tier="GOLD")],
    )
    customer = wh["stg_customers"].first()
    assert (customer.customer_sk, customer.customer_name, customer.email) == ("t1-3", "Bo", "bo@x.no")
    card = wh["stg_customer_loyalty"].first()
    assert card.customer_sk is None and card.tier == "gold"


def test_fact_sales_lines_of_completed_transactions(spark):
    facts = by_key(sales_shop(spark)["fact_sales"], "sales_sk")
    assert sorted(facts) == ["t1-10", "t1-11", "t1-12", "t1-50"]
    tea = facts["t1-10"]
    assert (tea.gross_amount, tea.net_amount) == (Decimal("30.00"), Decimal("27.00"))
    assert (tea.txn_promo_discount, tea.is_promo_transaction) == (Decimal("3.50"), 1)
    plain = facts["t1-50"]
    assert (plain.txn_promo_discount, plain.is_promo_transaction) == (Decimal("0.00"), 0)
    assert (plain.customer_sk, plain.product_sk, plain.payment_method) == (None, None, "e-wallet")
    assert plain.date_key == 20240305


def test_enriched_lines_keep_rows_without_lookup(spark):
    lines = by_key(sales_shop(spark)["int_sales_enriched"], "sales_sk")
    tea, rice, unknown, bare = (lines[f"t1-{i}"] for i in (10, 11, 12, 50))
    assert (tea.product_name, tea.store_city, tea.employee_name) == ("Tea", "Oslo", "Ann")
    assert (tea.cost_amount, tea.margin_amount) == (Decimal("12.00"), Decimal("15.00"))
    assert tea.primary_supplier_sk == "t1-7"
    assert (rice.cost_price, rice.margin_amount) == (Decimal("0.00"), Decimal("5.00"))
    assert unknown.product_name is None and unknown.category is None
    assert bare.store_city is None and bare.employee_name is None


def test_primary_supplier_and_cost_come_from_the_same_newest_link(spark):
    wh = shop(
        spark,
        product_supplier=[
            dict(id=1, product_id=1, supplier_id=5, cost_price="2", updated_at=ts("2024-01-01")),
            dict(id=2, product_id=1, supplier_id=6, cost_price=None, updated_at=ts("2024-01-09")),
        ],
    )
    row = wh["int_primary_cost"].first()
    assert (row.primary_supplier_sk, row.cost_price) == ("t1-6", None)


def test_unused_lookup_joins_disappear(spark):
    df = sales_shop(spark)["int_sales_enriched"].select("net_amount", "store_city")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftOuter") == 1


def test_calendar_spans_gaps_and_is_empty_without_sales(spark):
    wh = shop(
        spark,
        transactions=[sale(1, when="2024-02-28T23:00:00"), sale(2, when="2024-03-03T01:00:00")],
    )
    days = wh["dim_date"].orderBy("date_key").collect()
    assert [d.date_key for d in days] == [20240228, 20240229, 20240301, 20240302, 20240303]
    last = days[-1]
    assert (last.day_of_week, last.day_name, last.is_weekend, last.month_name) == (7, "Sun", 1, "Mar")
    assert (last.quarter, last.year_month, last.day_of_month) == (1, "2024-03", 3)
    assert shop(spark)["dim_date"].count() == 0


def test_inventory_guards_and_flags(spark):
    wh = sales_shop(
        spark,
        inventory=[
            dict(inventory_id=1, product_id=1, store_id=1, stock_qty=0, reorder_level=5),
            dict(inventory_id=2, product_id=2, store_id=1, stock_qty=3, reorder_level=3),
            dict(inventory_id=3, product_id=8, store_id=1, stock_qty=9, reorder_level=3),
        ],
    )
    stock = by_key(wh["fact_inventory_movement"], "inventory_sk")
    got = {k: (r.qty_sold, r.turnover_rate, r.below_reorder) for k, r in stock.items()}
    assert got == {"t1-1": (3, 0.0, 1), "t1-2": (1, 0.3333, 1), "t1-3": (0, 0.0, 0)}


def test_loyalty_dimension_and_fact(spark):
    wh = shop(spark, customer_loyalty=[dict(loyalty_id=4, customer_id=2, tier="Gold", points=3)])
    tiers = [(r.tier_sk, r.tier_rank, int(r.min_spend)) for r in wh["dim_loyalty_tier"].collect()]
    assert sorted(tiers, key=lambda t: t[1]) == [
        ("bronze", 1, 0),
        ("silver", 2, 500000),
        ("gold", 3, 1500000),
        ("platinum", 4, 3000000),
    ]
    assert rows(wh["fact_loyalty_activity"].select("loyalty_sk", "tier_sk")) == [("t1-4", "gold")]


def test_build_time_is_stamped_and_can_be_injected(spark):
    moment = ts("2024-05-05T05:05:05")
    wh = shop(spark, loaded_at=F.lit(moment), stores=[dict(store_id=1, opened_at=day("2020-01-01"))])
    assert wh["dim_store"].first().dbt_loaded_at == moment
    assert "dbt_loaded_at" in shop(spark)["fact_sales"].columns


def test_materialized_models_equal_lazy_ones(spark, tmp_path):
    lazy, stored = sales_shop(spark), sales_shop(spark)
    stored.materialize(str(tmp_path))
    for name in ("fact_sales", "int_sales_enriched", "dim_date", "dim_loyalty_tier"):
        a, b = lazy[name].drop("dbt_loaded_at"), stored[name].drop("dbt_loaded_at")
        assert a.columns == b.columns and sorted(map(str, rows(a))) == sorted(map(str, rows(b)))


def test_lines_move_without_the_texts_of_surrogate_keys(spark):
    wh = sales_shop(spark)
    for fact in ("int_sales_enriched", "fact_sales"):
        plan = wh[fact]._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join " in line]
        assert joins and not any("_sk" in line for line in joins)
