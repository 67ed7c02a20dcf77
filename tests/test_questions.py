from shop import day, line, rows, sale, shop, ts
from storelake.plans import questions as q
from storelake.plans import reshapes, rules


def test_equal_names_merge_and_ties_are_settled(spark):
    wh = shop(
        spark,
        transactions=[sale(1)],
        transaction_items=[
            line(1, 1, product=1, qty=2),
            line(2, 1, product=2, qty=3),
            line(3, 1, product=3, qty=5),
            line(4, 1, product=4, qty=5),
        ],
        products=[
            dict(product_id=1, product_name="Tea", category="c"),
            dict(product_id=2, product_name="Tea", category="c"),
            dict(product_id=3, product_name="B", category="c"),
            dict(product_id=4, product_name="A", category="c"),
        ],
    )
    assert rows(q.top_products_per_category(wh, "t1", k=2)) == [("c", "A", 5), ("c", "B", 5)]
    assert rows(q.top_products_per_category(wh, "t1")) == [("c", "A", 5), ("c", "B", 5), ("c", "Tea", 5)]
    assert rows(q.top_products_per_category(wh, "t2")) == []


def test_payment_share_counts_transactions_not_lines(spark):
    wh = shop(
        spark,
        transactions=[sale(1), sale(2, payment="DEBIT"), sale(3, payment="debit")],
        transaction_items=[line(1, 1), line(2, 1), line(3, 2), line(4, 3)],
    )
    assert rows(q.payment_mix(wh, "t1")) == [("debit", 2, 66.7), ("cash", 1, 33.3)]


def test_six_months_back_is_clamped_and_inclusive(spark):
    wh = shop(
        spark,
        transactions=[
            sale(1, when="2024-08-31T01:00:00"),
            sale(2, when="2024-02-29T01:00:00"),
            sale(3, when="2024-02-28T01:00:00"),
        ],
        transaction_items=[line(1, 1), line(2, 2, price="4"), line(3, 3)],
        stores=[dict(store_id=1, store_name="Main", city="Oslo")],
    )
    assert rows(q.revenue_by_store(wh)) == [
        ("Main", "Oslo", "2024-02", 4.0),
        ("Main", "Oslo", "2024-08", 10.0),
    ]


def promo_shop(spark):
    return shop(
        spark,
        transactions=[
            sale(1, total_amount="100"),
            sale(2, total_amount="50"),
            sale(3, total_amount="7"),
        ],
        transaction_items=[
            line(1, 1, subtotal="90"),
            line(2, 2, subtotal="50"),
            line(3, 3, subtotal="20"),
        ],
        transaction_promotions=[
            dict(id=1, transaction_id=1, promo_id=1, discount_applied="4"),
            dict(id=2, transaction_id=1, promo_id=1, discount_applied="6"),
            dict(id=3, transaction_id=2, promo_id=1, discount_applied="5"),
            dict(id=4, transaction_id=2, promo_id=2, discount_applied="0"),
        ],
        promotions=[
            dict(promo_id=1, promo_name="P1", promo_type="bundle"),
            dict(promo_id=2, promo_name="P2", promo_type="bundle"),
            dict(promo_id=3, promo_name="unused", promo_type="bundle"),
        ],
    )


def test_promotion_mean_is_over_usage_rows(spark):
    got = rows(q.promotion_effectiveness(promo_shop(spark)))
    assert got == [("P1", "bundle", 15.0, 2, 83.33), ("P2", "bundle", 0.0, 1, 50.0)]


def test_promotion_roi_counts_a_transaction_once_and_guards_zero_discount(spark):
    # Baseline: the one plain transaction, 20.  P1: (150/2 - 20) * 2 = 110 over 15.
    got = rows(q.promotion_roi(promo_shop(spark)))
    assert got == [
        ("P1", "bundle", 150.0, 15.0, 2, 110.0, 7.33),
        ("P2", "bundle", 50.0, 0.0, 1, 30.0, None),
    ]
    assert [r[-1] for r in rows(reshapes.roi_sign_flag(promo_shop(spark)))] == ["positive"] * 2


def test_with_and_without_promotion(spark):
    got = sorted(rows(q.promo_avg_comparison(promo_shop(spark))))
    assert got == [("with_promo", 70.0, 2), ("without_promo", 20.0, 1)]


def test_segments_use_interpolated_quantiles_over_all_customers(spark):
    wh = shop(
        spark,
        transactions=[sale(i, customer=i) for i in range(1, 5)],
        transaction_items=[line(i, i, price=str(i)) for i in range(1, 5)],
        customers=[dict(customer_id=i, name="n", city="x" if i < 4 else "y") for i in range(1, 5)],
    )
    # 0.33 -> 1.99, 0.66 -> 2.98
    assert rows(q.customer_segments(wh)) == [
        ("x", "High", 1, 3.0),
        ("x", "Low", 1, 1.0),
        ("x", "Medium", 1, 2.0),
        ("y", "High", 1, 4.0),
    ]
    wide = {r.city: (r.High, r.Medium, r.Low) for r in reshapes.pivot_city_segment(wh).collect()}
    assert wide == {"x": (1, 1, 1), "y": (1, 0, 0)}


def test_weekday_counts_each_transaction_once(spark):
    wh = shop(
        spark,
        transactions=[sale(1, when="2024-03-03T10:00:00"), sale(2, when="2024-03-10T10:00:00")],
        transaction_items=[line(1, 1), line(2, 1), line(3, 2)],
    )
    assert rows(q.transactions_by_day(wh)) == [(7, "Sun", 2, 30.0)]


def test_margin_leaves_out_missing_and_empty_categories(spark):
    wh = shop(
        spark,
        transactions=[sale(1)],
        transaction_items=[line(i, 1, product=i) for i in (1, 2, 3, 4)],
        products=[
            dict(product_id=1, product_name="a", category="food"),
            dict(product_id=2, product_name="b", category=""),
            dict(product_id=3, product_name="c", category=None),
        ],
        product_supplier=[dict(id=1, product_id=1, supplier_id=1, cost_price="12.5")],
    )
    assert rows(q.revenue_margin(wh)) == [("food", "2024-Q1", 10.0, -2.5, -25.0)]


def test_lifetime_value_with_one_tier_per_customer(spark):
    wh = shop(
        spark,
        transactions=[sale(1, customer=1), sale(2, customer=2), sale(3, customer=77)],
        transaction_items=[line(1, 1, price="5"), line(2, 2, price="5"), line(3, 3, price="900")],
        customers=[dict(customer_id=1, name="A"), dict(customer_id=2, name="B")],
        customer_loyalty=[
            dict(loyalty_id=1, customer_id=1, tier="gold", member_since=day("2020-01-01")),
            dict(loyalty_id=2, customer_id=1, tier="Silver", member_since=day("2021-01-01")),
        ],
    )
    assert rows(q.customer_ltv(wh)) == [("A", None, "silver", 5.0, 1), ("B", None, "none", 5.0, 1)]
    assert len(rows(q.customer_ltv(wh, k=1))) == 1


def test_slowest_stock_first_and_empty_shelves_left_out(spark):
    wh = shop(
        spark,
        transactions=[sale(1)],
        transaction_items=[line(1, 1, product=1, qty=2), line(2, 1, product=2, qty=9)],
        stores=[dict(store_id=1, store_name="Main")],
        products=[dict(product_id=i, product_name=f"p{i}") for i in (1, 2, 3)],
        inventory=[
            dict(inventory_id=1, product_id=1, store_id=1, stock_qty=3),
            dict(inventory_id=2, product_id=2, store_id=1, stock_qty=3),
            dict(inventory_id=3, product_id=3, store_id=1, stock_qty=0),
        ],
    )
    assert rows(q.inventory_turnover(wh)) == [("Main", "p1", 3, 2, 0.667), ("Main", "p2", 3, 9, 3.0)]


def test_namesakes_merge_and_all_roles_take_part(spark):
    wh = shop(
        spark,
        transactions=[sale(1, employee=1), sale(2, employee=2), sale(3, employee=None)],
        transaction_items=[line(1, 1), line(2, 2, price="20"), line(3, 3)],
        stores=[dict(store_id=1, city="Oslo")],
        employees=[
            dict(employee_id=1, name="Ann", role="manager"),
            dict(employee_id=2, name=" Ann", role="Manager"),
        ],
    )
    assert rows(q.employee_performance(wh)) == [("Ann", "manager", "Oslo", 30.0, 30.0, 2, 15.0)]


def test_supplier_dependency_limits_before_it_joins(spark):
    wh = shop(
        spark,
        transactions=[sale(1)],
        transaction_items=[
            line(1, 1, product=1, price="9"),
            line(2, 1, product=2, price="8"),
            line(3, 1, product=3, price="7"),
        ],
        products=[dict(product_id=2, product_name="b"), dict(product_id=3, product_name="c")],
        product_supplier=[
            dict(id=1, product_id=2, supplier_id=1),
            dict(id=2, product_id=2, supplier_id=2),
        ],
    )
    # Product 1 takes a place although the product table does not know it.
    assert rows(q.supplier_dependency(wh, k=2)) == [("b", None, 8.0, 1, 2, "multi-source")]
    last = rows(q.supplier_dependency(wh, k=3))[-1]
    assert last == ("c", None, 7.0, 1, 0, "single-source")


def test_cohorts_cross_month_ends_and_skip_months(spark):
    wh = shop(
        spark,
        transactions=[
            sale(1, customer=1, when="2024-01-31T23:00:00"),
            sale(2, customer=1, when="2024-02-01T01:00:00"),
            sale(3, customer=2, when="2024-01-02T00:00:00"),
            sale(4, customer=2, when="2024-04-02T00:00:00"),
            sale(5, customer=None, when="2024-01-02T00:00:00"),
        ],
        transaction_items=[line(i, i) for i in range(1, 6)],
    )
    assert rows(q.cohort_retention(wh)) == [
        ("2024-01", 0, 2, 2, 100.0),
        ("2024-01", 1, 2, 1, 50.0),
        ("2024-01", 3, 2, 1, 50.0),
    ]
    cells = {r.month_offset: r.retention_pct for r in reshapes.cohort_matrix(wh).collect()}
    assert cells == {0: 100.0, 1: 50.0, 3: 50.0}


def test_line_subtotal_and_header_total(spark):
    wh = shop(
        spark,
        transactions=[sale(1), sale(2, status="cancelled"), sale(3)],
        transaction_items=[
            line(1, 1, qty=3, price="0.55", subtotal="1.57", discount="5"),
            line(2, 2, qty=1, price="2", subtotal="2"),
        ],
    )
    got = {r.item_sk: float(r.subtotal) for r in rules.line_subtotal(wh).collect()}
    assert got == {"t1-1": 1.57, "t1-2": 2.0}
    totals = {r.transaction_id: float(r.total_amount) for r in rules.header_total_rollup(wh).collect()}
    assert totals == {1: 1.57, 2: 2.0, 3: 0.0}


def test_tier_thresholds_are_inclusive(spark):
    spends = ["499999.99", "500000", "1500000", "3000000"]
    wh = shop(
        spark,
        transactions=[sale(i, customer=i) for i in range(1, 5)],
        transaction_items=[line(i, i, price=s) for i, s in enumerate(spends, 1)],
        customers=[dict(customer_id=i) for i in range(1, 6)],
    )
    got = {r.customer_id: (r.tier, r.points) for r in rules.loyalty_tier_assignment(wh).collect()}
    assert got == {
        1: ("bronze", 499),
        2: ("silver", 500),
        3: ("gold", 1500),
        4: ("platinum", 3000),
        5: ("bronze", 0),
    }


def test_missing_cells_are_zero(spark):
    wh = shop(
        spark,
        transactions=[
            sale(1, store=1, when="2024-01-05T00:00:00"),
            sale(2, store=2, when="2024-02-05T00:00:00"),
        ],
        transaction_items=[line(1, 1), line(2, 2)],
        stores=[dict(store_id=1, store_name="A"), dict(store_id=2, store_name="B")],
    )
    assert sorted(rows(reshapes.pivot_store_month(wh))) == [
        ("A", "2024-01", 10.0),
        ("A", "2024-02", 0.0),
        ("B", "2024-01", 0.0),
        ("B", "2024-02", 10.0),
    ]
