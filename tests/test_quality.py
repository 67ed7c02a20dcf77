import pytest
from pyspark.sql import functions as F

from shop import line, raw_table, rows, sale, shop, ts
from storelake.operators import checks
from storelake.operators.checks import Check, GateFailed
from storelake.plans import quality
from storelake.sources.catalog import UnknownTable

NOW = ts("2024-03-06T00:00:00")


def good_shop(spark, **more):
    tables = dict(
        customers=[dict(customer_id=1, name="A", gender="Male")],
        products=[dict(product_id=1, product_name="Tea", category="drinks")],
        stores=[dict(store_id=1, store_name="Main", store_type="express")],
        suppliers=[dict(supplier_id=1)],
        promotions=[dict(promo_id=1, promo_type="bundle")],
        employees=[dict(employee_id=1, store_id=1, name="Ann", role="Cashier")],
        transactions=[sale(1)],
        transaction_items=[line(1, 1)],
        transaction_promotions=[dict(id=1, transaction_id=1, promo_id=1, discount_applied="1")],
        inventory=[dict(inventory_id=1, product_id=1, store_id=1, supplier_id=1, stock_qty=4)],
        product_supplier=[dict(id=1, product_id=1, supplier_id=1, cost_price="2")],
        customer_loyalty=[dict(loyalty_id=1, customer_id=1, tier="Gold")],
    )
    tables.update(more)
    return shop(spark, loaded_at=F.lit(NOW), **tables)


def failures(results):
    return {
        (r.model, r["column"], r["check"]): (r.failures, r.status)
        for r in results.collect()
        if r.failures
    }


def test_declared_check_counts():
    assert (len(quality.source_checks()), len(quality.staging_checks()), len(quality.mart_checks())) == (17, 44, 42)
    kinds = [c.kind for c in quality.all_checks()]
    counts = {k: kinds.count(k) for k in ("not_null", "unique", "relationships", "accepted_values")}
    assert counts == {"not_null": 51, "unique": 25, "relationships": 17, "accepted_values": 10}
    assert sum(c.severity == "warn" for c in quality.all_checks()) == 16


def test_good_data_passes_every_gate(spark):
    wh = good_shop(spark)
    results = quality.layer_results(wh, "staging").unionByName(
        quality.layer_results(wh, "marts", F.lit(NOW))
    )
    assert failures(results) == {}
    assert results.count() == 17 + 44 + 42 + 2


def test_planted_staging_faults_are_found(spark):
    wh = good_shop(
        spark,
        customers=[dict(customer_id=1, name="A", gender="Robot"), dict(customer_id=2, name="B")],
        transactions=[sale(1), sale(2, customer=55, store=66, payment="barter")],
        transaction_items=[line(1, 1), line(2, 2, product=77), line(3, 2, product=77)],
    )
    found = failures(quality.layer_results(wh, "staging"))
    assert found == {
        ("stg_customers", "gender", "accepted_values"): (1, "warn"),
        ("stg_transactions", "payment_method", "accepted_values"): (1, "fail"),
        ("stg_transactions", "customer_sk", "relationships:stg_customers"): (1, "fail"),
        ("stg_transactions", "store_sk", "relationships:stg_stores"): (1, "warn"),
        ("stg_transaction_items", "product_sk", "relationships:stg_products"): (2, "fail"),
    }


def test_row_level_operators(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert checks.null_rows(df, "k").count() == 2
    assert rows(checks.repeated_keys(df, "k")) == [("a", 2)]
    assert rows(checks.orphan_keys(df, "k", parent, "k")) == [("b", 1)]
    assert rows(checks.unaccepted_rows(df, "k", ["a"])) == [("b",)]


def test_key_and_column_checks_share_a_pass(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3), (None, None)], "k string, v long")
    unique = Check("staging", "m", "k", "unique")
    columns = [
        Check("staging", "m", "k", "not_null"),
        Check("staging", "m", "v", "not_null"),
        Check("staging", "m", "v", "accepted_values", "warn", (1,)),
    ]
    merged = sorted(rows(checks.keyed_checks(df, unique, columns)))
    apart = rows(checks.scan_checks(df, columns)) + rows(checks.keyed_checks(df, unique))
    assert merged == sorted(apart)
    assert {(r[2], r[3]): r[5] for r in merged} == {
        ("k", "unique"): 1,
        ("k", "not_null"): 1,
        ("v", "not_null"): 2,
        ("v", "accepted_values"): 1,
    }
    empty = rows(checks.keyed_checks(df.limit(0), unique, columns))
    assert [r[5] for r in empty] == [0, 0, 0, 0]


def test_two_keys_of_one_model_are_both_checked(spark):
    wh = good_shop(spark)
    both = [Check("staging", "stg_customers", c, "unique") for c in ("customer_sk", "customer_id")]
    assert sorted(r["column"] for r in quality.run_checks(wh, both).collect()) == ["customer_id", "customer_sk"]


def test_warnings_never_stop_the_gate_and_errors_do(spark):
    df = spark.createDataFrame([("x",), (None,)], "k string")
    warn = Check("staging", "m", "k", "not_null", "warn")
    error = Check("staging", "m", "k", "accepted_values", "error", ("y",))
    checks.enforce(checks.scan_checks(df, [warn]))
    with pytest.raises(GateFailed, match=r"m.k accepted_values \(1\)"):
        checks.enforce(checks.scan_checks(df, [warn, error]))


def test_failed_layer_blocks_the_next(spark):
    results = spark.createDataFrame(
        [("raw", "warn"), ("staging", "fail"), ("staging", "pass"), ("marts", "pass")],
        "layer string, status string",
    )
    states = {r.layer: r.state for r in checks.gate_states(results, ["raw", "staging", "marts"]).collect()}
    assert states == {"raw": "passed", "staging": "failed", "marts": "blocked"}


def counts(spark, *items):
    return spark.createDataFrame(list(items), "tenant_id string, table_name string, rows long")


def test_row_count_reconcile(spark):
    source = counts(spark, ("t", "a", 5), ("t", "b", 5), ("t", "c", 5), ("t", "gone", 2))
    landed = counts(spark, ("t", "a", 5), ("t", "b", 4), ("t", "c", 6), ("t", "kept", 1))
    got = {r.table_name: r.status for r in checks.row_count_reconcile(source, landed).collect()}
    assert got == {"a": "OK", "b": "FAIL", "c": "WARN", "gone": "FAIL", "kept": "WARN"}
    lax = {r.table_name: r.status for r in checks.row_count_reconcile(source, landed, 2).collect()}
    assert set(lax.values()) == {"OK"}


def test_unknown_table_cannot_be_reconciled(spark):
    with pytest.raises(UnknownTable):
        quality.reconcile_landing({"nope": spark.range(1)}, {})


def test_revenue_may_differ_by_at_most_one(spark):
    a = spark.createDataFrame([(100.00,)], "x double").select(F.col("x").cast("decimal(18,2)"))
    for value, status in [("101.00", "pass"), ("101.01", "fail")]:
        b = spark.range(1).select(F.lit(value).cast("decimal(18,2)").alias("x"))
        assert checks.amount_reconcile(a, "x", b, "x").first().status == status
    assert checks.amount_reconcile(a.limit(0), "x", a, "x").first().status == "fail"


def test_freshness_counts_hour_boundaries_and_fails_when_empty(spark):
    loaded = spark.createDataFrame([(ts("2024-01-01T10:59:00"),)], "at timestamp")
    for now, status in [("2024-01-02T10:59:59", "pass"), ("2024-01-02T11:00:00", "fail")]:
        assert checks.freshness(loaded, "at", F.lit(ts(now))).first().status == status
    assert checks.freshness(loaded.limit(0), "at", F.lit(NOW)).first().status == "fail"


def test_run_gates_stops_at_the_landing_counts(spark):
    wh = good_shop(spark)
    source = {"customers": wh.raw["customers"].union(wh.raw["customers"].withColumn("customer_id", F.lit(9).cast("long")))}
    with pytest.raises(GateFailed, match="row_count"):
        quality.run_gates(wh, source, F.lit(NOW))
    quality.run_gates(wh, {"customers": wh.raw["customers"]}, F.lit(NOW))


def test_reconciliation_reports_pairs_without_rows(spark):
    empty = {"suppliers": raw_table(spark, "suppliers", [])}
    got = quality.reconcile_landing(empty, empty, tenants=["a", "b"])
    assert sorted(rows(got.select("tenant_id", "table_name", "source_rows", "landed_rows", "status"))) == [
        ("a", "suppliers", 0, 0, "OK"),
        ("b", "suppliers", 0, 0, "OK"),
    ]


def versioned_shop(spark):
    """Two versions of a sale, of a line and of a stock row, faults in the newer ones, null keys."""
    later = dict(updated_at=ts("2024-02-01T00:00:00"))
    return good_shop(
        spark,
        customers=[dict(customer_id=1, name="A", gender="Robot"), dict(customer_id=None, name="B")],
        transactions=[sale(1, status="pending"), sale(1, customer=55, store=None, **later), sale(2), sale(3, status="cancelled")],
        transaction_items=[line(1, 1), line(1, 1, product=77, **later), line(2, 2, qty=None), line(3, 3), line(None, 2)],
        inventory=[dict(inventory_id=1, product_id=1, store_id=1), dict(inventory_id=1, product_id=8, store_id=1, stock_qty=None, **later)],
    )


def planned(monkeypatch):
    """How often what is stored, and a result, choose versions of the keys of each of these tables."""
    plans, written = [], quality.written
    plan_of = lambda df: df._jdf.queryExecution().optimizedPlan().toString()

    def recorded(df, purpose):
        plans.append(plan_of(df))
        return written(df, purpose)

    monkeypatch.setattr(quality, "written", recorded)
    keys = [quality.spec_of(t).key for t in ("transactions", "transaction_items", "inventory")]
    count = lambda plan, key: plan.count(f"row_number() windowspecdefinition({key}#")
    return lambda *results: [sum(count(p, k) for p in [*plans, *map(plan_of, results)]) for k in keys]


def test_stored_newest_rows_change_no_result(spark):
    for checked in (quality.all_checks(), quality.checked("unique"), quality.checked("relationships")):
        stored = quality.run_checks(versioned_shop(spark), checked)
        assert sorted(rows(stored)) == sorted(rows(quality.run_checks(versioned_shop(spark), checked, store=False)))
    found = failures(quality.run_checks(versioned_shop(spark), quality.all_checks()))
    assert found[("fact_sales", "customer_sk", "relationships:dim_customer")] == (1, "fail")
    assert found[("stg_inventory", "product_sk", "relationships:stg_products")] == (1, "warn")


def test_checks_choose_versions_of_a_large_table_once(spark, monkeypatch):
    times = planned(monkeypatch)
    wh = versioned_shop(spark)
    assert times(quality.run_checks(wh, quality.staging_checks() + quality.mart_checks())) == [1, 1, 1]
    assert not wh.newest and not wh.stored


def test_a_parent_may_repeat_its_keys(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "p string")
    orphans = checks.orphan_keys(child, "k", parent, "p")
    assert rows(orphans) == [("b", 2)] and orphans.columns == ["k", "rows"]
    assert rows(checks.orphan_keys(child.limit(0), "k", parent, "p")) == []


def test_columns_that_were_not_stored_cannot_be_read(spark):
    wh = quality.sorted_out(good_shop(spark))
    assert wh["stg_transaction_items"].select("quantity").count() == 1
    with pytest.raises(Exception, match="transaction_items.unit_price is not among"):
        wh["stg_transaction_items"].select("unit_price").collect()


def test_substituted_models_are_checked(spark):
    wh = good_shop(spark)
    bad = wh["stg_transactions"].withColumn("payment_method", F.lit("barter"))
    found = failures(quality.run_checks(wh.replace("stg_transactions", bad), quality.staging_checks() + quality.mart_checks()))
    assert found == {("stg_transactions", "payment_method", "accepted_values"): (1, "fail")}


def test_gates_share_the_newest_rows(spark, monkeypatch):
    times = planned(monkeypatch)
    wh = quality.sorted_out(versioned_shop(spark))
    landing = quality.reconcile_landing(wh.raw, wh.raw, newest=wh.newest)
    results = [quality.layer_results(wh, layer, F.lit(NOW)) for layer in quality.GATES]
    assert times(landing, *results) == [1, 1, 1]
    assert {r.table_name: r.landed_rows for r in landing.collect()}["transaction_items"] == 4
