"""Stored marts: opened by another session, and with one model substituted."""

import pytest

from shop import line, rows, sale, shop
from storelake.plans.questions import QUESTIONS
from storelake.plans.warehouse import MODELS, Warehouse

STAGING = [n for n, (layer, _) in MODELS.items() if layer == "staging"]


def whole_shop(spark):
    return shop(
        spark,
        customers=[dict(customer_id=1, name="Ann", city="Oslo"), dict(customer_id=2, name="Bo", city="Rome")],
        products=[dict(product_id=1, product_name="Tea", category="c"), dict(product_id=2, product_name="Pot", category="d")],
        stores=[dict(store_id=1, store_name="Main", city="Oslo")],
        suppliers=[dict(supplier_id=1, supplier_name="S")],
        promotions=[dict(promo_id=1, promo_name="P")],
        employees=[dict(employee_id=1, name="E", store_id=1)],
        transactions=[sale(1, total_amount="30"), sale(2, customer=2, when="2024-02-05T10:00:00", total_amount="7")],
        transaction_items=[line(1, 1, qty=2), line(2, 1, product=2, price="20"), line(3, 2, price="7")],
        transaction_promotions=[dict(id=1, transaction_id=1, promo_id=1, discount_applied="2")],
        inventory=[dict(inventory_id=1, store_id=1, product_id=1, supplier_id=1, stock_qty=9)],
        product_supplier=[dict(id=1, product_id=1, supplier_id=1, cost_price="3")],
        customer_loyalty=[dict(loyalty_id=1, customer_id=1, points=50)],
    )


def shown(wh, name):
    frame = wh[name]
    return sorted(rows(frame.select(*[c for c in frame.columns if c != "dbt_loaded_at"])), key=repr)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("marts"))
    return whole_shop(spark).materialize(path), path


def test_another_session_answers_all_questions_from_stored_marts(spark, stored):
    written, path = stored
    opened = Warehouse.open(written.raw, path)
    lazy = whole_shop(spark)
    assert len(QUESTIONS) == 16
    for name, question in QUESTIONS.items():
        answer = question(opened)
        assert sorted(rows(answer), key=repr) == sorted(rows(question(lazy)), key=repr), name


@pytest.mark.parametrize("name", STAGING)
def test_nothing_that_stands_on_a_substituted_model_is_carried_on(spark, stored, name):
    written, path = stored
    for wh in (written, Warehouse.open(written.raw, path)):
        other = wh.replace(name, wh[name].limit(0))
        assert [m for m in other.stored if name in wh._uses.get(m, ())] == []
        if name in ("stg_transactions", "stg_transaction_items"):
            assert {"int_sales_enriched", "fact_sales", "fact_inventory_movement"}.isdisjoint(other.stored)


def test_facts_over_a_substituted_model(spark, stored):
    written, path = stored
    empty = written["stg_transactions"].limit(0)
    for wh in (written, Warehouse.open(written.raw, path)):
        other = wh.replace("stg_transactions", empty)
        assert shown(other, "fact_inventory_movement") == shown(whole_shop(spark).replace("stg_transactions", empty), "fact_inventory_movement")
        assert other["int_sales_enriched"].count() == 0
