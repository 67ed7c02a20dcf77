"""Facts refreshed from a change set equal a full rebuild, and recompute only what was touched."""

import pytest

from shop import CATALOG, line, raw_table, rows, sale, ts
from storelake.plans import refresh
from storelake.plans.refresh import REFRESHED, Refresh, refreshed
from storelake.plans.warehouse import Warehouse
from storelake.sources.generations import Conflict
from storelake.sources.landing import LandingZone

LATER = ts("2024-06-01")
N = 40

BEFORE = dict(
    products=[dict(product_id=i, product_name=f"p{i}", category="c") for i in (1, 2, 3)],
    stores=[dict(store_id=i, store_name=f"s{i}", city="Oslo") for i in (1, 2)],
    employees=[dict(employee_id=1, name="E", role="clerk")],
    transactions=[sale(i, store=1 + i % 2, status="open" if i == 5 else "completed") for i in range(N)],
    transaction_items=[line(10 * i + j, i, product=1 + (i + j) % 2, qty=1 + j) for i in range(N) for j in range(2)],
    transaction_promotions=[dict(id=i, transaction_id=i, promo_id=1, discount_applied="2") for i in range(0, N, 4)],
    inventory=[dict(inventory_id=10 * s + p, store_id=s, product_id=p, supplier_id=1, stock_qty=50, reorder_level=5) for s in (1, 2) for p in (1, 2, 3)],
    product_supplier=[dict(id=1, product_id=1, supplier_id=1, cost_price="3", is_primary=True)],
)

CHANGES = {
    "a transaction is completed": dict(transactions=[sale(5, updated_at=LATER)]),
    "a transaction is cancelled": dict(transactions=[sale(6, status="cancelled", updated_at=LATER)]),
    "a line moves to another transaction": dict(transaction_items=[line(70, 8, qty=9, updated_at=LATER)]),
    "a line goes to an open transaction and another is new": dict(transaction_items=[line(90, 5, updated_at=LATER), line(999, 9, product=3, updated_at=LATER)]),
    "a promotion moves": dict(transaction_promotions=[dict(id=4, transaction_id=3, promo_id=1, discount_applied="5", updated_at=LATER)]),
    "a product and a clerk are renamed": dict(products=[dict(product_id=2, product_name="new", category="d", updated_at=LATER)], employees=[dict(employee_id=1, name="F", role="boss", updated_at=LATER)]),
    "a cost changes": dict(product_supplier=[dict(id=1, product_id=1, supplier_id=1, cost_price="4", is_primary=True, updated_at=LATER)]),
    "stock changes and moves": dict(inventory=[dict(inventory_id=11, store_id=2, product_id=3, supplier_id=1, stock_qty=0, updated_at=LATER), dict(inventory_id=99, store_id=1, product_id=1, supplier_id=1, stock_qty=4, updated_at=LATER)]),
    "an older version comes late": dict(transaction_items=[line(30, 4, qty=77, updated_at=ts("2023-01-01"))]),
}


def raw_of(spark, tables):
    return {name: raw_table(spark, name, tables.get(name, [])) for name in CATALOG}


def content(frame):
    return sorted(rows(frame.select(*[c for c in frame.columns if c != "dbt_loaded_at"])), key=repr)


@pytest.fixture(scope="module")
def before(spark, tmp_path_factory):
    return Warehouse(raw_of(spark, BEFORE)).materialize(str(tmp_path_factory.mktemp("marts")), side_by_side=8)


# Change sets that do not meet are tried together; each group is one rebuild.
GROUPS = [
    ["a transaction is completed", "a line moves to another transaction", "an older version comes late"],
    ["a transaction is cancelled", "a line goes to an open transaction and another is new", "a promotion moves"],
    ["a product and a clerk are renamed", "stock changes and moves"],
    ["a cost changes"],
]


@pytest.mark.parametrize("group", GROUPS, ids=lambda g: g[0])
def test_refreshed_facts_equal_a_full_rebuild(spark, before, group):
    data = {}
    for name in group:
        for table, items in CHANGES[name].items():
            data[table] = data.get(table, []) + items
    changed = {t: raw_table(spark, t, items) for t, items in data.items()}
    after = {t: df.unionByName(changed[t]) if t in changed else df for t, df in raw_of(spark, BEFORE).items()}
    whole, part = Warehouse(after), refreshed(before, after, changed)
    for fact in REFRESHED:
        assert content(part[fact]) == content(whole[fact]), fact


def test_without_changes_the_stored_facts_are_shown(spark, before):
    work = Refresh(before, raw_of(spark, BEFORE), {})
    assert work.touched.count() == 0
    assert content(work.fact_sales()) == content(before["fact_sales"])


def test_only_touched_transactions_are_recomputed(spark, before):
    changed = {"transactions": raw_table(spark, "transactions", [sale(6, total_amount="1", updated_at=LATER)])}
    after = raw_of(spark, BEFORE)
    work = Refresh(before, after | {"transactions": after["transactions"].unionByName(changed["transactions"])}, changed)
    assert rows(work.touched) == [("t1", 6)]
    assert work.part.raw["transaction_items"].count() == 2 and work.part.raw["transactions"].count() == 2
    assert work.recomputed("fact_sales").count() == 2
    assert before["fact_sales"].count() == 2 * (N - 1)


def test_rows_since_a_generation(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path / "zone"), {"products": CATALOG["products"]}).create()
    item = lambda i: raw_table(spark, "products", [dict(product_id=i)]).drop("_extracted_at")
    zone.append(item(1), "products")
    seen = zone.log("products").latest()
    zone.append(item(2), "products")
    assert [r.product_id for r in zone.since("products", seen).collect()] == [2]
    assert zone.since("products", 0).count() == 2
    zone.compact("products", "t1")
    with pytest.raises(Conflict):
        zone.since("products", seen)


def test_a_fact_is_refreshed_without_the_others(spark, before):
    own = Warehouse(raw_of(spark, BEFORE)).over({n: before[n] for n in ("fact_sales", "fact_promotion_usage")})
    data = {t: items for name in GROUPS[0] for t, items in CHANGES[name].items()}
    changed = {t: raw_table(spark, t, items) for t, items in data.items()}
    after = {t: df.unionByName(changed[t]) if t in changed else df for t, df in raw_of(spark, BEFORE).items()}
    work = Refresh(own, after, changed, lines="fact_sales")
    assert content(work.fact_sales()) == content(Warehouse(after)["fact_sales"])
    assert set(work._recomputed) == {"fact_sales"}


@pytest.fixture()
def beyond_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def moved(spark, before, group, fact):
    """Source tables after a change set, and a refresh of one fact from it."""
    data = {t: items for name in GROUPS[group] for t, items in CHANGES[name].items()}
    changed = {t: raw_table(spark, t, items) for t, items in data.items()}
    after = {t: df.unionByName(changed[t]) if t in changed else df for t, df in raw_of(spark, BEFORE).items()}
    return after, Refresh(before, after, changed, lines=fact, read_once=True)


@pytest.mark.parametrize("fact", ["fact_sales", "int_sales_enriched"])
def test_a_large_change_set_moves_lines_no_more_than_the_fact_does(spark, before, beyond_broadcast, fact):
    after, work = moved(spark, before, 1, fact)
    assert content(getattr(work, fact)()) == content(Warehouse(after)[fact])
    # Lines are not cut by a join of their own: they move for their newest version, transaction and product.
    assert work.part.raw["transaction_items"].count() == after["transaction_items"].count()
    plan = work.recomputed(fact)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("LeftSemi") == 2, plan  # the headers, those before and the changed ones


@pytest.mark.parametrize("fact, few", [("fact_sales", True), ("int_sales_enriched", False)])
def test_stored_rows_of_a_large_change_set(spark, before, beyond_broadcast, monkeypatch, fact, few):
    sized = refresh.sized
    monkeypatch.setattr(refresh, "sized", lambda df, purpose: (sized(df, purpose)[0], few and purpose == "untouched"))
    after, work = moved(spark, before, 0, fact)
    assert content(getattr(work, fact)()) == content(Warehouse(after)[fact])


def test_rows_without_a_key_are_left_out_whatever_the_size(spark, before, monkeypatch):
    sent = raw_table(spark, "transaction_items", [dict(item_id=None, transaction_id=6, quantity=3), line(61, 6, qty=8, updated_at=LATER)])
    after = {**raw_of(spark, BEFORE), "transaction_items": raw_of(spark, BEFORE)["transaction_items"].unionByName(sent)}
    found = []
    sized = refresh.sized
    for small in (True, False):
        monkeypatch.setattr(refresh, "sized", lambda df, purpose: (sized(df, purpose)[0], small))  # noqa: B023
        work = Refresh(before, after, {"transaction_items": sent}, lines="fact_sales", read_once=True)
        found.append(content(work.recomputed("fact_sales")))
    assert found[0] == found[1] and len(found[0]) == 2


def test_ids_stand_for_surrogate_keys(spark):
    rows_ = [("t-1", "t-1-7", "t-1--3", None), ("x", "x-70", "x-0", "x-9")]
    sent = spark.createDataFrame(rows_, "tenant_id string, sales_sk string, product_sk string, store_sk string")
    ids = refresh._with_ids(sent)
    assert rows(ids) == [("t-1", 7, -3, None), ("x", 70, 0, 9)]
    assert rows(refresh._with_keys(ids)) == rows_
