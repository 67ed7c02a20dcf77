"""A bucketed base with a delta holds what all versions hold, and only the delta moves."""

import datetime
import re

import pytest

from shop import raw_table, rows, ts
from storelake.operators import loads
from storelake.plans.warehouse import Warehouse
from storelake.sources.bases import Bases
from storelake.sources.catalog import CATALOG
from storelake.sources.landing import LandingZone
from test_loads import TABLES, suppliers

NOW = datetime.datetime(2024, 5, 1, tzinfo=datetime.timezone.utc)


@pytest.fixture()
def bases(spark, tmp_path):
    return Bases(LandingZone(spark, str(tmp_path / "zone"), TABLES).create(), "bases_test")


def newest(frame):
    return sorted(rows(frame.select("tenant_id", "supplier_id", "supplier_name")))


def same(bases):
    found = newest(bases.current("suppliers"))
    assert found == newest(bases.zone.current("suppliers"))
    return found


def test_base_and_delta_equal_all_versions(spark, bases):
    zone = bases.zone
    assert bases.current("suppliers").count() == 0 and bases.latest("suppliers") is None
    zone.append(suppliers(spark, ("a", 1, "v1", "2024-01-01"), ("a", 2, "v5", "2024-01-05"), ("b", 1, "x", "2024-01-01")), "suppliers")
    assert bases.build("suppliers", 4).buckets == 4
    assert same(bases) == [("a", 1, "v1"), ("a", 2, "v5"), ("b", 1, "x")]
    # A newer version, an older one that comes late, an equal one, a new key and a new tenant.
    zone.append(suppliers(spark, ("a", 1, "v2", "2024-01-02"), ("a", 2, "late", "2024-01-04"), ("b", 1, "again", "2024-01-01"), ("b", 7, "y", "2024-01-01"), ("c", 1, "z", "2024-01-01")), "suppliers")
    state = [("a", 1, "v2"), ("a", 2, "v5"), ("b", 1, "again"), ("b", 7, "y"), ("c", 1, "z")]
    assert same(bases) == state
    # The next base is made from the last one and the delta.
    assert bases.build("suppliers", 4).generation.number == 2 and same(bases) == state
    bases.clear("suppliers", keep=1)
    assert same(bases) == state


def test_tenants_that_were_replaced_or_compacted_do_not_use_the_base(spark, bases):
    zone = bases.zone
    zone.append(suppliers(spark, ("a", 1, "old", "2024-01-09"), ("b", 1, "x", "2024-01-01"), ("c", 1, "z", "2024-01-01")), "suppliers")
    bases.build("suppliers", 3)
    loads.full_load(zone, {"suppliers": suppliers(spark, ("a", 2, "new", "2024-01-01"))}, ["a", "c"])
    assert same(bases) == [("a", 2, "new"), ("b", 1, "x")]
    zone.compact("suppliers", "b")
    assert same(bases) == [("a", 2, "new"), ("b", 1, "x")]


def test_another_session_reads_the_bucketing(spark, bases):
    bases.zone.append(suppliers(spark, ("a", 1, "x", "2024-01-01")), "suppliers")
    bases.build("suppliers", 4)
    spark.sql("DROP DATABASE bases_test CASCADE")
    assert same(bases) == [("a", 1, "x")]


def depth_first(plan):
    """(depth, text) of the nodes of a printed plan."""
    return [(len(re.match(r"[\s:+|-]*", line).group()), line) for line in plan.splitlines() if line.strip()]


def test_only_the_delta_is_exchanged(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path / "zone"), {n: CATALOG[n] for n in CATALOG}).create()
    bases = Bases(zone, "bases_plan")
    lines = lambda day, n: raw_table(
        spark, "transaction_items", [dict(tenant_id="a", item_id=i, transaction_id=i, product_id=1, quantity=n, updated_at=ts(day)) for i in range(50)]
    ).drop("_extracted_at")
    zone.append(lines("2024-01-01", 1), "transaction_items")
    bases.build("transaction_items", 4)
    zone.append(lines("2024-01-02", 2).limit(5), "transaction_items")
    staged = Warehouse(bases)["stg_transaction_items"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = staged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    above, open_nodes = None, []
    for depth, text in depth_first(plan):
        open_nodes = [(d, t) for d, t in open_nodes if d < depth]
        if "base_transaction_items" in text:
            above = [t for _, t in open_nodes]
            assert "Bucketed: true" in text
        open_nodes.append((depth, text))
    assert above and any("Join" in t for t in above) and not any("Exchange" in t for t in above)
    assert plan.count("Exchange hashpartitioning") >= 1
    assert sorted(r["quantity"] for r in staged.select("quantity").collect()) == [1] * 45 + [2] * 5
