"""What one task unfolds and sorts of a reference table does not grow with the table."""

import pytest

from storelake.plans.warehouse import Warehouse
from storelake.sources import retail_star
from storelake.sources.retail_star import RetailStar, star_schema


@pytest.fixture
def folder(spark, tmp_path):
    people = [(i, f"c{i}", i % 2, 100.0 * i, "BUILDING" if i % 3 else "AUTOMOBILE") for i in range(400)]
    people += [(None, None, 0, None, None), (7, "c7", 1, 700.0, "BUILDING"), (7, "c7", 1, 700.0, "BUILDING")]
    parts = [(i, f"p{i}", "b", "t", i % 50, 10.0 + i) for i in range(400)] + [(None, None, None, None, None, None)]
    tables = {"customer": people, "part": parts, "nation": [(0, "A", 0), (1, "B", 0)], "region": [(0, "R")]}
    for name, rows in tables.items():
        spark.createDataFrame(rows, star_schema(name)).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


TABLES = ("customers", "products", "product_supplier", "inventory", "customer_loyalty")


def test_rows_are_dealt_to_tasks_and_stay_the_same(spark, folder, monkeypatch):
    star = RetailStar(spark, folder)
    before = {name: sorted(star[name].collect(), key=str) for name in TABLES}
    monkeypatch.setattr(retail_star, "SPREAD_BYTES", 512)
    for name in TABLES:
        rows = star[name].rdd.glom().collect()
        whole = sum(map(len, rows))
        assert max(map(len, rows)) <= whole / 4, name
        assert sorted((r for task in rows for r in task), key=str) == before[name], name


def test_a_small_table_is_read_as_it_is(spark, folder):
    plan = RetailStar(spark, folder)["inventory"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert Warehouse(RetailStar(spark, folder))["stg_inventory"].count() > 0
