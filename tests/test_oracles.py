"""Every registered query against its independent SQL answer."""

import pytest

import __spark_entry__ as entry_point
from compare import difference
from oracles.answers import PARTS
from oracles.compose import with_parts
from storelake.registry import registered, shown, star_warehouse
from storelake.sources.catalog import CATALOG

FOLDER = "/root/testdata/sf0.001"
QUERIES = registered()
ANSWERS = {k: v for k, v in entry_point.oracle_sql().items() if k in QUERIES}


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ANSWERS)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), FOLDER, ANSWERS[name]) == ""


@pytest.mark.parametrize("name", CATALOG)
def test_raw_table_equals_sql_and_catalog(spark, name):
    df = star_warehouse(spark, FOLDER).raw[name]
    fields = CATALOG[name].source_schema.fields
    assert [(f.name, f.dataType) for f in df.schema.fields[1:]] == [(f.name, f.dataType) for f in fields]
    kinds = {f.name: f.dataType.simpleString() for f in fields}
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c, k in kinds.items() if k.startswith("decimal")]
    casts += [f"CAST({c} AS VARCHAR) AS {c}" for c, k in kinds.items() if k == "date"]
    replaced = f" REPLACE ({', '.join(casts)})" if casts else ""
    sql = with_parts(PARTS, f"SELECT *{replaced} FROM raw_{name}")
    assert difference(shown(df), FOLDER, sql) == ""


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["year_month", "revenue"]
