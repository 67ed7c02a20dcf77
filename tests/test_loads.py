import datetime
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from shop import raw_table, rows, ts
from storelake.operators import extract, loads
from storelake.session import scratch
from storelake.sources.catalog import CATALOG, spec_of
from storelake.sources.generations import GenerationLog
from storelake.sources.landing import LandingZone
from storelake.sources.readers import Tenant, parquet_source, read_tenants

TABLES = {n: CATALOG[n] for n in ("suppliers", "stores", "customers")}


@pytest.fixture()
def zone(spark, tmp_path):
    return LandingZone(spark, str(tmp_path / "zone"), TABLES).create()


def suppliers(spark, *items):
    """(tenant, id, name, updated_at)"""
    data = [dict(tenant_id=t, supplier_id=i, supplier_name=n, updated_at=ts(u)) for t, i, n, u in items]
    return raw_table(spark, "suppliers", data).drop("_extracted_at")


def landed(zone, name="suppliers"):
    return sorted(rows(zone.current(name).select("tenant_id", "supplier_id", "supplier_name")))


def test_tenant_column_leads_the_union(spark):
    a = spark.createDataFrame([(1,)], "id long")
    got = extract.tenant_union({"x": a, "y": a})
    assert got.columns == ["tenant_id", "id"] and sorted(rows(got)) == [("x", 1), ("y", 1)]


def test_conform_keeps_catalog_columns_and_types(spark):
    spec = spec_of("transaction_promotions")
    df = spark.createDataFrame(
        [(1, 2, 3, 1.239, "x", ts("2024-01-01"), ts("2024-01-01"))],
        "id int, transaction_id int, promo_id int, discount_applied double, extra string,"
        " created_at timestamp, updated_at timestamp",
    )
    out = extract.conformed(df, spec)
    assert out.schema.names == spec.column_names
    assert [f.dataType for f in out.schema] == [f.dataType for f in spec.source_schema]
    assert str(out.first().discount_applied) == "1.24"


def test_create_keeps_existing_rows(spark, zone):
    zone.append(suppliers(spark, ("a", 1, "x", "2024-01-01")), "suppliers")
    zone.create()
    assert landed(zone) == [("a", 1, "x")]
    assert zone["stores"].count() == 0


def test_full_load_replaces_only_its_tenants_even_with_nothing(spark, zone):
    start = suppliers(spark, ("a", 1, "x", "2024-01-01"), ("b", 1, "y", "2024-01-01"), ("c", 1, "z", "2024-01-01"))
    loads.full_load(zone, {"suppliers": start}, ["a", "b", "c"])
    again = suppliers(spark, ("b", 2, "new", "2024-01-02"), ("c", 9, "ignored", "2024-01-02"))
    audit = loads.full_load(zone, {"suppliers": again}, ["a", "b"])
    assert landed(zone) == [("b", 2, "new"), ("c", 1, "z")]
    assert sorted(rows(audit)) == [
        ("ALL", "ALL", 1),
        ("a", "ALL", 0),
        ("a", "suppliers", 0),
        ("b", "ALL", 1),
        ("b", "suppliers", 1),
    ]


def test_full_load_skips_unknown_tables_with_a_warning(spark, zone, caplog):
    frames = {"suppliers": suppliers(spark, ("a", 1, "x", "2024-01-01"))}
    loads.full_load(zone, frames, ["a"], tables=["nope", "suppliers"])
    assert "skipping unknown table: nope" in caplog.text
    assert landed(zone) == [("a", 1, "x")]


def test_watermark_is_epoch_when_missing_and_per_tenant(zone):
    zone.set_watermarks([("a", "suppliers", ts("2024-03-01T10:00:00.750"))])
    zone.set_watermarks([("a", "suppliers", ts("2024-02-01"))])
    assert zone.watermark("a", "suppliers") == ts("2024-03-01T10:00:00")
    assert zone.watermark("b", "suppliers") == extract.EPOCH
    assert zone.watermark("a", "stores") == extract.EPOCH


def test_watermark_not_after_1970_reads_as_epoch(spark):
    log = spark.createDataFrame([("a", "s", ts("1970-05-05"))], "tenant_id string, table_name string, watermark timestamp")
    assert extract.watermark_state(log, log).first().watermark == extract.EPOCH


def test_incremental_extract_is_strict_and_keeps_unmoved_watermarks(spark):
    df = suppliers(
        spark,
        ("a", 1, "at", "2024-01-02T00:00:00"),
        ("a", 2, "above", "2024-01-02T00:00:00.000001"),
        ("a", 3, "below", "2024-01-01T23:59:59"),
        ("new", 4, "no state", "2020-01-01"),
    )
    state = spark.createDataFrame(
        [("a", ts("2024-01-02")), ("idle", ts("2024-01-05"))], "tenant_id string, watermark timestamp"
    )
    pulled = extract.incremental_extract(df, state)
    assert sorted(r.supplier_name for r in pulled.collect()) == ["above", "no state"]
    assert sorted(rows(extract.advanced_watermarks(pulled, state))) == [
        ("a", 1, ts("2024-01-02T00:00:00.000001")),
        ("idle", 0, ts("2024-01-05")),
        ("new", 1, ts("2020-01-01")),
    ]


def test_watermark_filter_reaches_the_file_scan(spark, tmp_path):
    path = str(tmp_path / "src")
    suppliers(spark, ("a", 1, "x", "2024-01-01")).drop("tenant_id").write.parquet(path)
    df = extract.changed_since(
        parquet_source(spark, path, spec_of("suppliers")), "updated_at", ts("2024-01-01")
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at" in plan


def source_of(frames):
    def source(tenant, name):
        df = frames[name]
        if isinstance(df, Exception):
            raise df
        return df.filter(df.tenant_id == tenant).drop("tenant_id")

    return source


def test_incremental_runs_are_repeatable_and_miss_late_commits(spark, zone):
    first = suppliers(spark, ("a", 1, "v1", "2024-01-01"), ("b", 1, "other", "2024-01-01"))
    second = first.union(suppliers(spark, ("a", 1, "v2", "2024-01-03"), ("a", 2, "two", "2024-01-02")))
    late = second.union(suppliers(spark, ("a", 3, "late", "2024-01-02T12:00:00")))
    run = lambda df, **o: loads.incremental_load(
        zone, source_of({"suppliers": df}), ["a", "b"], ["suppliers"], **o
    )
    assert [x.rows for x in run(first)] == [1, 1]
    assert [x.rows for x in run(second)] == [2, 0]
    state = [("a", 1, "v2"), ("a", 2, "two"), ("b", 1, "other")]
    assert landed(zone) == state
    assert [x.rows for x in run(second)] == [0, 0]
    run(late)
    assert landed(zone) == state
    run(late, lookback=datetime.timedelta(days=1))
    assert landed(zone) == sorted([*state, ("a", 3, "late")])


def test_compaction_keeps_the_state_and_other_tenants(spark, zone):
    zone.append(suppliers(spark, ("a", 1, "v1", "2024-01-01"), ("b", 1, "x", "2024-01-01")), "suppliers")
    zone.append(suppliers(spark, ("a", 1, "v2", "2024-01-02"), ("b", 1, "y", "2024-01-02")), "suppliers")
    before = landed(zone)
    zone.compact("suppliers", "a")
    assert landed(zone) == before == [("a", 1, "v2"), ("b", 1, "y")]
    assert sorted(rows(zone["suppliers"].groupBy("tenant_id").count())) == [("a", 1), ("b", 2)]


def stores(spark):
    return raw_table(
        spark, "stores", [dict(tenant_id=t, store_id=1, updated_at=ts("2024-02-02")) for t in "ab"]
    ).drop("_extracted_at")


@pytest.mark.parametrize("commit", ["tenant", "table"])
def test_commit_modes_after_a_failure(spark, zone, commit):
    frames = {
        "suppliers": suppliers(spark, ("a", 1, "x", "2024-01-01"), ("b", 1, "y", "2024-01-01")),
        "customers": raw_table(spark, "customers", []).drop("_extracted_at"),
        "stores": stores(spark),
    }

    def source(tenant, name):
        if (tenant, name) == ("a", "customers"):
            raise ConnectionError("down")
        return source_of(frames)(tenant, name)

    order = ["suppliers", "customers", "stores"]
    done = loads.incremental_load(zone, source, ["a", "b"], order, commit=commit, raise_failures=False)
    assert loads.failed_tenants(done) == ["a"]
    marks = {(r.tenant_id, r.table_name): r.watermark for r in zone.watermarks(["a", "b"], order).collect()}
    assert marks["b", "suppliers"] == ts("2024-01-01") and marks["b", "stores"] == ts("2024-02-02")
    assert marks["a", "customers"] == marks["b", "customers"] == extract.EPOCH
    if commit == "tenant":  # all tables tried, nothing committed
        assert [x.table_name for x in done if x.tenant_id == "a"] == order
        assert marks["a", "suppliers"] == marks["a", "stores"] == extract.EPOCH
    else:  # stopped at the failure, earlier table committed
        assert [x.table_name for x in done if x.tenant_id == "a"] == order[:2]
        assert marks["a", "suppliers"] == ts("2024-01-01")
        assert marks["a", "stores"] == extract.EPOCH
    report = loads.report(zone, done)
    assert report.filter("error is not null").count() == 1


def test_a_failed_tenant_raises_after_the_others_committed(spark, zone):
    frames = {"suppliers": suppliers(spark, ("b", 1, "y", "2024-01-01"))}

    def source(tenant, name):
        if tenant == "a":
            raise ConnectionError("down")
        return source_of(frames)(tenant, name)

    with pytest.raises(loads.LoadFailed, match="a.suppliers: down"):
        loads.incremental_load(zone, source, ["a", "b"], ["suppliers"])
    assert zone.watermark("b", "suppliers") == ts("2024-01-01")


def test_extract_cut_offs_reach_the_file_scan(spark, tmp_path):
    path = str(tmp_path / "all")
    df = suppliers(spark, ("a", 1, "x", "2024-01-01"), ("b", 1, "y", "2024-01-01"))
    df.write.parquet(path)
    state = spark.createDataFrame([("a", ts("2023-05-06")), ("b", ts("2023-07-08"))], "tenant_id string, watermark timestamp")
    pulled = extract.incremental_extract(spark.read.schema(df.schema).parquet(path), state)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = pulled._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(updated_at,2023-05-06" in plan and "GreaterThan(updated_at,2023-07-08" in plan
    assert pulled.count() == 2


def test_an_interrupted_compaction_loses_nothing(spark, zone, monkeypatch):
    for name, day in (("v1", "2024-01-01"), ("v2", "2024-01-02")):
        zone.append(suppliers(spark, ("a", 1, name, day), ("a", 2, "other", day)), "suppliers")

    def dies(log, change):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(GenerationLog, "commit", dies)
        with pytest.raises(OSError):
            zone.compact("suppliers", "a")
    assert zone["suppliers"].count() == 4
    zone.compact("suppliers", "a")
    assert landed(zone) == [("a", 1, "v2"), ("a", 2, "other")]
    assert zone["suppliers"].count() == 2


def test_scratch_is_empty_after_its_block(spark):
    with scratch(spark, "block") as path:
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_catalog_tables_show_all_landed_rows(spark, zone):
    zone.append(suppliers(spark, ("a", 1, "x", "2024-01-01")), "suppliers")
    zone.append_batch(suppliers(spark, ("a", 2, "streamed", "2024-01-01"), ("b", 1, "y", "2024-01-01")), "suppliers", "s", 0)
    zone.registered("pos_test")
    shown = spark.table("pos_test.suppliers")
    assert shown.columns == spec_of("suppliers").raw_schema.names and shown.count() == 3
    assert spark.table("pos_test.stores").count() == 0
    loads.full_load(zone, {"suppliers": suppliers(spark, ("a", 9, "only", "2024-01-02"))}, ["a"])
    zone.registered("pos_test")
    assert sorted(r.supplier_name for r in spark.table("pos_test.suppliers").collect()) == ["only", "y"]
    spark.sql("DROP DATABASE pos_test CASCADE")
    assert landed(zone) == [("a", 9, "only"), ("b", 1, "y")]


# The repeated hour of an autumn night: 05:30 and 06:10 UTC are both 01:xx in New York.
_SUMMER_TIME = """
import sys
sys.path[:0] = [{root!r}, {tests!r}]
from pyspark.sql import functions as F
from storelake.operators import loads
from storelake.session import local_session
from storelake.sources.catalog import CATALOG
from storelake.sources.generations import GenerationLog
from storelake.sources.landing import LandingZone
spark = local_session(2, "zones", **{{"spark.sql.warehouse.dir": {folder!r}}})
spec = CATALOG["suppliers"]
zone = LandingZone(spark, {folder!r} + "/zone", {{"suppliers": spec}}).create()
def at(*minutes):
    stamp = lambda m: F.expr(f"timestamp'2024-11-03 05:00:00' + make_interval(0, 0, 0, 0, 0, {{m}})")
    frames = [spark.range(1).select(*[
        (stamp(m) if f.name == spec.version else F.lit(m) if f.name == spec.key else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in spec.source_schema.fields]) for m in minutes]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
loads.incremental_load(zone, lambda t, n: at(30), ["a"], ["suppliers"])
loads.incremental_load(zone, lambda t, n: at(30, 70), ["a"], ["suppliers"])
print("LANDED", zone["suppliers"].count())
"""


def test_watermarks_survive_a_zone_with_summer_time(tmp_path):
    tests = Path(__file__).resolve().parent
    code = _SUMMER_TIME.format(root=str(tests.parent), tests=str(tests), folder=str(tmp_path))
    env = os.environ | {"TZ": "America/New_York"}
    ran = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "LANDED 2" in ran.stdout, ran.stderr[-2000:]


def test_tenant_config(spark, tmp_path):
    path = tmp_path / "tenants.json"
    path.write_text(json.dumps({"tenants": [{"tenant_id": "a", "schema": "s", "display_name": "A"}]}, indent=2))
    assert read_tenants(spark, str(path)) == [Tenant("a", "s", "A")]
    path.write_text('{"tenants": []}')
    with pytest.raises(ValueError, match="no tenants"):
        read_tenants(spark, str(path))


def test_tenant_ids_must_be_folder_names(zone):
    with pytest.raises(ValueError):
        zone.append_tenant(suppliers(zone.spark), "suppliers", "../x")
