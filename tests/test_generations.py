"""Table generations: atomic writes, readers that keep their rows, and what may be deleted."""

import datetime
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PythonException

from shop import rows
from storelake.operators import loads
from storelake.session import names_in, publish, read_text
from storelake.sources.generations import Conflict, Generation, GenerationLog
from storelake.sources.landing import LandingZone
from test_loads import TABLES, landed, suppliers

NOW = datetime.datetime(2024, 5, 1, tzinfo=datetime.timezone.utc)
ALL_AGES = datetime.timedelta(seconds=-60)


@pytest.fixture()
def zone(spark, tmp_path):
    return LandingZone(spark, str(tmp_path / "zone"), TABLES).create()


def one(spark, tenant, key, name):
    return suppliers(spark, (tenant, key, name, "2024-01-01"))


def test_a_name_is_published_once(spark, tmp_path):
    path = f"{tmp_path}/names/1.json"
    assert publish(spark, path, "first") and not publish(spark, path, "second")
    assert read_text(spark, path) == "first"
    assert names_in(spark, f"{tmp_path}/names") == ["1.json"] and names_in(spark, f"{tmp_path}/none") == []


def test_a_writer_that_was_too_slow_builds_on_the_faster_one(spark, tmp_path, monkeypatch):
    log = GenerationLog(spark, str(tmp_path / "log"))
    slow = log.latest()
    log.commit(lambda g: g.adding("fast", ["t"]))
    seen = iter([slow, log.latest()])
    monkeypatch.setattr(log, "latest", lambda: next(seen))
    done = log.commit(lambda g: g.adding("slow", ["t"]))
    assert (done.number, done.segments) == (2, {"t": ("fast", "slow")})
    assert log.read(2) == done and log.numbers() == [1, 2]


def test_writers_side_by_side_lose_nothing(spark, zone):
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: zone.append_tenant(one(spark, "ab"[i % 2], i, "x").drop("tenant_id"), "suppliers", "ab"[i % 2]), range(12)))
    assert landed(zone) == sorted(("ab"[i % 2], i, "x") for i in range(12))
    assert zone.log("suppliers").latest().number == 12


def test_a_full_load_removes_streamed_rows_of_its_tenants(spark, zone):
    zone.append_batch(suppliers(spark, ("a", 1, "s", "2024-01-01"), ("a", 2, "s", "2024-01-01"), ("b", 3, "s", "2024-01-01")), "suppliers", "s", 0)
    loads.full_load(zone, {"suppliers": one(spark, "a", 9, "full")}, ["a"])
    assert rows(zone["suppliers"].select("tenant_id", "supplier_id").orderBy("supplier_id")) == [("b", 3), ("a", 9)]
    # The stream goes on behind the full load, and its old batch does not come back.
    for batch in (0, 1):
        zone.append_batch(one(spark, "a", 10, "s"), "suppliers", "s", batch)
    assert landed(zone) == [("a", 9, "full"), ("a", 10, "s"), ("b", 3, "s")]


def test_a_reader_keeps_the_generation_it_started_with(spark, zone):
    zone.append(one(spark, "a", 1, "old"), "suppliers")
    before = zone["suppliers"]
    loads.full_load(zone, {"suppliers": one(spark, "a", 2, "new")}, ["a"])
    zone.append(one(spark, "a", 3, "later"), "suppliers")
    zone.compact("suppliers", "a")
    assert [r.supplier_name for r in before.collect()] == ["old"]
    assert [r.supplier_name for r in zone.at("suppliers", 1).collect()] == ["old"]
    assert landed(zone) == [("a", 2, "new"), ("a", 3, "later")]


def test_a_dead_writer_leaves_nothing_visible(spark, zone):
    zone.append(one(spark, "a", 1, "x"), "suppliers")

    def dies(batches):
        for batch in batches:
            yield batch
        raise RuntimeError("lost")

    broken = one(spark, "a", 2, "y").union(one(spark, "b", 3, "z"))
    broken = broken.mapInArrow(dies, broken.schema)
    for write in (zone.append, lambda df, name: zone.replace_tenants(df, name, ["a", "b"], NOW)):
        with pytest.raises(PythonException, match="lost"):
            write(broken, "suppliers")
    assert landed(zone) == [("a", 1, "x")] and zone.log("suppliers").latest().number == 1


def test_a_full_load_wins_over_a_compaction(spark, zone, monkeypatch):
    zone.append(one(spark, "a", 1, "x"), "suppliers")
    plain = zone._written

    def slow(df, name):
        out = plain(df, name)
        monkeypatch.setattr(zone, "_written", plain)
        loads.full_load(zone, {"suppliers": one(spark, "a", 2, "full")}, ["a"])
        return out

    monkeypatch.setattr(zone, "_written", slow)
    with pytest.raises(Conflict):
        zone.compact("suppliers", "a")
    assert landed(zone) == [("a", 2, "full")]


def test_rows_that_land_during_a_compaction_stay():
    generation = Generation(3, {"t": ("s1", "s2", "s3"), "u": ("s1",)})
    merged = generation.merging("t", ("s1", "s2"), "new")
    assert merged.segments == {"t": ("new", "s3"), "u": ("s1",)}


def test_clearing_removes_what_no_recent_generation_shows(spark, zone):
    for key in range(3):
        loads.full_load(zone, {"suppliers": one(spark, "a", key, "x")}, ["a"])
    zone.spark.range(1).write.parquet(f"{zone.path('suppliers')}/_segment=orphan")
    assert zone.clear("suppliers") == []  # all are younger than a day
    gone = zone.clear("suppliers", keep=2, age=ALL_AGES)
    assert len(gone) == 2 and "_segment=orphan" in gone
    assert zone.log("suppliers").numbers() == [2, 3]
    assert landed(zone) == [("a", 2, "x")] and zone.at("suppliers", 2).count() == 1


def test_loads_without_rows_commit_nothing(spark, zone):
    zone.append(suppliers(spark), "suppliers")
    zone.append_tenant(suppliers(spark).drop("tenant_id"), "suppliers", "a")
    assert zone.log("suppliers").latest() == Generation() and zone["suppliers"].count() == 0
