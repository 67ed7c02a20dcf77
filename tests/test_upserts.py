"""Keyed upsert streams: late versions stop at the state, which survives restarts."""

import pytest

from shop import rows, ts
from storelake.sources.catalog import TableSpec, columns_of
from storelake.sources.landing import LandingZone
from storelake.streaming.changes import file_changes, streamed
from storelake.streaming.upserts import STORE, newest_changes, upsert_available

SPEC = TableSpec("notes", "id", columns_of("id long, updated_at timestamp?, note string?"), tie_break=("note",))
LAYOUT = "tenant_id string, id long, updated_at timestamp, note string"


@pytest.fixture()
def zone(spark, tmp_path):
    return LandingZone(spark, str(tmp_path / "zone"), {"notes": SPEC}).create()


def write(spark, path, *items):
    data = [(t, i, a and ts(a), n) for t, i, a, n in items]
    spark.createDataFrame(data, LAYOUT).coalesce(1).write.mode("append").parquet(path)


def changes(spark, source):
    return file_changes(spark, source, spark.createDataFrame([], LAYOUT).schema)


def landed(zone):
    return sorted(rows(streamed(zone, "notes").select("tenant_id", "id", "note")), key=repr)


def test_only_newer_versions_land_and_the_state_survives_restarts(spark, zone, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    before = spark.conf.get(STORE, None)
    write(spark, source, ("a", 1, "2024-01-02", "m"), ("a", 1, "2024-01-01", "x"), ("b", 1, "2024-01-01", "b"), ("a", 3, None, "n"))
    upsert_available(changes(spark, source), zone, "notes", state)
    first = [("a", 1, "m"), ("a", 3, "n"), ("b", 1, "b")]
    assert landed(zone) == first
    # Nothing new; then older, equal and repeated versions by the same checkpoint.
    upsert_available(changes(spark, source), zone, "notes", state)
    write(spark, source, ("a", 1, "2024-01-01", "z"), ("a", 1, "2024-01-02", "m"), ("a", 1, "2024-01-02", "l"), ("a", 3, None, None))
    upsert_available(changes(spark, source), zone, "notes", state)
    assert landed(zone) == first
    # The tie-break, a later stamp, a stamp after none, and a new key are newer.
    write(spark, source, ("a", 1, "2024-01-02", "n"), ("b", 1, "2024-01-03", None), ("a", 3, "2020-01-01", "s"), ("c", 9, None, None))
    upsert_available(changes(spark, source), zone, "notes", state)
    assert landed(zone) == sorted([*first, ("a", 1, "n"), ("b", 1, None), ("a", 3, "s"), ("c", 9, None)], key=repr)
    assert sorted(rows(zone.current("notes").select("tenant_id", "id", "note")), key=repr) == sorted(
        [("a", 1, "n"), ("a", 3, "s"), ("b", 1, None), ("c", 9, None)], key=repr
    )
    assert spark.conf.get(STORE, None) == before


def test_no_row_or_key_passes_through_python(spark, tmp_path):
    source = str(tmp_path / "in")
    write(spark, source, ("a", 1, "2024-01-02", "m"))
    plan = newest_changes(changes(spark, source), SPEC)._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan and "Python" not in plan


def test_one_batch_lands_one_row_a_key(spark, zone, tmp_path):
    source = str(tmp_path / "in")
    # Repeats of the newest version, and null stamps and notes.
    write(spark, source, *[("a", 1, "2024-01-02", "m")] * 3, ("a", 1, "2024-01-02", None), ("a", 1, None, "z"))
    write(spark, source, ("b", 2, None, None), ("b", 2, None, None), ("a", 2, "2024-01-01", None))
    upsert_available(changes(spark, source), zone, "notes", str(tmp_path / "state"))
    assert landed(zone) == sorted([("a", 1, "m"), ("b", 2, None), ("a", 2, None)], key=repr)
