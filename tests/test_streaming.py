import shutil

import pytest

from shop import rows, ts
from storelake.sources.catalog import TableSpec, columns_of
from storelake.sources.landing import LandingZone
from storelake.streaming.changes import file_changes, ingest_available, streamed

SPEC = TableSpec("notes", "id", columns_of("id long, updated_at timestamp, note string?"))
LAYOUT = "tenant_id string, id long, updated_at timestamp, note string"


@pytest.fixture()
def zone(spark, tmp_path):
    return LandingZone(spark, str(tmp_path / "zone"), {"notes": SPEC}).create()


def write(spark, path, *items):
    data = [(t, i, ts(a), n) for t, i, a, n in items]
    spark.createDataFrame(data, LAYOUT).coalesce(1).write.mode("append").parquet(path)


def ingest(spark, zone, source, checkpoint):
    ingest_available(file_changes(spark, str(source), spark.createDataFrame([], LAYOUT).schema), zone, "notes", str(checkpoint))
    return sorted(rows(zone.current("notes").select("tenant_id", "id", "note")))


def test_restartable_ingest_and_newest_rows(spark, zone, tmp_path):
    source, state = str(tmp_path / "in"), tmp_path / "state"
    write(spark, source, ("a", 1, "2024-01-02", "new"), ("b", 1, "2024-01-01", "b"))
    assert len(ingest(spark, zone, source, state)) == 2
    assert len(ingest(spark, zone, source, state)) == 2
    # A late, older version arrives after the newer one.
    write(spark, source, ("a", 1, "2024-01-01", "old"), ("a", 2, "2024-01-01", "two"))
    assert ingest(spark, zone, source, state) == [("a", 1, "new"), ("a", 2, "two"), ("b", 1, "b")]
    assert streamed(zone, "notes").count() == 4


def test_two_streams_into_one_table_keep_each_others_rows(spark, zone, tmp_path):
    write(spark, str(tmp_path / "one"), ("a", 1, "2024-01-01", "x"))
    write(spark, str(tmp_path / "two"), ("a", 2, "2024-01-01", "y"))
    ingest(spark, zone, tmp_path / "one", tmp_path / "s1")
    assert ingest(spark, zone, tmp_path / "two", tmp_path / "s2") == [("a", 1, "x"), ("a", 2, "y")]


def test_a_lost_checkpoint_loses_nothing(spark, zone, tmp_path):
    source = str(tmp_path / "in")
    write(spark, source, ("a", 1, "2024-01-01", "x"), ("a", 2, "2024-01-01", "y"))
    ingest(spark, zone, source, tmp_path / "s1")
    # Everything still there comes again and collapses; with the old files gone, their rows stay.
    assert ingest(spark, zone, source, tmp_path / "s2") == [("a", 1, "x"), ("a", 2, "y")]
    shutil.rmtree(source)
    write(spark, source, ("a", 3, "2024-01-01", "z"))
    assert ingest(spark, zone, source, tmp_path / "s3") == [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z")]


def test_streamed_and_batch_rows_are_one_table(spark, zone, tmp_path):
    write(spark, str(tmp_path / "in"), ("a", 1, "2024-01-02", "streamed"))
    ingest(spark, zone, tmp_path / "in", tmp_path / "s")
    batch = spark.createDataFrame([("a", 1, ts("2024-01-01"), "older"), ("b", 9, ts("2024-01-01"), "batch")], LAYOUT)
    zone.append(batch, "notes")
    assert sorted(rows(zone.current("notes").select("id", "note"))) == [(1, "streamed"), (9, "batch")]
