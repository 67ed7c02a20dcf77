import pytest

from shop import rows, ts
from storelake.operators.extract import incremental_extract
from storelake.sources import changes
from storelake.sources.catalog import TableSpec, columns_of
from storelake.sources.changes import ChangeReader, tenant_changes
from storelake.sources.landing import LandingZone
from storelake.streaming.changes import ingest_available

SPEC = TableSpec("notes", "id", columns_of("id long, updated_at timestamp, note string?"))
LAYOUT = "tenant_id string, id long, updated_at timestamp, note string, tenant string"


@pytest.fixture()
def zone(spark, tmp_path):
    return LandingZone(spark, str(tmp_path / "zone"), {"notes": SPEC}).create()


def export(spark, path, *items):
    data = [(t, i, a and ts(a), n, "x") for t, i, a, n in items]
    spark.createDataFrame(data, LAYOUT).write.mode("append").partitionBy("tenant_id").parquet(str(path))


def run(spark, zone, path, state):
    """Rows that one run lands, and all newest rows."""
    before = zone["notes"].count()
    ingest_available(tenant_changes(spark, str(path), SPEC), zone, "notes", str(state))
    newest = zone.current("notes").select("tenant_id", "id", "note")
    return zone["notes"].count() - before, sorted(rows(newest))


def test_resumes_from_each_tenants_watermark(spark, zone, tmp_path):
    source, state = tmp_path / "in", tmp_path / "state"
    export(spark, source, ("a", 1, "2024-01-02", "a1"), ("b", 1, "2024-03-01", "b1"), ("a", 2, None, "never"))
    assert run(spark, zone, source, state) == (2, [("a", 1, "a1"), ("b", 1, "b1")])
    assert run(spark, zone, source, state)[0] == 0
    # New rows of a are older than b's watermark; one late row of b and one equal to it stay out.
    export(
        spark, source, ("a", 1, "2024-01-03", "a1 new"), ("a", 3, "2024-02-01", None),
        ("b", 2, "2024-02-28", "late"), ("b", 3, "2024-03-01", "equal"), ("c d", 1, "2023-01-01", "c"),
    )
    landed, newest = run(spark, zone, source, state)
    assert landed == 3 and newest == [("a", 1, "a1 new"), ("a", 3, None), ("b", 1, "b1"), ("c d", 1, "c")]


def test_equals_the_incremental_extract(spark, zone, tmp_path):
    source, state = tmp_path / "in", tmp_path / "state"
    first = [("ab"[i % 2], i, f"2024-01-{1 + i % 9:02}", str(i)) for i in range(40)]
    later = [("abc"[i % 3], i, f"2024-01-{3 + i % 20:02}", f"{i} again") for i in range(60)]
    export(spark, source, *first)
    run(spark, zone, source, state)
    marks = zone["notes"].groupBy("tenant_id").agg({"updated_at": "max"}).toDF("tenant_id", "watermark").collect()
    export(spark, source, *later)
    old = sorted(rows(zone["notes"].select("tenant_id", "id", "updated_at")))
    run(spark, zone, source, state)
    everything = spark.read.parquet(str(source)).select("tenant_id", "id", "updated_at")
    want = rows(incremental_extract(everything, spark.createDataFrame(marks)))
    assert sorted(rows(zone["notes"].select("tenant_id", "id", "updated_at"))) == sorted(old + want)


def test_an_empty_folder_and_a_null_tenant(spark, zone, tmp_path):
    source, state = tmp_path / "in", tmp_path / "state"
    source.mkdir()
    assert run(spark, zone, source, state) == (0, [])
    export(spark, source, (None, 1, "2024-01-01", "nobody's"))
    reader = ChangeReader(str(source), "updated_at", tenant_changes(spark, str(source), SPEC).schema)
    (part,) = reader.partitions({}, reader.latestOffset())
    assert [r["note"] for b in reader.read(part) for r in b.to_pylist()] == ["nobody's"]
    assert [r["tenant_id"] for b in reader.read(part) for r in b.to_pylist()] == [None]


def test_only_row_groups_in_the_interval_are_read(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    table = spark.range(100).selectExpr(
        "'a' tenant_id", "id", "timestamp_micros(id + 1) updated_at", "string(id) note"
    )
    import pyarrow.parquet as pq

    (source / "tenant_id=a").mkdir(parents=True)
    pq.write_table(table.orderBy("id").toArrow().drop_columns("tenant_id"), source / "tenant_id=a" / "x.parquet", row_group_size=10)
    monkeypatch.setattr(changes, "ROWS_PER_TASK", 20)
    reader = ChangeReader(str(source), "updated_at", tenant_changes(spark, str(source), SPEC).schema)
    assert reader.latestOffset() == {"a": 100}
    parts = reader.partitions({"a": 55}, {"a": 100})
    assert [p.groups for p in parts] == [[5, 6], [7, 8], [9]]
    ids = [r["id"] for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert ids == list(range(55, 100))
    assert [p.groups for p in reader.partitions({"a": 100}, {"a": 100})] == [[]]
