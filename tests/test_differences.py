"""Range checksums name the rows that differ and read only their ranges."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from storelake.operators import differences

SCHEMA = "tenant_id string, id long, a string, b double"
COLUMNS = ["id", "a", "b"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(left, right):
    bags = [{}, {}]
    for bag, rows in zip(bags, (left, right)):
        for r in rows:
            bag.setdefault(r[:2], Counter())[r] += 1
    out = set()
    for key in bags[0].keys() | bags[1].keys():
        a, b = bags[0].get(key, Counter()), bags[1].get(key, Counter())
        if a != b:
            kind = "lost" if not b else "extra" if not a else "changed"
            out.add((*key, kind, sum(a.values()), sum(b.values())))
    return out


def rows_of(rng, n):
    return [(f"t{rng.randrange(3)}", rng.randrange(-500, 5000), rng.choice(["x", "y", "", None]), rng.choice([None, 1.5, 2.0])) for _ in range(n)]


@pytest.mark.parametrize("pushed", [200, 0])
def test_lost_changed_and_extra_keys_equal_brute_force(spark, monkeypatch, pushed):
    monkeypatch.setattr(differences, "PUSHED_SPANS", pushed)
    rng = random.Random(3)
    left = rows_of(rng, 1500) + [(None, 5, "x", 1.0), ("t0", None, "x", 1.0), ("t0", None, "y", None), (None, None, None, None)]
    right = [r for r in left if rng.random() > 0.01]
    right += [("t0", 9000, "new", None), ("t1", None, "x", 1.0), *left[:2]]
    right = [(*r[:2], "z", r[3]) if rng.random() < 0.01 else r for r in right]
    rng.shuffle(right)
    found = differences.row_differences(frame(spark, left), frame(spark, right).repartition(5), "id", COLUMNS, width=16, fanout=4)
    assert {tuple(r) for r in found.collect()} == brute(left, right)
    same = differences.row_differences(frame(spark, left), frame(spark, left).repartition(3), "id", COLUMNS, width=10)
    assert same.count() == 0


def test_null_and_its_neighbour_are_told_apart(spark):
    left, right = [("t", 1, None, 1.0), ("t", 2, "", None)], [("t", 1, "", 1.0), ("t", 2, None, None)]
    found = differences.row_differences(frame(spark, left), frame(spark, right), "id", COLUMNS)
    assert {tuple(r) for r in found.collect()} == brute(left, right)


def test_empty_copies(spark):
    some = [("t", 1, "x", None), ("t", 1, "x", None)]
    found = differences.row_differences(frame(spark, some), frame(spark, []), "id", COLUMNS)
    assert [tuple(r) for r in found.collect()] == [("t", 1, "lost", 2, 0)]
    assert differences.row_differences(frame(spark, []), frame(spark, []), "id", COLUMNS).count() == 0


def test_stored_sums_leave_only_differing_ranges_to_read(spark, tmp_path):
    n = 200_000
    source = spark.range(n).select(F.lit("t").alias("tenant_id"), "id", F.col("id").cast("string").alias("a"), F.lit(1.0).alias("b"))
    wrong = source.withColumn("a", F.when(F.col("id").isin(70_001, 70_900, 150_000), "?").otherwise(F.col("a")))
    sides = []
    for name, df in (("left", source), ("right", wrong)):
        # Small row groups stand for a large file.
        path = str(tmp_path / name)
        df.coalesce(1).write.option("parquet.block.size", 64 * 1024).option("parquet.page.row.count.limit", 500).parquet(path)
        sides.append(spark.read.parquet(path))
    sums = [differences.leaf_sums(df, "id", COLUMNS).cache() for df in sides]
    leaves = differences.differing_leaves(*sums)
    assert sorted(r.leaf for r in leaves.collect()) == sorted({k // differences.WIDTH for k in (70_001, 70_900, 150_000)})
    part = differences.rows_in_leaves(sides[1], leaves, "id")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(id," in plan
    assert part.count() <= 3 * differences.WIDTH
    found = differences.row_differences(*sides, "id", COLUMNS, *sums)
    assert sorted((r.id, r.kind) for r in found.collect()) == [(70_001, "changed"), (70_900, "changed"), (150_000, "changed")]


def test_leaves_add_up_to_wider_ranges(spark):
    rows = rows_of(random.Random(8), 800)
    narrow = differences._wider(differences.leaf_sums(frame(spark, rows), "id", COLUMNS, 16), 1, 4)
    wide = differences.leaf_sums(frame(spark, rows), "id", COLUMNS, 64)
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, wide.collect()))
