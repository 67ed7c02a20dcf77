import datetime

from pyspark.sql import functions as F

from shop import ts
from storelake import functions as fn


def one(spark, column, **values):
    cells = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*cells).select(column).first()[0]


def test_surrogate_key_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([("t", 1), ("t", None)], "tenant_id string, id long")
    assert [r[0] for r in df.select(fn.surrogate_key("tenant_id", "id")).collect()] == ["t-1", None]


def test_date_key_and_labels(spark):
    when = ts("2024-03-07T23:59:59")
    assert one(spark, fn.date_key("d"), d=when) == 20240307
    assert one(spark, fn.year_month("d"), d=when) == "2024-03"


def test_sunday_is_seven(spark):
    assert one(spark, fn.iso_weekday("d"), d=datetime.date(2024, 3, 3)) == 7
    assert one(spark, fn.iso_weekday("d"), d=datetime.date(2024, 3, 4)) == 1


def test_month_and_hour_differences_count_boundaries(spark):
    a, b = datetime.date(2024, 1, 31), datetime.date(2024, 2, 1)
    assert one(spark, fn.months_crossed("a", "b"), a=a, b=b) == 1
    a, b = ts("2024-01-01T10:59:00"), ts("2024-01-01T11:01:00")
    assert one(spark, fn.hours_crossed("a", "b"), a=a, b=b) == 1


def test_half_up_and_ratio(spark):
    for value, digits, expected in [(1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (1.25, 1, 1.3)]:
        assert abs(one(spark, fn.half_up(F.col("x"), digits), x=value) - expected) < 0.0101
    assert one(spark, fn.ratio(F.col("x"), F.col("y")), x=1.0, y=0.0) is None


def test_trim_keeps_tabs(spark):
    assert one(spark, F.trim("s"), s=" \ta ") == "\ta"
