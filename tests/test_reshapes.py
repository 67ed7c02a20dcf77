from shop import rows
from storelake.operators.pivots import completed


def test_labels_are_data(spark):
    cells = [("s1", "2024.01", 1.0), ("s1", None, 2.0), (None, "2024.01", 3.0), ("s1", "2024.01", 4.0)]
    df = spark.createDataFrame(cells, "store string, month string, revenue double")
    got = rows(completed(df, "store", "month", "revenue", 0.0))
    assert sorted(got, key=str) == sorted(
        [("s1", "2024.01", 5.0), ("s1", None, 2.0), (None, "2024.01", 3.0), (None, None, 0.0)], key=str
    )


def test_many_labels(spark):
    df = spark.range(12_000).selectExpr("'s' AS store", "id AS month", "1.0D AS revenue")
    assert completed(df, "store", "month", "revenue", 0.0).count() == 12_000
