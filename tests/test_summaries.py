import random
from decimal import Decimal

import numpy as np

from shop import line, rows, sale, shop
from storelake.plans import questions as q
from storelake.plans import summaries as s

LAYOUT = (
    "tenant_id string, date_key int, payment_method string, transaction_sk string, "
    "customer_sk string, net_amount decimal(18,2)"
)


def frame(spark, data):
    return spark.createDataFrame([(*r[:5], None if r[5] is None else Decimal(r[5])) for r in data], LAYOUT)


def store_of(spark, path, data):
    store = s.SummaryStore(spark, str(path))
    store.build(frame(spark, data))
    return store


def many(n, seed=1):
    """A third of all lines in one transaction, a third by one customer."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        basket = "hot" if i % 3 == 0 else f"t{i // 2}"
        who = "c0" if i % 3 == 1 else f"c{rng.randrange(n // 4)}"
        month = 202401 + rng.randrange(3)
        day = month * 100 + 1 + rng.randrange(28)
        out.append(("a", day, rng.choice(("cash", "card")), basket, who, f"{rng.lognormvariate(3, 1):.2f}"))
    return out


def test_small_counts_equal_the_exact_questions(spark, tmp_path):
    wh = shop(
        spark,
        transactions=[sale(1), sale(2, payment="DEBIT"), sale(3, payment="debit")],
        transaction_items=[line(1, 1), line(2, 1), line(3, 2), line(4, 3)],
    )
    store = s.SummaryStore(spark, str(tmp_path / "s"))
    store.build(wh["fact_sales"])
    assert rows(s.payment_mix(store.read(), "t1")) == rows(q.payment_mix(wh, "t1"))
    got = rows(s.transactions_by_day(store.read(), wh["dim_date"]))
    assert got == rows(q.transactions_by_day(wh))


def test_estimates_and_ranks_keep_their_bounds_after_merging(spark, tmp_path):
    data = many(60_000)
    store = store_of(spark, tmp_path / "s", data)
    mix = {m: n for m, n, _ in rows(s.payment_mix(store.read(), "a"))}
    for method in ("cash", "card"):
        true = len({r[3] for r in data if r[2] == method})
        assert true > 4096 and abs(mix[method] - true) <= true * s.DISTINCT_ERROR
    chances = [0.01, 0.33, 0.5, 0.66, 0.99]
    (got,) = rows(s.amount_quantiles(store.read(), [], chances))
    amounts = np.array([float(r[5]) for r in data])
    assert got[0] == len(data)
    for p, x in zip(chances, got[1:]):
        assert (amounts < x).mean() - s.RANK_ERROR <= p <= (amounts <= x).mean() + s.RANK_ERROR


def test_returning_customers_are_an_intersection(spark, tmp_path):
    data = [
        ("a", 202312 * 100 + 5, "cash", "1", "x", "1"), ("a", 202401 * 100 + 5, "cash", "2", "x", "1"),
        ("a", 202401 * 100 + 6, "card", "3", "y", "1"), ("a", 202403 * 100 + 6, "card", "4", "y", "1"),
        ("b", 202401 * 100 + 6, "card", "5", None, "1"), ("007", 202401 * 100 + 6, None, "6", "x", None),
    ]
    store = store_of(spark, tmp_path / "s", data)
    assert rows(s.returning_customers(store.read())) == [
        ("007", 202401, 1, 0), ("a", 202312, 1, 0), ("a", 202401, 2, 1), ("a", 202403, 1, 0), ("b", 202401, 0, 0),
    ]
    # Only amounts that are missing: no quantile instead of an error.
    found = {r[0]: r[1:] for r in rows(s.amount_quantiles(store.read(), ["tenant_id"], [0.5]))}
    assert found["007"] == (1, None) and found["a"] == (4, 1.0)


def test_a_month_is_rebuilt_alone_and_may_become_empty(spark, tmp_path):
    old = [("a", m * 100 + 3, "cash", f"{m}", "x", "1") for m in (202401, 202402, 202403)] + [("b", 20240203, "cash", "9", "z", "5")]
    store = store_of(spark, tmp_path / "s", old)
    new = [("a", 20240103, "cash", "never read", "x", "7"), ("a", 20240204, "card", "8", "x", "2")]
    store.rebuild(frame(spark, new), [202402, 202403])
    got = sorted((r.tenant_id, r.date_key, r.payment_method, float(r.net)) for r in store.read().collect())
    assert got == [("a", 20240103, "cash", 1.0), ("a", 20240204, "card", 2.0)]
    store.rebuild(frame(spark, new), [])
    assert store.read().count() == 2


def test_questions_read_summaries_only(spark, tmp_path):
    store = store_of(spark, tmp_path / "s", many(300))
    plan = s.payment_mix(store.read(), "a")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.split("Exchange")[-1] and "amounts" not in plan.split("ReadSchema")[-1]
    assert "PartitionFilters: [isnotnull(tenant_id" in plan
    one = s.merged(store.read().filter("month_key = 202401"))
    assert "month_key" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:80]


def test_no_sales(spark, tmp_path):
    store = store_of(spark, tmp_path / "s", [])
    assert rows(s.payment_mix(store.read(), None)) == []
    assert rows(s.returning_customers(store.read())) == []
