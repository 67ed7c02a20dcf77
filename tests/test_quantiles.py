from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from storelake.operators.quantiles import approx_quantiles, exact_quantiles

PROBABILITIES = [0.0, 0.33, 0.5, 0.66, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x decimal(28,2)")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=60))
def test_matches_linear_interpolation(spark, cents):
    values = [Decimal(c) / 100 for c in cents]
    got = exact_quantiles(frame(spark, values), "x", PROBABILITIES)
    want = np.quantile([float(v) for v in values], PROBABILITIES)
    assert got == pytest.approx(list(want), rel=1e-9, abs=1e-6)


def test_one_value_may_hold_most_rows(spark):
    values = [Decimal("5.00")] * 500 + [Decimal(i) for i in range(250)]
    got = exact_quantiles(frame(spark, values), "x", [0.33, 0.66])
    assert got == pytest.approx(list(np.quantile([float(v) for v in values], [0.33, 0.66])))


def test_nulls_and_empty_input(spark):
    assert exact_quantiles(frame(spark, [None, Decimal(3)]), "x", [0.5]) == [3.0]
    assert exact_quantiles(frame(spark, []), "x", [0.5]) == [None]


def test_sketch_is_close(spark):
    values = [Decimal(i) for i in range(1000)]
    low, high = approx_quantiles(frame(spark, values), "x", [0.33, 0.66])
    assert abs(low - 329.67) <= 1 and abs(high - 659.34) <= 1
