"""Exact interpolated quantiles of a whole column without gathering it.

Spark's ``percentile`` keeps every distinct value of a group in one task.  Here the
value, as a 64-bit integer, is searched by radix: each pass counts rows by the next
16 bits among the rows that share the bits found so far.  Whatever the input size or
skew, a pass leaves at most 65,536 bins for the running total and returns one row to
the driver; a value range of b bits takes ceil(b / 16) passes, four at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BITS = 16


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], scale: int = 2
) -> list[float | None]:
    """Linear interpolation between order statistics, as ``percentile`` defines it.

    ``column`` is a decimal with at most ``scale`` fraction digits; NULLs are ignored and
    an empty input gives ``None``.  ``df`` is read once per pass: hand in a stored table.
    """
    unit = 10**scale
    values = df.select((F.col(column) * unit).cast("long").alias("v")).filter("v is not null")
    span = values.agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    ).first()
    if not span.n:
        return [None] * len(probabilities)

    wanted = []
    for p in probabilities:
        position = (span.n - 1) * p
        below = int(position)
        wanted.append((below, min(below + 1, span.n - 1), position - below))
    ranks = sorted({r for low, high, _ in wanted for r in (low, high)})
    value_at = _order_statistics(values, span.low, span.high, ranks)

    found = []
    for low, high, fraction in wanted:
        a, b = value_at[low] / unit, value_at[high] / unit
        found.append(a + (b - a) * fraction)
    return found


def _order_statistics(values: DataFrame, low: int, high: int, ranks: list[int]) -> dict[int, int]:
    """The value at each 0-based rank."""
    offset = values.select((F.col("v") - F.lit(low)).alias("v"))
    passes = max(1, -(-(high - low).bit_length() // _BITS))
    # rank -> (bits found so far, rank among the rows that share them)
    state = {rank: (0, rank) for rank in ranks}
    for level in reversed(range(passes)):
        state = _narrow(offset, state, level * _BITS)
    return {rank: prefix + low for rank, (prefix, _) in state.items()}


def _narrow(offset: DataFrame, state: dict[int, tuple[int, int]], shift: int):
    prefixes = sorted({prefix for prefix, _ in state.values()})
    bits = F.shiftright("v", shift) if shift else F.col("v")
    parent = F.shiftright("bits", _BITS)
    bins = (
        offset.select(bits.alias("bits"))
        .filter(parent.isin(prefixes))
        .groupBy("bits")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("parent", parent)
    )
    # At most 65,536 bins per parent reach a task.
    upto = Window.partitionBy("parent").orderBy("bits")
    running = bins.withColumn("cum", F.sum("n").over(upto))
    picks = []
    for rank, (prefix, within) in state.items():
        reached = (F.col("parent") == prefix) & (F.col("cum") > within)
        picks.append(F.min(F.when(reached, F.struct("bits", F.col("cum") - F.col("n")))).alias(f"r{rank}"))
    row = running.agg(*picks).first()
    return {
        rank: (row[f"r{rank}"][0], within - row[f"r{rank}"][1])
        for rank, (_, within) in state.items()
    }


def approx_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = 100_000
) -> list[float | None]:
    """One-pass variant: mergeable sketches with rank error 1/accuracy, no interpolation."""
    picks = F.percentile_approx(F.col(column).cast("double"), list(probabilities), accuracy)
    return df.agg(picks.alias("q")).first().q or [None] * len(probabilities)
