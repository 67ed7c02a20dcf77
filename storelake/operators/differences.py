"""Which rows differ between two copies of a table: checksums over key ranges.

A leaf is ``width`` neighbouring keys of one tenant, with its number of rows and two sums of row
hashes.  Leaves add up to wider ranges, so a copy's leaves can be stored and merged instead of
reading its rows again.  Two copies are compared from the widest ranges down: a range is split
only where the copies differ, and rows are read in the differing leaves alone.

Row order and partitioning do not matter; repeated rows count.  Two copies that differ look alike
only if both 32-bit sums and the count of a range agree by chance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.session import written
from storelake.sources.catalog import TENANT

WIDTH = 1024  # keys of a leaf
FANOUT = 64  # ranges that make the next wider one
LEVELS = 3  # widest ranges: WIDTH * FANOUT ** LEVELS keys
PUSHED_SPANS = 200  # so many spans of differing keys become filters of the scan; more are joined
SUMS = ["rows", "low_sum", "high_sum"]


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a row.  A null is a value of its own: each null's position is part of the hash."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(nulls, *columns)


def _sums(of: Column) -> list[Column]:
    # Sums of 32-bit halves: exact, and no overflow below two thousand million rows of a range.
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(of.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low_sum"),
        F.sum(F.shiftrightunsigned(of, 32)).alias("high_sum"),
    ]


def _leaf(key: str, width: int) -> Column:
    return F.floor(F.col(key) / F.lit(width)) if width & (width - 1) else F.shiftright(key, width.bit_length() - 1)


def leaf_sums(df: DataFrame, key: str, columns: Sequence[str], width: int = WIDTH) -> DataFrame:
    """``tenant_id, leaf, rows, low_sum, high_sum`` of every leaf; one map-side combined pass.

    Rows without a key share the leaf NULL of their tenant."""
    return df.groupBy(TENANT, _leaf(key, width).cast("long").alias("leaf")).agg(*_sums(row_hash(columns)))


def _wider(leaves: DataFrame, level: int, fanout: int) -> DataFrame:
    span = F.floor(F.col("leaf") / F.lit(fanout**level)).cast("long")
    return leaves.groupBy(TENANT, span.alias("span")).agg(*[F.sum(c).alias(c) for c in SUMS])


def _same(a: str, b: str, columns: Sequence[str]) -> Column:
    both = F.lit(True)
    for c in columns:
        both = both & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return both


def _unequal(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (null-safe) whose sums differ or that one side lacks."""
    pairs = left.alias("l").join(right.alias("r"), _same("l", "r", keys), "full")
    found = pairs.where(~_same("l", "r", SUMS))
    return found.select(*[F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys])


def differing_leaves(left: DataFrame, right: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``tenant_id, leaf`` of the leaves whose sums differ, from the widest ranges down."""
    open_spans: DataFrame | None = None
    for level in range(levels, -1, -1):
        sides = []
        for side in (left, right):
            if open_spans is not None:
                parent = F.floor(F.col("leaf") / F.lit(fanout ** (level + 1))).cast("long")
                inside = side.withColumn("span", parent).alias("side")
                side = inside.join(open_spans.alias("open"), _same("side", "open", [TENANT, "span"]), "left_semi")
            sides.append(_wider(side, level, fanout))
        open_spans = written(_unequal(*sides, [TENANT, "span"]), "differing-spans")
    return open_spans.withColumnRenamed("span", "leaf")


def _spans(leaves: DataFrame) -> list[tuple] | None:
    """Neighbouring leaves of a tenant as one span, if no more than ``PUSHED_SPANS`` leaves differ."""
    found = sorted(
        (tuple(r) for r in leaves.limit(PUSHED_SPANS + 1).collect()),
        key=lambda x: (x[0] is not None, x[0] or "", x[1] is not None, x[1] or 0),
    )
    if len(found) > PUSHED_SPANS:
        return None
    spans: list[tuple] = []
    for tenant, leaf in found:
        if spans and leaf is not None and spans[-1][0] == tenant and spans[-1][2] == leaf - 1:
            spans[-1] = (tenant, spans[-1][1], leaf)
        else:
            spans.append((tenant, leaf, leaf))
    return spans


def rows_in_leaves(df: DataFrame, leaves: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """Rows of the given leaves.  Few leaves are bounds on the key that reach the scan, which skips
    files and row groups without such keys; many are a semi join."""
    spans = _spans(leaves)
    if spans is None:
        own = df.withColumn("_leaf", _leaf(key, width).cast("long")).alias("side")
        named = leaves.withColumnRenamed("leaf", "_leaf").alias("open")
        return own.join(named, _same("side", "open", [TENANT, "_leaf"]), "left_semi").drop("_leaf")
    condition = F.lit(False)
    for tenant, first, last in spans:
        within = F.col(key).isNull() if first is None else F.col(key).between(first * width, (last + 1) * width - 1)
        mine = F.col(TENANT).isNull() if tenant is None else F.col(TENANT) == tenant
        condition = condition | (mine & within)
    return df.where(condition)


def row_differences(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: Sequence[str],
    left_sums: DataFrame | None = None,
    right_sums: DataFrame | None = None,
    width: int = WIDTH,
    fanout: int = FANOUT,
) -> DataFrame:
    """Keys whose rows differ: ``tenant_id, <key>, kind, left_rows, right_rows``.

    ``kind`` is ``lost`` (only in ``left``), ``extra`` (only in ``right``) or ``changed`` (other
    values, or another number of rows).  All rows of a key are compared as a bag, so raw tables
    with many versions can be compared.  Stored leaves (``leaf_sums`` of the same columns and
    width) save the pass over that side.  Two empty tables do not differ."""
    sums = [
        written(leaf_sums(df, key, columns, width), "leaf-sums") if known is None else known
        for df, known in ((left, left_sums), (right, right_sums))
    ]
    leaves = differing_leaves(*sums, fanout)
    per_key = [
        rows_in_leaves(df, leaves, key, width).groupBy(TENANT, key).agg(*_sums(row_hash(columns)))
        for df in (left, right)
    ]
    pairs = per_key[0].alias("l").join(per_key[1].alias("r"), _same("l", "r", [TENANT, key]), "full")
    kind = F.when(F.col("r.rows").isNull(), "lost").when(F.col("l.rows").isNull(), "extra").otherwise("changed")
    zero = F.lit(0).cast("long")
    return pairs.where(~_same("l", "r", SUMS)).select(
        F.coalesce(F.col(f"l.{TENANT}"), F.col(f"r.{TENANT}")).alias(TENANT),
        F.coalesce(F.col(f"l.{key}"), F.col(f"r.{key}")).alias(key),
        kind.alias("kind"),
        F.coalesce(F.col("l.rows"), zero).alias("left_rows"),
        F.coalesce(F.col("r.rows"), zero).alias("right_rows"),
    )
