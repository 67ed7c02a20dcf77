"""Data-quality operators.  Each returns its failing rows (or their count) as a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions import hours_crossed

ERROR, WARN = "error", "warn"
RESULT_COLUMNS = ["layer", "model", "column", "check", "severity", "failures", "status"]


@dataclass(frozen=True)
class Check:
    layer: str
    model: str
    column: str
    kind: str  # not_null | unique | accepted_values | relationships
    severity: str = ERROR
    values: tuple = ()
    parent: str = ""
    parent_column: str = field(default="")

    @property
    def label(self) -> str:
        return self.kind if not self.parent else f"{self.kind}:{self.parent}"


# -- failing rows ---------------------------------------------------------------


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_rows(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with a non-NULL value outside the list."""
    return df.filter(~F.col(column).isin(list(values)))


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL key values that occur more than once, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
    )


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child keys missing in the parent, with their number of rows.

    Keys of both sides meet in one grouping, which collapses them where they are read: a hot key
    and a parent that repeats its keys move one row per task, and nothing is sorted."""

    def keys(df: DataFrame, name: str, rows: int) -> DataFrame:
        kept = df.filter(F.col(name).isNotNull())
        return kept.select(F.col(name).alias("key"), F.lit(rows).cast("long").alias("rows"), F.lit(rows == 0).alias("known"))

    both = keys(child, column, 1).unionByName(keys(parent, parent_column, 0))
    per_key = both.groupBy("key").agg(F.sum("rows").alias("rows"), F.max("known").alias("known"))
    return per_key.filter("not known").drop("known").withColumnRenamed("key", column)


# -- failure counts ---------------------------------------------------------------


def _violates(check: Check) -> Column:
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    return ~column.isin(list(check.values))


def _status(check: Check, failures: Column) -> Column:
    bad = "fail" if check.severity == ERROR else "warn"
    return F.when(failures == 0, "pass").otherwise(bad)


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.layer).alias("layer"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column"),
        F.lit(check.label).alias("check"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
        _status(check, failures).alias("status"),
    )


def scan_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All not_null and accepted_values checks of one model in a single pass over it."""
    totals = df.agg(*[F.count_if(_violates(c)).alias(f"f{i}") for i, c in enumerate(checks)])
    rows = F.array(*[_result(c, F.col(f"f{i}")) for i, c in enumerate(checks)])
    return totals.select(F.inline(rows))


def keyed_checks(df: DataFrame, unique: Check, checks: Sequence[Check] = ()) -> DataFrame:
    """A uniqueness check and all column checks of the same model in one pass over it.

    Column violations are summed per key along with the row count, so they ride on the
    shuffle that uniqueness needs anyway."""
    key = F.col(unique.column)
    per_key = df.groupBy(key.alias("key")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(_violates(c)).alias(f"f{i}") for i, c in enumerate(checks)],
    )
    repeated = F.count_if(F.col("key").isNotNull() & (F.col("rows") > 1))
    zero = F.lit(0).cast("long")
    totals = per_key.agg(
        repeated.alias("repeated"),
        *[F.coalesce(F.sum(f"f{i}"), zero).alias(f"f{i}") for i in range(len(checks))],
    )
    results = [_result(unique, F.col("repeated"))]
    results += [_result(c, F.col(f"f{i}")) for i, c in enumerate(checks)]
    return totals.select(F.inline(F.array(*results)))


def relationship_check(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    orphans = orphan_keys(child, check.column, parent, check.parent_column)
    failing = orphans.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("failures"))
    return failing.select(F.inline(F.array(_result(check, F.col("failures")))))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


# -- reconciliation and freshness ---------------------------------------------------


def row_count_reconcile(source: DataFrame, landed: DataFrame, tolerance: int = 0) -> DataFrame:
    """Compare ``(tenant_id, table_name, rows)`` of source and landing.

    Fewer landed rows fail; more only warn, since deletes never reach the landing zone."""
    keys = ["tenant_id", "table_name"]
    zero = F.lit(0).cast("long")
    both = source.withColumnRenamed("rows", "source_rows").join(
        landed.withColumnRenamed("rows", "landed_rows"), keys, "full"
    )
    gap = F.col("landed_rows") - F.col("source_rows")
    return (
        both.withColumn("source_rows", F.coalesce("source_rows", zero))
        .withColumn("landed_rows", F.coalesce("landed_rows", zero))
        .withColumn(
            "status",
            F.when(gap < -tolerance, "FAIL").when(gap > tolerance, "WARN").otherwise("OK"),
        )
        .select(*keys, "source_rows", "landed_rows", "status")
    )


def amount_reconcile(
    left: DataFrame, left_column: str, right: DataFrame, right_column: str, limit: str = "1.0"
) -> DataFrame:
    """One row with both totals, their distance and the verdict (NULL totals fail)."""
    a = left.agg(F.sum(left_column).alias("left_total"))
    totals = a.withColumn("right_total", right.agg(F.sum(right_column)).scalar())
    diff = F.abs(F.col("left_total") - F.col("right_total"))
    within = diff <= F.lit(limit).cast("decimal(18,2)")
    return totals.select(
        "left_total",
        "right_total",
        diff.alias("diff"),
        F.when(within, "pass").otherwise("fail").alias("status"),
    )


def freshness(df: DataFrame, column: str, now: Column, limit_hours: int = 24) -> DataFrame:
    """One row; an empty table has no load time and fails."""
    last = df.agg(F.max(column).alias("last_loaded_at")).withColumn("checked_at", now)
    age = hours_crossed("last_loaded_at", "checked_at")
    return last.select(
        "last_loaded_at",
        "checked_at",
        age.alias("hours"),
        F.when(age <= limit_hours, "pass").otherwise("fail").alias("status"),
    )


# -- gate ---------------------------------------------------------------------------


class GateFailed(RuntimeError):
    """A layer has checks of severity ``error`` that failed."""


def enforce(results: DataFrame) -> None:
    """Raise when a check failed with severity error; warnings never stop the run."""
    # One row per declared check at most.
    failed = results.filter(F.col("status") == "fail").select("model", "column", "check", "failures")
    rows = failed.collect()
    if rows:
        names = ", ".join(f"{r.model}.{r.column} {r['check']} ({r.failures})" for r in rows)
        raise GateFailed(names)


def gate_states(results: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per layer: passed, failed, or blocked by an earlier failed layer."""
    position = F.array_position(F.array(*[F.lit(name) for name in order]), F.col("layer"))
    layers = results.groupBy("layer").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") == "fail").alias("errors"),
        F.count_if(F.col("status") == "warn").alias("warnings"),
    )
    # The first failed layer as a set lookup: no ordering over rows is needed.
    first_failed = (
        layers.filter("errors > 0").agg(F.coalesce(F.min(position), F.lit(len(order) + 1))).scalar()
    )
    return layers.select(
        position.cast("int").alias("position"),
        "layer",
        "checks",
        "errors",
        "warnings",
        F.when(position > first_failed, "blocked")
        .when(F.col("errors") > 0, "failed")
        .otherwise("passed")
        .alias("state"),
    )
