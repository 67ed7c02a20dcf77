"""Every query by name, as a function of a session and an input folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.plans import marts, staging  # noqa: F401  (fill MODELS)
from storelake.plans.audits import AUDITS
from storelake.plans.questions import QUESTIONS
from storelake.plans.reshapes import RESHAPES
from storelake.plans.rules import RULES
from storelake.plans.star_loads import STAR_LOADS
from storelake.plans.summaries import SUMMARIES
from storelake.plans.warehouse import MODELS, Warehouse
from storelake.session import apply_settings
from storelake.sources.retail_star import RetailStar

Query = Callable[[SparkSession, str], DataFrame]


def star_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    apply_settings(spark)
    return Warehouse(RetailStar(spark, folder))


def shown(df: DataFrame) -> DataFrame:
    """Output types every engine agrees on: money as double, days as text, zone-less
    timestamps; the build time stamp is left out."""
    columns = []
    for field in df.schema.fields:
        if field.name == "dbt_loaded_at":
            continue
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _model(name: str) -> Query:
    return lambda spark, folder: shown(star_warehouse(spark, folder)[name])


def _over_warehouse(fn: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: shown(fn(star_warehouse(spark, folder)))


def _over_star(fn: Callable[[RetailStar], DataFrame]) -> Query:
    return lambda spark, folder: shown(fn(RetailStar(apply_settings(spark), folder)))


def registered() -> dict[str, Query]:
    # The constant tier table reads no table; its members are shown instead (see AUDITS).
    found: dict[str, Query] = {name: _over_star(fn) for name, fn in STAR_LOADS.items()}
    found |= {name: _model(name) for name in MODELS if name != "dim_loyalty_tier"}
    for group in (QUESTIONS, AUDITS, RESHAPES, RULES, SUMMARIES):
        found |= {name: _over_warehouse(fn) for name, fn in group.items()}
    return found
