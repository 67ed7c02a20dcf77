"""Row-level joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_THIRD = 32_749


def attach(rows: DataFrame, lookup: DataFrame, entity: str, how: str = "left") -> DataFrame:
    """Join fact rows with a side that has one row per ``entity``.

    A third key, made from the id, is part of the condition on purpose.  The lookup is already
    partitioned by ``(id, tenant)`` from its newest-version step; with three join keys Spark does
    not reuse that partitioning but exchanges both sides for this join.  Only then can adaptive
    execution cut a hot key of the row side (NULL included) into several tasks.  The lookup is the
    small side, so its extra exchange is cheap, and below the broadcast limit none of this is
    planned at all.  A number serves, so that rows need not carry the text of a surrogate key
    through the exchange and the sort; as an expression of the condition it is not carried either.

    The id leads: sorts compare its 64-bit prefix.  Since ``(id, tenant)`` is known to be
    unique, a left join none of whose columns is used is dropped by the optimizer.
    """
    key = f"{entity}_id"
    other = lookup.withColumnsRenamed({key: "_id", "tenant_id": "_tenant"})
    same = (F.col(key) == F.col("_id")) & (F.col("tenant_id") == F.col("_tenant"))
    return rows.join(other, same & (F.col(key) % _THIRD == F.col("_id") % _THIRD), how).drop("_id", "_tenant")
