"""Full and incremental loads into the landing zone."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from storelake.operators.checks import union_all
from storelake.operators.extract import changed_since, load_audit, micros
from storelake.sources.landing import LandingZone

log = logging.getLogger(__name__)

# Watermarks not after 1970 stand for none.
_NEVER = micros(datetime.datetime(1971, 1, 1)) - 1

# One tenant's source table; may raise when the source is unreachable.
Source = Callable[[str, str], DataFrame]


def full_load(
    zone: LandingZone,
    frames: Mapping[str, DataFrame],
    tenants: Sequence[str],
    tables: Sequence[str] | None = None,
    landed_at: datetime.datetime | None = None,
    side_by_side: int = 4,
) -> DataFrame:
    """Replace the tenants' rows of every table; returns the audit.

    ``frames``: rows of the tenants with their tenant column.  Unknown tables are skipped
    with a warning.  Small tables leave most executors idle, so a few are written side by side."""
    moment = landed_at or datetime.datetime.now(datetime.timezone.utc)
    known = []
    for name in tables if tables is not None else frames:
        if name in zone.specs:
            known.append(name)
        else:
            log.warning("skipping unknown table: %s", name)
    if not known:
        raise ValueError("no known table to load")
    with ThreadPoolExecutor(max_workers=max(1, min(side_by_side, len(known)))) as pool:
        parts = list(pool.map(lambda name: zone.replace_tenants(frames[name], name, tenants, moment), known))
    return load_audit(union_all(parts))


@dataclass(frozen=True)
class TableLoad:
    """``watermark``: microseconds since 1970 in UTC."""

    tenant_id: str
    table_name: str
    rows: int
    watermark: int | None
    error: str | None


class LoadFailed(RuntimeError):
    """Some tenants could not be loaded; the others are, and their watermarks moved."""

    def __init__(self, loads: Sequence[TableLoad]):
        self.loads = list(loads)
        super().__init__("; ".join(f"{x.tenant_id}.{x.table_name}: {x.error}" for x in loads if x.error))


def incremental_load(
    zone: LandingZone,
    source: Source,
    tenants: Sequence[str],
    tables: Sequence[str] | None = None,
    commit: str = "tenant",
    landed_at: datetime.datetime | None = None,
    lookback: datetime.timedelta = datetime.timedelta(0),
    side_by_side: int = 4,
    raise_failures: bool = True,
) -> list[TableLoad]:
    """Append every tenant's changed rows, then move its watermarks.

    ``commit="tenant"``  a tenant's watermarks move together and only after all its tables
                         were loaded; every table is tried.
    ``commit="table"``   a table's watermark moves as soon as it loaded rows; a failing
                         table stops the tenant's remaining tables.

    Either way a tenant's watermarks are stored when it is through, not after the slowest
    tenant.  Failures of a tenant raise ``LoadFailed`` after all tenants were tried, or are
    only returned with ``raise_failures=False``.

    Rows appended before a failure are appended again by the next run and collapse when
    read (newest version per key), so a run can be repeated at any point.  ``lookback``
    re-reads that much before the watermark to catch late commits; 0 never re-reads.

    The loop only submits jobs; each job's rows stay on the executors, and count and
    newest version come back as metrics of the write itself.
    """
    if commit not in ("tenant", "table"):
        raise ValueError(f"commit: {commit}")
    names = list(tables if tables is not None else zone.specs)
    since = {
        (r.tenant_id, r.table_name): r.mark
        for r in zone.watermarks(tenants, names)
        .select("tenant_id", "table_name", F.unix_micros("watermark").alias("mark"))
        .collect()
    }
    back = lookback // datetime.timedelta(microseconds=1)

    def load_tenant(tenant: str) -> list[TableLoad]:
        done: list[TableLoad] = []
        for name in names:
            start = since[tenant, name]
            load = _load_table(zone, source, tenant, name, start, back, landed_at)
            done.append(load)
            if commit == "table":
                if load.error:
                    break
                if load.rows:
                    zone.set_watermarks([(tenant, name, load.watermark)])
        if commit == "tenant" and not any(load.error for load in done):
            zone.set_watermarks([(tenant, load.table_name, load.watermark) for load in done])
        return done

    with ThreadPoolExecutor(max_workers=max(1, min(side_by_side, len(tenants)))) as pool:
        per_tenant = list(pool.map(load_tenant, tenants))

    done = [load for loads in per_tenant for load in loads]
    if raise_failures and any(load.error for load in done):
        raise LoadFailed(done)
    return done


def _load_table(zone, source, tenant, name, since, back, landed_at) -> TableLoad:
    version = zone.spec(name).version
    try:
        start = since - back if since > _NEVER else since
        metrics = Observation()
        rows = changed_since(source(tenant, name), version, start).observe(
            metrics, F.count(F.lit(1)).alias("rows"), F.unix_micros(F.max(version)).alias("newest")
        )
        zone.append_tenant(rows, name, tenant, landed_at)
        seen = metrics.get
        newest = max(since, seen["newest"] or since)
        return TableLoad(tenant, name, seen["rows"], newest, None)
    except Exception as problem:  # a tenant's failure must not stop the others
        log.error("[%s.%s] load failed: %s", tenant, name, problem)
        return TableLoad(tenant, name, 0, None, str(problem) or type(problem).__name__)


def report(zone: LandingZone, loads: Sequence[TableLoad]) -> DataFrame:
    """The outcome of a run as rows (one per tenant and table)."""
    return zone.spark.createDataFrame(
        [(x.tenant_id, x.table_name, x.rows, x.watermark, x.error) for x in loads],
        "tenant_id string, table_name string, rows long, watermark long, error string",
    ).withColumn("watermark", F.timestamp_micros("watermark"))


def failed_tenants(loads: Sequence[TableLoad]) -> list[str]:
    return sorted({x.tenant_id for x in loads if x.error})
