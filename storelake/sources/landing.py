"""The landing zone: parquet tables in generations, and the watermark log."""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.operators.extract import conformed, epoch, instant, micros, watermark_state
from storelake.operators.versions import current_rows
from storelake.session import names_in, remove
from storelake.sources.catalog import CATALOG, LANDED_AT, TENANT, TableSpec, UnknownTable
from storelake.sources.generations import Conflict, Generation, GenerationLog, new_segment

WATERMARKS = T.StructType(
    [
        T.StructField("tenant_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("watermark", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)


class LandingZone(Mapping[str, DataFrame]):
    """Landed tables by name, all versions, in segments partitioned by tenant (see ``generations``).

    Works on any file system Spark can write; every write is a plain Spark job, so lost
    tasks are retried and nothing passes through the driver.  Batch loads, streams and compactions
    commit one generation each: readers see all of a write or nothing of it."""

    def __init__(
        self, spark: SparkSession, root: str, specs: Mapping[str, TableSpec] = CATALOG
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = dict(specs)

    # -- reading -----------------------------------------------------------

    def spec(self, name: str) -> TableSpec:
        if name not in self.specs:
            raise UnknownTable(f"unknown table: {name}")
        return self.specs[name]

    def path(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def log(self, name: str) -> GenerationLog:
        return GenerationLog(self.spark, f"{self.root}/generations/{name}")

    def __getitem__(self, name: str) -> DataFrame:
        """All versions, as of the latest generation; later writes do not change the frame."""
        return self.at(name, self.log(name).latest())

    def at(self, name: str, generation: Generation | int) -> DataFrame:
        """All versions as of a generation that was not cleared away."""
        schema = self.spec(name).raw_schema
        if isinstance(generation, int):
            generation = self.log(name).read(generation)
        folders = [f"{self.path(name)}/{f}" for f in generation.folders()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema).option("basePath", self.path(name))
        return read.parquet(*folders).select(*schema.names)

    def since(self, name: str, earlier: Generation | int) -> DataFrame:
        """The rows that landed after a generation.  A tenant that was replaced or compacted meanwhile
        (``Conflict``) has lost what it had: rebuild from all its rows."""
        if isinstance(earlier, int):
            earlier = self.log(name).read(earlier) if earlier else Generation()
        now, new = self.log(name).latest(), {}
        for tenant in {**earlier.segments, **now.segments}:
            had, has = earlier.segments.get(tenant, ()), now.segments.get(tenant, ())
            if not set(had) <= set(has):
                raise Conflict(f"{name}, {tenant}: replaced since generation {earlier.number}")
            new[tenant] = tuple(s for s in has if s not in had)
        return self.at(name, replace(now, segments={t: s for t, s in new.items() if s}))

    def __iter__(self) -> Iterator[str]:
        return iter(self.specs)

    def __len__(self) -> int:
        return len(self.specs)

    def current(self, name: str) -> DataFrame:
        return current_rows(self[name], self.spec(name))

    # -- writing -----------------------------------------------------------

    def create(self) -> LandingZone:
        """A table without a generation has no rows, so only the watermark log is made."""
        empty = self.spark.createDataFrame([], WATERMARKS)
        empty.write.mode("ignore").partitionBy(TENANT).parquet(self._log_path)
        return self

    def registered(self, database: str) -> LandingZone:
        """``create``, and all landed rows, streamed ones too, as views of a catalog database.

        A view reads an external table whose partitions are the visible segments; call again to
        show a later generation."""
        self.create()
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for name, spec in self.specs.items():
            fields = spec.raw_schema.fields
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            shown = ", ".join(f"`{f.name}`" for f in fields)
            landed = f"`{database}`.`landed_{name}`"
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {landed} (`_segment` string, {columns}) USING parquet "
                f"PARTITIONED BY (`_segment`, `{TENANT}`) LOCATION '{self.path(name)}'"
            )
            visible = set(self.log(name).latest().folders())
            known = {r.partition for r in self.spark.sql(f"SHOW PARTITIONS {landed}").collect()}
            for action, folders in (("ADD IF NOT EXISTS", visible - known), ("DROP IF EXISTS", known - visible)):
                for folder in sorted(folders):
                    where = ", ".join(f"`{k}`='{v}'" for k, v in (part.split("=", 1) for part in folder.split("/")))
                    self.spark.sql(f"ALTER TABLE {landed} {action} PARTITION ({where})")
            self.spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT {shown} FROM {landed}")
        return self

    def stamped(self, df: DataFrame, name: str, landed_at: datetime.datetime | None) -> DataFrame:
        """Source rows (with tenant) in the landed layout."""
        moment = F.current_timestamp() if landed_at is None else instant(landed_at)
        return conformed(df, self.spec(name)).withColumn(LANDED_AT, moment)

    def append(
        self, df: DataFrame, name: str, landed_at: datetime.datetime | None = None
    ) -> None:
        """Rows of any tenants (with their tenant column) in one job."""
        segment, tenants = self._written(self.stamped(df, name, landed_at), name)
        self.log(name).commit(lambda g: g.adding(segment, tenants) if tenants else g)

    def append_tenant(
        self, df: DataFrame, name: str, tenant: str, landed_at: datetime.datetime | None = None
    ) -> None:
        """Rows of one tenant.  Tenants may load at the same time: each job has a segment of its own."""
        folder = self._tenant_folder(tenant)
        segment, counted = new_segment(), Observation()
        rows = self.stamped(df, name, landed_at).observe(counted, F.count(F.lit(1)).alias("rows"))
        rows.write.parquet(f"{self.path(name)}/_segment={segment}/{folder}")
        if counted.get["rows"]:
            self.log(name).commit(lambda g: g.adding(segment, [folder]))
        else:
            remove(self.spark, f"{self.path(name)}/_segment={segment}")

    def append_batch(self, df: DataFrame, name: str, stream: str, batch: int) -> None:
        """A micro-batch of a stream, once: a batch that is replayed after its commit lands nothing."""
        landed = lambda g: g.batches.get(stream, -1) >= batch
        if landed(self.log(name).latest()):
            return
        segment, tenants = self._written(self.stamped(df, name, None), name)
        self.log(name).commit(lambda g: g if landed(g) else g.adding(segment, tenants).streamed(stream, batch))

    def replace_tenants(
        self,
        df: DataFrame,
        name: str,
        tenants: Sequence[str],
        landed_at: datetime.datetime,
    ) -> DataFrame:
        """Full load: the listed tenants hold exactly ``df`` afterwards, whatever way their rows
        came in; others keep theirs.

        All tenants are written by one job and appear by one commit.  Returns rows per listed
        tenant, counted by the write itself."""
        folders = {t: self._tenant_folder(t) for t in tenants}
        counted = Observation()
        each = [F.count_if(F.col(TENANT) == t).alias(f"n{i}") for i, t in enumerate(tenants)]
        mine = self.stamped(df, name, landed_at).filter(F.col(TENANT).isin(list(tenants)))
        segment, filled = self._written(mine.observe(counted, *each), name)
        self.log(name).commit(lambda g: g.replacing(folders.values(), segment, filled))
        return self.spark.createDataFrame(
            [(t, name, counted.get[f"n{i}"]) for i, t in enumerate(tenants)],
            "tenant_id string, table_name string, rows long",
        )

    def compact(self, name: str, tenant: str) -> None:
        """Drop superseded versions of one tenant, so that reads stop sorting through them.

        Its segments become one; rows that land meanwhile keep their segments, and a full load
        meanwhile wins (``Conflict``)."""
        folder = self._tenant_folder(tenant)
        before = self.log(name).latest()
        old = before.segments.get(folder, ())
        if not old:
            return
        mine = self.at(name, replace(before, segments={folder: old}))
        segment, _ = self._written(current_rows(mine, self.spec(name)).select(*mine.columns), name)
        self.log(name).commit(lambda g: g.merging(folder, old, segment))

    def clear(self, name: str, keep: int = 2, age: datetime.timedelta = datetime.timedelta(days=1)) -> list[str]:
        """Delete segments that none of the last ``keep`` generations shows, what dead writers left
        included, and older generations.  Nothing younger than ``age`` goes: it may be being written,
        or read."""
        log = self.log(name)
        numbers = log.numbers()
        shown = {s for n in numbers[-keep:] for segments in log.read(n).segments.values() for s in segments}
        before = int((datetime.datetime.now(datetime.timezone.utc) - age).timestamp() * 1000)
        found = names_in(self.spark, self.path(name), before)
        gone = [f for f in found if f.startswith("_segment=") and f.removeprefix("_segment=") not in shown]
        for folder in gone:
            remove(self.spark, f"{self.path(name)}/{folder}")
        log.forget(numbers[:-keep])
        return gone

    def _written(self, rows: DataFrame, name: str) -> tuple[str, list[str]]:
        """Rows as a new segment; the tenants' folders in it."""
        segment = new_segment()
        folder = f"{self.path(name)}/_segment={segment}"
        rows.write.option("partitionOverwriteMode", "static").partitionBy(TENANT).parquet(folder)
        return segment, sorted(f for f in names_in(self.spark, folder) if f.startswith(f"{TENANT}="))

    def _tenant_folder(self, tenant: str) -> str:
        return f"{TENANT}={self._folder_name(tenant)}"

    @staticmethod
    def _folder_name(tenant: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", tenant):
            raise ValueError(f"tenant id not usable as a folder name: {tenant!r}")
        return tenant

    # -- watermarks ----------------------------------------------------------

    @property
    def _log_path(self) -> str:
        return f"{self.root}/watermarks"

    def watermark_log(self) -> DataFrame:
        return self.spark.read.schema(WATERMARKS).parquet(self._log_path)

    def watermarks(self, tenants: Sequence[str], tables: Sequence[str]) -> DataFrame:
        """State of the whole grid, epoch where nothing was stored."""
        grid = self.spark.createDataFrame(
            [(t, n) for t in tenants for n in tables], "tenant_id string, table_name string"
        )
        return watermark_state(self.watermark_log(), grid)

    def watermark(self, tenant: str, table: str) -> datetime.datetime:
        return self.watermarks([tenant], [table]).first().watermark

    def set_watermarks(self, rows: Sequence[tuple[str, str, datetime.datetime | int]]) -> None:
        """Append new states (whole seconds, as they are read back); times as microseconds or in UTC.

        Every tenant has a folder of its own, so tenants may commit at the same time."""
        for tenant in dict.fromkeys(t for t, _, _ in rows):
            mine = [(name, micros(moment)) for t, name, moment in rows if t == tenant]
            log = self.spark.createDataFrame(mine, "table_name string, micros long").coalesce(1)
            moment = F.date_trunc("second", F.greatest(F.timestamp_micros("micros"), epoch()))
            log.select("table_name", moment.alias("watermark"), F.current_timestamp().alias("updated_at")).write.mode(
                "append"
            ).parquet(f"{self._log_path}/{TENANT}={self._folder_name(tenant)}")
