"""Newest versions without moving the table: a bucketed base and a small delta.

``build`` stores the newest rows of a generation as a table bucketed and sorted by (tenant, key).
Later reads join it with the newest rows of the segments that landed since, on the same keys:
the bucketing serves as one side's distribution, so only the delta is exchanged.  A tenant
whose base segments were replaced or compacted meanwhile is read from its segments, so the
result is that of all versions at any time; build a new base when the delta has grown.

A base is taken up by publishing its generation after its files are written; one that a dead job left
half-written is never read.  The bucketing is declared in the session's catalog over the base's
folder, so any session can read it.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.operators.versions import current_rows
from storelake.session import names_in, publish, read_text, remove
from storelake.sources.catalog import LANDED_AT, TENANT
from storelake.sources.generations import Generation
from storelake.sources.landing import LandingZone


@dataclass(frozen=True)
class Base:
    """What a stored base was made of."""

    generation: Generation
    buckets: int


class Bases(Mapping[str, DataFrame]):
    """The tables of a landing zone; ``current`` uses the latest base of a table where there is one."""

    def __init__(self, zone: LandingZone, database: str = "storelake_bases"):
        self.zone = zone
        self.spark = zone.spark
        self.database = database

    # Reading all versions is the zone's business.

    def __getitem__(self, name: str) -> DataFrame:
        return self.zone[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.zone)

    def __len__(self) -> int:
        return len(self.zone)

    # -- bases -------------------------------------------------------------

    def _folder(self, name: str) -> str:
        return f"{self.zone.root}/bases/{name}"

    def latest(self, name: str) -> Base | None:
        published = sorted(n for n in names_in(self.spark, self._folder(name)) if n.endswith(".json"))
        if not published:
            return None
        state = json.loads(read_text(self.spark, f"{self._folder(name)}/{published[-1]}"))
        segments = {t: tuple(s) for t, s in state["segments"].items()}
        return Base(Generation(state["generation"], segments), state["buckets"])

    def build(self, name: str, buckets: int | None = None) -> Base:
        """Store the newest rows of the latest generation.

        ``buckets``: as many as the session's shuffle partitions if not given; a bucket should hold what
        one task can sort."""
        generation = self.zone.log(name).latest()
        count = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        keys = self.zone.spec(name).version_key
        known = self.latest(name)
        if known is not None and known.generation.number == generation.number:
            return known
        rows = self._merged(name, generation, known)
        # One file a bucket: rows are dealt out as the buckets are.
        dealt = rows.repartition(count, *keys).write.mode("overwrite").format("parquet")
        location = f"{self._folder(name)}/{generation.number:020d}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name, generation.number)}")
        dealt.option("path", location).bucketBy(count, *keys).sortBy(*keys).saveAsTable(self._table(name, generation.number))
        state = {"generation": generation.number, "buckets": count, "segments": {t: list(s) for t, s in generation.segments.items()}}
        publish(self.spark, f"{location}.json", json.dumps(state))
        return Base(generation, count)

    def clear(self, name: str, keep: int = 2) -> None:
        """Delete all but the last bases."""
        published = sorted(n for n in names_in(self.spark, self._folder(name)) if n.endswith(".json"))
        for entry in published[:-keep]:
            remove(self.spark, f"{self._folder(name)}/{entry}")
            remove(self.spark, f"{self._folder(name)}/{entry.removesuffix('.json')}")

    def _table(self, name: str, number: int) -> str:
        # Zones of several roots may share a session.
        return f"`{self.database}`.`base_{name}_{zlib.crc32(self.zone.root.encode()):08x}_{number}`"

    def _rows(self, name: str, base: Base) -> DataFrame:
        """The stored base as a bucketed table of this session's catalog."""
        spec, table = self.zone.spec(name), self._table(name, base.generation.number)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.raw_schema.fields)
        keys = ", ".join(f"`{k}`" for k in spec.version_key)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {base.buckets} BUCKETS LOCATION '{self._folder(name)}/{base.generation.number:020d}'"
        )
        return self.spark.table(table).select(*spec.raw_schema.names)

    # -- newest rows ---------------------------------------------------------

    def current(self, name: str) -> DataFrame:
        return self._merged(name, self.zone.log(name).latest(), self.latest(name))

    def delta(self, name: str, generation: Generation, base: Base) -> tuple[list[str], Generation]:
        """Tenants whose base rows still count, and what is to be read beside them."""
        counted, rest = [], {}
        for tenant, segments in generation.segments.items():
            stored = set(base.generation.segments.get(tenant, ()))
            named = unquote(tenant.removeprefix(f"{TENANT}="))
            # A tenant without a name is a null, which no join finds.
            if stored and stored <= set(segments) and named != "__HIVE_DEFAULT_PARTITION__":
                counted.append(named)
                segments = tuple(s for s in segments if s not in stored)
            if segments:
                rest[tenant] = segments
        return counted, replace(generation, segments=rest)

    def _merged(self, name: str, generation: Generation, base: Base | None) -> DataFrame:
        spec = self.zone.spec(name)
        if base is None:
            return current_rows(self.zone.at(name, generation), spec)
        counted, rest = self.delta(name, generation, base)
        stored = self._rows(name, base)
        if set(counted) != {unquote(t.removeprefix(f"{TENANT}=")) for t in base.generation.segments}:
            stored = stored.filter(F.col(TENANT).isin(counted))
        if not rest.segments:
            return stored
        newer = current_rows(self.zone.at(name, rest), spec)
        b, d = stored.alias("b"), newer.alias("d")
        keys = spec.version_key
        same = F.lit(True)
        for key in keys:
            same = same & (F.col(f"b.{key}") == F.col(f"d.{key}"))
        order = [spec.version, LANDED_AT, *spec.tie_break]
        # Nulls are least in both; of equal rows the one that landed last wins, which is the delta's.
        wins = F.col(f"b.{keys[-1]}").isNull() | (
            F.col(f"d.{keys[-1]}").isNotNull() & (F.struct(*[F.col(f"d.{c}") for c in order]) >= F.struct(*[F.col(f"b.{c}") for c in order]))
        )
        columns = [F.when(wins, F.col(f"d.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in stored.columns]
        return b.join(d, same, "full").select(*columns)
