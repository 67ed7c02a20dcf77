"""A warehouse resolves model names to DataFrames over a set of raw tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame

from storelake.sources.catalog import spec_of

Model = Callable[["Warehouse"], DataFrame]

# name -> (layer, function); filled by the @model decorator in dependency order.
MODELS: dict[str, tuple[str, Model]] = {}

LAYERS = ("staging", "intermediate", "marts")
# Stored layers; staging stays a lazy view over the raw tables.
TABLE_LAYERS = ("intermediate", "marts")
# Staged tables that more than one of them reads.
SHARED_STAGING = ("stg_transactions", "stg_transaction_items", "stg_transaction_promotions", "stg_promotions")


def model(layer: str) -> Callable[[Model], Model]:
    def register(fn: Model) -> Model:
        MODELS[fn.__name__] = (layer, fn)
        return fn

    return register


class Warehouse:
    """Lazily composed models.

    ``raw`` maps table names to DataFrames holding all row versions.  Models call
    ``wh["stg_transactions"]`` and so on, so a question pulls in just the models it
    needs as one logical plan; ``materialize`` cuts that plan at stored tables.
    """

    def __init__(self, raw: Mapping[str, DataFrame], loaded_at: Column | None = None):
        for name in raw:
            spec_of(name)
        self.raw = raw
        self.loaded_at = loaded_at
        self._built: dict[str, DataFrame] = {}
        self.stored: dict[str, DataFrame] = {}
        # Newest rows of raw tables, where they are stored (see ``above``).
        self.newest: dict[str, DataFrame] = {}
        self._given: dict[str, DataFrame] = {}
        self._uses: dict[str, set[str]] = {}
        self._open: list[str] = []

    @classmethod
    def open(cls, raw: Mapping[str, DataFrame], path: str, names: Iterable[str] | None = None, **options) -> Warehouse:
        """A warehouse over models another session stored below ``path`` (all table layers by default)."""
        self = cls(raw, **options)
        chosen = [n for n, (layer, _) in MODELS.items() if layer in TABLE_LAYERS] if names is None else list(names)
        # Composed only for its declared schema; no job runs.
        self._keep({name: _reopened(self[name], f"{path}/{name}") for name in chosen})
        return self

    def __getitem__(self, name: str) -> DataFrame:
        for user in self._open:
            # A model built before was not entered again, so what it uses is taken from it.
            self._uses.setdefault(user, set()).update({name} | self._uses.get(name, set()))
        if name not in self._built:
            if name not in MODELS:
                raise KeyError(f"no such model: {name}")
            self._open.append(name)
            try:
                self._built[name] = MODELS[name][1](self)
            finally:
                self._open.pop()
        return self._built[name]

    def _keep(self, stored: Mapping[str, DataFrame]) -> None:
        """Take up stored models; those composed before are composed anew above them."""
        self.stored.update(stored)
        self._built = dict(self.stored)

    def over(self, frames: Mapping[str, DataFrame]) -> Warehouse:
        """This warehouse with given frames for some models; those above are composed from them."""
        self._keep(frames)
        return self

    def replace(self, name: str, df: DataFrame) -> Warehouse:
        """The same warehouse with one model substituted; models above it follow, other stored
        ones are carried on."""
        other = Warehouse(self.raw, self.loaded_at)
        other._uses = {k: set(v) for k, v in self._uses.items()}
        other.stored = {k: v for k, v in self.stored.items() if k != name and name not in self._uses.get(k, ())}
        other._given = {name: df}
        other._built = {**other.stored, name: df}
        other.newest = dict(self.newest)
        return other

    def above(self, newest: Mapping[str, DataFrame] | None = None, frames: Mapping[str, DataFrame] | None = None) -> Warehouse:
        """Another warehouse that takes the newest rows of some raw tables, and some models, from
        given frames.  What is stored or substituted here is carried on, the rest is composed anew."""
        other = Warehouse(self.raw, self.loaded_at)
        other._uses = {k: set(v) for k, v in self._uses.items()}
        other.newest = {**self.newest, **(newest or {})}
        other.stored = {**self.stored, **(frames or {})}
        other._given = dict(self._given)
        other._built = {**other._given, **other.stored}
        return other

    def has(self, name: str) -> bool:
        """Whether a model is stored or substituted, not composed."""
        return name in self.stored or name in self._given

    def uses(self, name: str) -> set[str]:
        """The models a model is composed of, itself included."""
        self[name]
        return {name} | (set() if self.has(name) else self._uses.get(name, set()))

    def materialize(
        self,
        path: str,
        names: Iterable[str] | None = None,
        layers: Iterable[str] = TABLE_LAYERS,
        side_by_side: int = 4,
    ) -> Warehouse:
        """Write models as parquet and read them back from there.

        Tenant-scoped tables are partitioned by tenant, so tenant questions prune.  The
        write keeps the partitioning the plan produced; it never gathers one tenant
        into one task.  Staged tables that several stored models read are written once, below
        ``_staged``, so each raw table is sorted out by version once.
        """
        if names is None and "staging" not in layers:
            self.materialize(f"{path}/_staged", names=SHARED_STAGING)
        wanted = set(names) if names is not None else None
        for layer in LAYERS:
            chosen = [
                name
                for name, (its_layer, _) in MODELS.items()
                if its_layer == layer
                and (layer in layers if wanted is None else name in wanted)
            ]
            # Composed before the writes start; tables of one layer are independent, and
            # small ones leave most executors idle, so a few are written side by side.
            frames = {name: self[name] for name in chosen}
            with ThreadPoolExecutor(max_workers=side_by_side) as pool:
                stored = pool.map(lambda name: _stored(frames[name], f"{path}/{name}"), chosen)
                self._keep(dict(zip(chosen, stored, strict=True)))
        return self


def _stored(df: DataFrame, target: str) -> DataFrame:
    tenant_scoped = "tenant_id" in df.columns
    rows = df
    if tenant_scoped and "date_key" in df.columns:
        # The partitioned write sorts by tenant anyway; days in order let a date filter
        # skip row groups.
        rows = df.sortWithinPartitions("tenant_id", "date_key")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if tenant_scoped:
        writer = writer.partitionBy("tenant_id")
    writer.parquet(target)
    return _reopened(df, target)


def _reopened(df: DataFrame, target: str) -> DataFrame:
    # Declared schema with tenant as text: partition values are never guessed.
    return df.sparkSession.read.schema(df.schema).parquet(target).select(*df.columns)
