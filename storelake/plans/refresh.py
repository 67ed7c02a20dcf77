"""Refreshing stored facts from a change set.

A line's row in a fact depends on its transaction's header, lines and promotions, and on product,
store, clerk and cost.  So the transactions that changed rows touch, before or after the change, are
recomputed as a whole through the ordinary models over raw tables cut down to them, and take the place of
their rows in the stored fact.  The stored rows are not rewritten: the refreshed frame is the
stored one without those transactions, and the recomputed ones, which are stored beside it when
more than one reader is expected.

As long as the touched keys are below Spark's broadcast limit, raw tables are cut down by semi-joins
with them, before any version is chosen or any row moves.  A line that moved between transactions
keeps all its versions, so its newest one decides where it is.  Beyond the limit such a cut would
itself move the raw lines, so the headers alone are cut, and the lines meet them in the join that
the fact has anyway.  Stored rows are then found by the untouched keys if those are below the limit;
else they move, with ids instead of surrogate keys.

``changes``: the raw rows that landed since the stored facts were built, any versions, by table
(``LandingZone.since``); tables without changes may be left out.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions import surrogate_key
from storelake.plans.warehouse import Warehouse
from storelake.session import sized, written
from storelake.sources.catalog import TENANT, spec_of

TRANSACTION = [TENANT, "transaction_id"]
PLACE = [TENANT, "store_sk", "product_sk"]
# Raw tables whose rows name a transaction, and those that rows of a fact name by a surrogate key.
OF_TRANSACTIONS = ("transactions", "transaction_items", "transaction_promotions")
NAMED_BY = {"products": "product_sk", "product_supplier": "product_sk", "stores": "store_sk", "employees": "employee_sk"}
# Columns of the line fact that a refresh of the stock fact reads.
STOCK_LINES = (*PLACE, "sales_sk", "transaction_id", "employee_sk", "quantity")
# Columns of the promotion fact that any refresh reads.
PROMOTION_USES = ("txn_promo_sk", *TRANSACTION)
KEY_COLUMN = {"product_sk": "product_id", "store_sk": "store_id", "employee_sk": "employee_id"}


def _together(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _keys_of(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c.endswith("_sk")]


def _with_ids(rows: DataFrame) -> DataFrame:
    """Rows of a line fact with the number each surrogate key holds after its tenant, to move them."""
    start = F.length(TENANT) + 2
    return rows.withColumns({key: F.substring(key, start, F.length(key)).cast("long") for key in _keys_of(rows)})


def _with_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumns({key: surrogate_key(TENANT, key) for key in _keys_of(rows)})


class Refresh:
    """Facts as a full rebuild over ``raw`` would give them, from the stored ones and the changes."""

    def __init__(
        self,
        stored: Warehouse,
        raw: Mapping[str, DataFrame],
        changes: Mapping[str, DataFrame],
        lines: str = "int_sales_enriched",
        read_once: bool = False,
    ):
        """``lines``: the stored line fact that tells which transactions rows belong to.
        ``read_once``: a refreshed line fact has one reader, so its recomputed rows are not stored."""
        self.stored = stored
        self.lines = lines
        self.read_once = read_once
        self._recomputed: dict[str, DataFrame] = {}
        self.raw = raw
        self.changes = {name: df for name, df in changes.items() if name in raw}

    def _named(self, table: str, key: str, column: str) -> DataFrame | None:
        """Surrogate keys of the changed rows of a table; they may repeat."""
        if table not in self.changes:
            return None
        # Stored, so its size is known: rows of a fact move only for a large change set.
        return written(self.changes[table].select(TENANT, column), "named").select(surrogate_key(TENANT, column).alias(key))

    @cached_property
    def _touched(self) -> tuple[DataFrame, bool]:
        lines = self.stored[self.lines]
        found = [self.changes[t].select(*TRANSACTION) for t in OF_TRANSACTIONS if t in self.changes]
        named = [("transaction_items", "sales_sk", "item_id"), *[(t, key, KEY_COLUMN[key]) for t, key in NAMED_BY.items()]]
        for table, key, column in named:
            keys = self._named(table, key, column)
            if keys is not None:
                found.append(lines.join(keys, key, "left_semi").select(*TRANSACTION))
        uses = self._named("transaction_promotions", "txn_promo_sk", "id")
        if uses is not None:
            found.append(self.stored["fact_promotion_usage"].join(uses, "txn_promo_sk", "left_semi").select(*TRANSACTION))
        if not found:
            return lines.select(*TRANSACTION).limit(0), True
        return sized(_together(found).distinct(), "touched")

    @property
    def touched(self) -> DataFrame:
        """(tenant_id, transaction_id) of the transactions to recompute."""
        return self._touched[0]

    @cached_property
    def part(self) -> Warehouse:
        """The models over the touched transactions only."""
        touched, small = self._touched
        cut = {"transactions": self.raw["transactions"].join(touched, TRANSACTION, "left_semi")}
        for table in OF_TRANSACTIONS[1:]:
            # A row without its key is no version of anything, cut or not.
            key = [TENANT, spec_of(table).key]
            rows = cut[table] = self.raw[table].dropna(subset=key)
            if not small:
                continue
            # All versions of what ever was in a touched transaction.
            mine, few = sized(rows.join(touched, TRANSACTION, "left_semi").select(*key).distinct(), "mine")
            if few:
                cut[table] = rows.join(mine, key, "left_semi")
        return Warehouse({**dict(self.raw.items()), **cut}, self.stored.loaded_at)

    def recomputed(self, name: str) -> DataFrame:
        """A line fact of the touched transactions, with the columns that are stored of it."""
        if name not in self._recomputed:
            # The part's headers are the touched ones, so lines that went elsewhere find none.
            mine = self.part[name].select(*self.stored[name].columns)
            self._recomputed[name] = mine if self.read_once else written(mine, f"part-{name}")
        return self._recomputed[name]

    def _line_fact(self, name: str) -> DataFrame:
        stored = self.stored[name]
        return self._kept(stored).unionByName(self.recomputed(name)).select(*stored.columns)

    def _kept(self, rows: DataFrame) -> DataFrame:
        """Stored lines of untouched transactions; they move only if neither those nor the touched ones are few."""
        touched, small = self._touched
        if small:
            return rows.join(touched, TRANSACTION, "left_anti")
        untouched = rows.select(*TRANSACTION).distinct().join(touched, TRANSACTION, "left_anti")
        others, few = sized(untouched, "untouched")
        if few:
            return rows.join(others, TRANSACTION, "left_semi")
        return _with_keys(_with_ids(rows).join(touched, TRANSACTION, "left_anti"))

    def int_sales_enriched(self) -> DataFrame:
        return self._line_fact("int_sales_enriched")

    def fact_sales(self) -> DataFrame:
        return self._line_fact("fact_sales")

    def fact_inventory_movement(self) -> DataFrame:
        """Stock rows that changed, and those whose store and product sold otherwise before or after."""
        stored = self.stored["fact_inventory_movement"]
        before = self.stored["int_sales_enriched"].join(self.touched, TRANSACTION, "left_semi").select(*PLACE)
        places = before.unionByName(self.recomputed("int_sales_enriched").select(*PLACE)).distinct()
        stock = Warehouse(self.raw, self.stored.loaded_at)["stg_inventory"]
        keys = [stock.join(places, PLACE, "left_semi").select("inventory_sk"), stored.join(places, PLACE, "left_semi").select("inventory_sk")]
        changed = self._named("inventory", "inventory_sk", "inventory_id")
        if changed is not None:
            keys.append(changed)
        renewed = written(_together(keys).distinct(), "renewed")
        mine = stock.join(renewed, "inventory_sk", "left_semi")
        sales = self.int_sales_enriched().join(mine.select(*PLACE).distinct(), PLACE, "left_semi")
        part = Warehouse(self.raw, self.stored.loaded_at).over({"stg_inventory": mine, "int_sales_enriched": sales})
        kept = stored.join(renewed, "inventory_sk", "left_anti")
        return kept.unionByName(part["fact_inventory_movement"]).select(*stored.columns)


REFRESHED = ("int_sales_enriched", "fact_sales", "fact_inventory_movement")


def refreshed(stored: Warehouse, raw: Mapping[str, DataFrame], changes: Mapping[str, DataFrame]) -> Warehouse:
    """A warehouse over ``raw`` whose line facts are refreshed; other models are composed anew."""
    work = Refresh(stored, raw, changes)
    return Warehouse(raw, stored.loaded_at).over({name: getattr(work, name)() for name in REFRESHED})
