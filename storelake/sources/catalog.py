"""The twelve point-of-sale tables: columns, key and version column of each.

The catalog is the single copy: readers, loaders, quality checks and tests all
take the table list, its order and its types from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TENANT = "tenant_id"
LANDED_AT = "_extracted_at"

_TYPES = {
    "long": T.LongType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "money": T.DecimalType(18, 2),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    columns: tuple[tuple[str, str, bool], ...]  # (column, type word, nullable)
    version: str = "updated_at"
    # Settles rows of one key that share version and load time.
    tie_break: tuple[str, ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [name for name, _, _ in self.columns]

    @property
    def source_schema(self) -> T.StructType:
        """Columns of the table inside one tenant's source database."""
        return T.StructType([T.StructField(n, _TYPES[t], null) for n, t, null in self.columns])

    @property
    def raw_schema(self) -> T.StructType:
        """Columns of the landed table: tenant first, load time last."""
        return T.StructType(
            [T.StructField(TENANT, T.StringType(), False)]
            + self.source_schema.fields
            + [T.StructField(LANDED_AT, T.TimestampType(), False)]
        )

    @property
    def version_key(self) -> list[str]:
        # The selective column leads: sorts then compare 64-bit prefixes, not tenant names.
        return [self.key, TENANT]


def columns_of(layout: str) -> tuple[tuple[str, str, bool], ...]:
    """One ``column type`` pair per entry; ``?`` marks a nullable column."""
    pairs = [entry.split() for entry in layout.split(",")]
    return tuple((column, kind.rstrip("?"), kind.endswith("?")) for column, kind in pairs)


def _table(name: str, key: str, layout: str, tie_break: tuple[str, ...] = ()) -> TableSpec:
    stamps = "created_at timestamp, updated_at timestamp"
    return TableSpec(name, key, columns_of(f"{layout}, {stamps}"), tie_break=tie_break)


_SPECS = [
    _table(
        "customers",
        "customer_id",
        "customer_id long, name string, phone string?, email string?, gender string?, city string?",
    ),
    _table(
        "products",
        "product_id",
        "product_id long, product_name string, category string?, brand string?,"
        " unit_price money, is_active bool",
    ),
    _table(
        "stores",
        "store_id",
        "store_id long, store_name string, city string?, province string?, store_type string?,"
        " opened_at date?, is_active bool",
    ),
    _table(
        "suppliers",
        "supplier_id",
        "supplier_id long, supplier_name string?, contact_name string?, city string?,"
        " country string?",
    ),
    _table(
        "promotions",
        "promo_id",
        "promo_id long, promo_name string?, promo_type string?, discount_pct money?,"
        " start_date date?, end_date date?, min_purchase money?",
    ),
    _table(
        "transactions",
        "transaction_id",
        "transaction_id long, customer_id long?, store_id long?, employee_id long?,"
        " transaction_date timestamp, total_amount money, payment_method string?, status string?",
    ),
    _table(
        "transaction_items",
        "item_id",
        "item_id long, transaction_id long, product_id long?, quantity long, unit_price money,"
        " discount money, subtotal money",
        ("subtotal", "product_id"),
    ),
    _table(
        "transaction_promotions",
        "id",
        "id long, transaction_id long, promo_id long?, discount_applied money?",
    ),
    _table(
        "employees",
        "employee_id",
        "employee_id long, store_id long?, name string, role string?, hire_date date?,"
        " is_active bool",
    ),
    _table(
        "inventory",
        "inventory_id",
        "inventory_id long, product_id long?, store_id long?, supplier_id long?, stock_qty long,"
        " reorder_level long, last_restocked timestamp?",
    ),
    _table(
        "product_supplier",
        "id",
        "id long, product_id long?, supplier_id long?, cost_price money?, lead_time_days long?,"
        " is_primary bool",
    ),
    _table(
        "customer_loyalty",
        "loyalty_id",
        "loyalty_id long, customer_id long?, tier string?, points long, total_spend money,"
        " member_since date?",
    ),
]

CATALOG: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}


class UnknownTable(ValueError):
    """A table name that is not in the catalog."""


def spec_of(name: str) -> TableSpec:
    try:
        return CATALOG[name]
    except KeyError:
        raise UnknownTable(f"unknown table: {name}") from None
