"""Staging: newest version of each raw table, cleaned and given surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions import date_key, surrogate_key
from storelake.operators.versions import current_rows
from storelake.plans.warehouse import Warehouse, model
from storelake.sources.bases import Bases
from storelake.sources.catalog import spec_of

# Reference tables sit on the optional side of left joins; declaring their keys
# unique lets the optimizer drop such a join when its columns are not used.
_LOOKUPS = {"products", "stores", "employees"}


def _current(wh: Warehouse, table: str) -> DataFrame:
    if table in wh.newest:
        return wh.newest[table]
    if isinstance(wh.raw, Bases) and table not in _LOOKUPS:
        return wh.raw.current(table)
    return current_rows(wh.raw[table], spec_of(table), declare_unique=table in _LOOKUPS)


def _key(*columns: str, name: str) -> Column:
    return surrogate_key("tenant_id", *columns).alias(name)


@model("staging")
def stg_customers(wh: Warehouse) -> DataFrame:
    return _current(wh, "customers").select(
        _key("customer_id", name="customer_sk"),
        "tenant_id",
        "customer_id",
        F.trim("name").alias("customer_name"),
        "phone",
        F.lower("email").alias("email"),
        "gender",
        "city",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_products(wh: Warehouse) -> DataFrame:
    return _current(wh, "products").select(
        _key("product_id", name="product_sk"),
        "tenant_id",
        "product_id",
        F.trim("product_name").alias("product_name"),
        "category",
        "brand",
        "unit_price",
        "is_active",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_stores(wh: Warehouse) -> DataFrame:
    return _current(wh, "stores").select(
        _key("store_id", name="store_sk"),
        "tenant_id",
        "store_id",
        F.trim("store_name").alias("store_name"),
        "city",
        "province",
        "store_type",
        "opened_at",
        "is_active",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_suppliers(wh: Warehouse) -> DataFrame:
    return _current(wh, "suppliers").select(
        _key("supplier_id", name="supplier_sk"),
        "tenant_id",
        "supplier_id",
        "supplier_name",
        "contact_name",
        "city",
        "country",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_promotions(wh: Warehouse) -> DataFrame:
    return _current(wh, "promotions").select(
        _key("promo_id", name="promo_sk"),
        "tenant_id",
        "promo_id",
        "promo_name",
        "promo_type",
        "discount_pct",
        "start_date",
        "end_date",
        "min_purchase",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_transactions(wh: Warehouse) -> DataFrame:
    """Completed transactions.  The filter follows the version choice: a transaction
    whose newest state is another one must not fall back to an older, completed row."""
    completed = _current(wh, "transactions").filter(F.col("status") == "completed")
    return completed.select(
        _key("transaction_id", name="transaction_sk"),
        "tenant_id",
        "transaction_id",
        _key("customer_id", name="customer_sk"),
        _key("store_id", name="store_sk"),
        _key("employee_id", name="employee_sk"),
        "customer_id",
        "store_id",
        "employee_id",
        "transaction_date",
        date_key("transaction_date").alias("date_key"),
        "total_amount",
        F.lower("payment_method").alias("payment_method"),
        "status",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_transaction_items(wh: Warehouse) -> DataFrame:
    """Line items of all transactions, whatever their status."""
    return _current(wh, "transaction_items").select(
        _key("item_id", name="item_sk"),
        "tenant_id",
        "item_id",
        "transaction_id",
        _key("transaction_id", name="transaction_sk"),
        "product_id",
        _key("product_id", name="product_sk"),
        "quantity",
        "unit_price",
        "discount",
        "subtotal",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_transaction_promotions(wh: Warehouse) -> DataFrame:
    return _current(wh, "transaction_promotions").select(
        _key("id", name="txn_promo_sk"),
        "tenant_id",
        F.col("id").alias("txn_promo_id"),
        "transaction_id",
        _key("transaction_id", name="transaction_sk"),
        "promo_id",
        _key("promo_id", name="promo_sk"),
        "discount_applied",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_employees(wh: Warehouse) -> DataFrame:
    return _current(wh, "employees").select(
        _key("employee_id", name="employee_sk"),
        "tenant_id",
        "employee_id",
        _key("store_id", name="store_sk"),
        "store_id",
        F.trim("name").alias("employee_name"),
        F.lower("role").alias("role"),
        "hire_date",
        "is_active",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_inventory(wh: Warehouse) -> DataFrame:
    return _current(wh, "inventory").select(
        _key("inventory_id", name="inventory_sk"),
        "tenant_id",
        "inventory_id",
        _key("product_id", name="product_sk"),
        _key("store_id", name="store_sk"),
        _key("supplier_id", name="supplier_sk"),
        "product_id",
        "store_id",
        "supplier_id",
        "stock_qty",
        "reorder_level",
        "last_restocked",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_product_supplier(wh: Warehouse) -> DataFrame:
    return _current(wh, "product_supplier").select(
        _key("id", name="product_supplier_sk"),
        "tenant_id",
        F.col("id").alias("product_supplier_id"),
        _key("product_id", name="product_sk"),
        _key("supplier_id", name="supplier_sk"),
        "product_id",
        "supplier_id",
        "cost_price",
        "lead_time_days",
        "is_primary",
        "created_at",
        "updated_at",
    )


@model("staging")
def stg_customer_loyalty(wh: Warehouse) -> DataFrame:
    return _current(wh, "customer_loyalty").select(
        _key("loyalty_id", name="loyalty_sk"),
        "tenant_id",
        "loyalty_id",
        _key("customer_id", name="customer_sk"),
        "customer_id",
        F.lower("tier").alias("tier"),
        "points",
        "total_spend",
        "member_since",
        "created_at",
        "updated_at",
    )
