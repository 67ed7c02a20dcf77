"""Every declared check, written out (layer, model, column, kind, severity, values, parent, parent column)."""

from __future__ import annotations

from typing import NamedTuple


class Declared(NamedTuple):
    layer: str
    model: str
    column: str
    kind: str
    label: str
    severity: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""


CHECKS = [
    Declared("staging", "raw.customers", "customer_id", "not_null", "not_null", "error"),
    Declared("staging", "raw.products", "product_id", "not_null", "not_null", "error"),
    Declared("staging", "raw.products", "unit_price", "not_null", "not_null", "error"),
    Declared("staging", "raw.stores", "store_id", "not_null", "not_null", "error"),
    Declared("staging", "raw.suppliers", "supplier_id", "not_null", "not_null", "error"),
    Declared("staging", "raw.promotions", "promo_id", "not_null", "not_null", "error"),
    Declared("staging", "raw.transactions", "transaction_id", "not_null", "not_null", "error"),
    Declared("staging", "raw.transactions", "transaction_date", "not_null", "not_null", "error"),
    Declared("staging", "raw.transactions", "total_amount", "not_null", "not_null", "error"),
    Declared("staging", "raw.transaction_items", "item_id", "not_null", "not_null", "error"),
    Declared("staging", "raw.transaction_items", "quantity", "not_null", "not_null", "error"),
    Declared("staging", "raw.transaction_promotions", "id", "not_null", "not_null", "error"),
    Declared("staging", "raw.employees", "employee_id", "not_null", "not_null", "error"),
    Declared("staging", "raw.inventory", "inventory_id", "not_null", "not_null", "error"),
    Declared("staging", "raw.inventory", "stock_qty", "not_null", "not_null", "error"),
    Declared("staging", "raw.product_supplier", "id", "not_null", "not_null", "error"),
    Declared("staging", "raw.customer_loyalty", "loyalty_id", "not_null", "not_null", "error"),
    Declared("staging", "stg_customers", "customer_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_customers", "customer_sk", "unique", "unique", "error"),
    Declared("staging", "stg_customers", "customer_id", "not_null", "not_null", "error"),
    Declared("staging", "stg_customers", "gender", "accepted_values", "accepted_values", "warn", values=("Male", "Female")),
    Declared("staging", "stg_products", "product_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_products", "product_sk", "unique", "unique", "error"),
    Declared("staging", "stg_products", "unit_price", "not_null", "not_null", "error"),
    Declared("staging", "stg_products", "product_id", "not_null", "not_null", "error"),
    Declared("staging", "stg_stores", "store_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_stores", "store_sk", "unique", "unique", "error"),
    Declared("staging", "stg_stores", "store_type", "accepted_values", "accepted_values", "warn", values=("minimarket", "supermarket", "express")),
    Declared("staging", "stg_suppliers", "supplier_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_suppliers", "supplier_sk", "unique", "unique", "error"),
    Declared("staging", "stg_promotions", "promo_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_promotions", "promo_sk", "unique", "unique", "error"),
    Declared("staging", "stg_promotions", "promo_type", "accepted_values", "accepted_values", "warn", values=("discount", "bundle", "cashback")),
    Declared("staging", "stg_transactions", "transaction_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_transactions", "transaction_sk", "unique", "unique", "error"),
    Declared("staging", "stg_transactions", "customer_sk", "relationships", "relationships:stg_customers", "error", parent="stg_customers", parent_column="customer_sk"),
    Declared("staging", "stg_transactions", "store_sk", "relationships", "relationships:stg_stores", "warn", parent="stg_stores", parent_column="store_sk"),
    Declared("staging", "stg_transactions", "payment_method", "accepted_values", "accepted_values", "error", values=("cash", "debit", "credit", "e-wallet")),
    Declared("staging", "stg_transactions", "status", "accepted_values", "accepted_values", "error", values=("completed",)),
    Declared("staging", "stg_transaction_items", "item_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_transaction_items", "item_sk", "unique", "unique", "error"),
    Declared("staging", "stg_transaction_items", "product_sk", "relationships", "relationships:stg_products", "error", parent="stg_products", parent_column="product_sk"),
    Declared("staging", "stg_transaction_items", "quantity", "not_null", "not_null", "error"),
    Declared("staging", "stg_transaction_promotions", "txn_promo_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_transaction_promotions", "txn_promo_sk", "unique", "unique", "error"),
    Declared("staging", "stg_transaction_promotions", "promo_sk", "relationships", "relationships:stg_promotions", "error", parent="stg_promotions", parent_column="promo_sk"),
    Declared("staging", "stg_employees", "employee_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_employees", "employee_sk", "unique", "unique", "error"),
    Declared("staging", "stg_employees", "store_sk", "relationships", "relationships:stg_stores", "warn", parent="stg_stores", parent_column="store_sk"),
    Declared("staging", "stg_employees", "role", "accepted_values", "accepted_values", "warn", values=("cashier", "supervisor", "manager")),
    Declared("staging", "stg_inventory", "inventory_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_inventory", "inventory_sk", "unique", "unique", "error"),
    Declared("staging", "stg_inventory", "product_sk", "relationships", "relationships:stg_products", "warn", parent="stg_products", parent_column="product_sk"),
    Declared("staging", "stg_inventory", "stock_qty", "not_null", "not_null", "error"),
    Declared("staging", "stg_product_supplier", "product_supplier_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_product_supplier", "product_supplier_sk", "unique", "unique", "error"),
    Declared("staging", "stg_product_supplier", "supplier_sk", "relationships", "relationships:stg_suppliers", "warn", parent="stg_suppliers", parent_column="supplier_sk"),
    Declared("staging", "stg_customer_loyalty", "loyalty_sk", "not_null", "not_null", "error"),
    Declared("staging", "stg_customer_loyalty", "loyalty_sk", "unique", "unique", "error"),
    Declared("staging", "stg_customer_loyalty", "customer_sk", "relationships", "relationships:stg_customers", "warn", parent="stg_customers", parent_column="customer_sk"),
    Declared("staging", "stg_customer_loyalty", "tier", "accepted_values", "accepted_values", "error", values=("bronze", "silver", "gold", "platinum")),
    Declared("marts", "dim_customer", "customer_sk", "not_null", "not_null", "error"),
    Declared("marts", "dim_customer", "customer_sk", "unique", "unique", "error"),
    Declared("marts", "dim_product", "product_sk", "not_null", "not_null", "error"),
    Declared("marts", "dim_product", "product_sk", "unique", "unique", "error"),
    Declared("marts", "dim_product", "category", "not_null", "not_null", "warn"),
    Declared("marts", "dim_store", "store_sk", "not_null", "not_null", "error"),
    Declared("marts", "dim_store", "store_sk", "unique", "unique", "error"),
    Declared("marts", "dim_promotion", "promo_sk", "not_null", "not_null", "error"),
    Declared("marts", "dim_promotion", "promo_sk", "unique", "unique", "error"),
    Declared("marts", "dim_date", "date_key", "not_null", "not_null", "error"),
    Declared("marts", "dim_date", "date_key", "unique", "unique", "error"),
    Declared("marts", "dim_date", "day_of_week", "accepted_values", "accepted_values", "error", values=(1, 2, 3, 4, 5, 6, 7)),
    Declared("marts", "fact_sales", "sales_sk", "not_null", "not_null", "error"),
    Declared("marts", "fact_sales", "sales_sk", "unique", "unique", "error"),
    Declared("marts", "fact_sales", "customer_sk", "relationships", "relationships:dim_customer", "error", parent="dim_customer", parent_column="customer_sk"),
    Declared("marts", "fact_sales", "product_sk", "relationships", "relationships:dim_product", "error", parent="dim_product", parent_column="product_sk"),
    Declared("marts", "fact_sales", "store_sk", "relationships", "relationships:dim_store", "warn", parent="dim_store", parent_column="store_sk"),
    Declared("marts", "fact_sales", "date_key", "relationships", "relationships:dim_date", "error", parent="dim_date", parent_column="date_key"),
    Declared("marts", "fact_sales", "net_amount", "not_null", "not_null", "error"),
    Declared("marts", "fact_promotion_usage", "txn_promo_sk", "not_null", "not_null", "error"),
    Declared("marts", "fact_promotion_usage", "txn_promo_sk", "unique", "unique", "error"),
    Declared("marts", "fact_promotion_usage", "promo_sk", "relationships", "relationships:dim_promotion", "error", parent="dim_promotion", parent_column="promo_sk"),
    Declared("marts", "fact_promotion_usage", "transaction_sk", "relationships", "relationships:fact_sales", "warn", parent="fact_sales", parent_column="transaction_sk"),
    Declared("marts", "int_sales_enriched", "sales_sk", "not_null", "not_null", "error"),
    Declared("marts", "int_sales_enriched", "sales_sk", "unique", "unique", "error"),
    Declared("marts", "int_sales_enriched", "net_amount", "not_null", "not_null", "error"),
    Declared("marts", "dim_employee", "employee_sk", "not_null", "not_null", "error"),
    Declared("marts", "dim_employee", "employee_sk", "unique", "unique", "error"),
    Declared("marts", "dim_employee", "role", "accepted_values", "accepted_values", "warn", values=("cashier", "supervisor", "manager")),
    Declared("marts", "dim_supplier", "supplier_sk", "not_null", "not_null", "error"),
    Declared("marts", "dim_supplier", "supplier_sk", "unique", "unique", "error"),
    Declared("marts", "dim_loyalty_tier", "tier_sk", "not_null", "not_null", "error"),
    Declared("marts", "dim_loyalty_tier", "tier_sk", "unique", "unique", "error"),
    Declared("marts", "dim_loyalty_tier", "tier", "accepted_values", "accepted_values", "error", values=("bronze", "silver", "gold", "platinum")),
    Declared("marts", "fact_inventory_movement", "inventory_sk", "not_null", "not_null", "error"),
    Declared("marts", "fact_inventory_movement", "inventory_sk", "unique", "unique", "error"),
    Declared("marts", "fact_inventory_movement", "product_sk", "relationships", "relationships:dim_product", "warn", parent="dim_product", parent_column="product_sk"),
    Declared("marts", "fact_inventory_movement", "stock_qty", "not_null", "not_null", "error"),
    Declared("marts", "fact_loyalty_activity", "loyalty_sk", "not_null", "not_null", "error"),
    Declared("marts", "fact_loyalty_activity", "loyalty_sk", "unique", "unique", "error"),
    Declared("marts", "fact_loyalty_activity", "tier_sk", "relationships", "relationships:dim_loyalty_tier", "warn", parent="dim_loyalty_tier", parent_column="tier_sk"),
    Declared("marts", "fact_loyalty_activity", "customer_sk", "relationships", "relationships:dim_customer", "warn", parent="dim_customer", parent_column="customer_sk"),
]
