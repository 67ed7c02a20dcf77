"""Staging, intermediate, dimensions and facts in DuckDB SQL.  ``||`` keeps NULL keys NULL."""

from __future__ import annotations


def _newest(table: str, key: str, extra: str = "") -> str:
    return (
        f"(SELECT * FROM raw_{table} QUALIFY row_number() OVER "
        f"(PARTITION BY tenant_id, {key} ORDER BY updated_at DESC{extra}) = 1)"
    )


def _sk(column: str, name: str, alias: str = "") -> str:
    dot = f"{alias}." if alias else ""
    return f"{dot}tenant_id || '-' || CAST({dot}{column} AS VARCHAR) AS {name}"


MODEL_PARTS = {
    "stg_customers": f"""
SELECT {_sk('customer_id', 'customer_sk')}, tenant_id, customer_id, trim(name) AS customer_name,
       phone, lower(email) AS email, gender, city, created_at, updated_at
FROM {_newest('customers', 'customer_id')}""",
    "stg_products": f"""
SELECT {_sk('product_id', 'product_sk')}, tenant_id, product_id,
       trim(product_name) AS product_name, category, brand, unit_price, is_active,
       created_at, updated_at
FROM {_newest('products', 'product_id')}""",
    "stg_stores": f"""
SELECT {_sk('store_id', 'store_sk')}, tenant_id, store_id, trim(store_name) AS store_name, city,
       province, store_type, opened_at, is_active, created_at, updated_at
FROM {_newest('stores', 'store_id')}""",
    "stg_suppliers": f"""
SELECT {_sk('supplier_id', 'supplier_sk')}, tenant_id, supplier_id, supplier_name, contact_name,
       city, country, created_at, updated_at
FROM {_newest('suppliers', 'supplier_id')}""",
    "stg_promotions": f"""
SELECT {_sk('promo_id', 'promo_sk')}, tenant_id, promo_id, promo_name, promo_type, discount_pct,
       start_date, end_date, min_purchase, created_at, updated_at
FROM {_newest('promotions', 'promo_id')}""",
    "stg_transactions": f"""
SELECT {_sk('transaction_id', 'transaction_sk')}, tenant_id, transaction_id,
       {_sk('customer_id', 'customer_sk')}, {_sk('store_id', 'store_sk')},
       {_sk('employee_id', 'employee_sk')}, customer_id, store_id, employee_id, transaction_date,
       CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
       total_amount, lower(payment_method) AS payment_method, status, created_at, updated_at
FROM {_newest('transactions', 'transaction_id')}
WHERE status = 'completed'""",
    "stg_transaction_items": f"""
SELECT {_sk('item_id', 'item_sk')}, tenant_id, item_id, transaction_id,
       {_sk('transaction_id', 'transaction_sk')}, product_id, {_sk('product_id', 'product_sk')},
       quantity, unit_price, discount, subtotal, created_at, updated_at
FROM {_newest('transaction_items', 'item_id',
              ', subtotal DESC, product_id DESC')}""",
    "stg_transaction_promotions": f"""
SELECT {_sk('id', 'txn_promo_sk')}, tenant_id, id AS txn_promo_id, transaction_id,
       {_sk('transaction_id', 'transaction_sk')}, promo_id, {_sk('promo_id', 'promo_sk')},
       discount_applied, created_at, updated_at
FROM {_newest('transaction_promotions', 'id')}""",
    "stg_employees": f"""
SELECT {_sk('employee_id', 'employee_sk')}, tenant_id, employee_id, {_sk('store_id', 'store_sk')},
       store_id, trim(name) AS employee_name, lower(role) AS role, hire_date, is_active,
       created_at, updated_at
FROM {_newest('employees', 'employee_id')}""",
    "stg_inventory": f"""
SELECT {_sk('inventory_id', 'inventory_sk')}, tenant_id, inventory_id,
       {_sk('product_id', 'product_sk')}, {_sk('store_id', 'store_sk')},
       {_sk('supplier_id', 'supplier_sk')}, product_id, store_id, supplier_id, stock_qty,
       reorder_level, last_restocked, created_at, updated_at
FROM {_newest('inventory', 'inventory_id')}""",
    "stg_product_supplier": f"""
SELECT {_sk('id', 'product_supplier_sk')}, tenant_id, id AS product_supplier_id,
       {_sk('product_id', 'product_sk')}, {_sk('supplier_id', 'supplier_sk')}, product_id,
       supplier_id, cost_price, lead_time_days, is_primary, created_at, updated_at
FROM {_newest('product_supplier', 'id')}""",
    "stg_customer_loyalty": f"""
SELECT {_sk('loyalty_id', 'loyalty_sk')}, tenant_id, loyalty_id,
       {_sk('customer_id', 'customer_sk')}, customer_id, lower(tier) AS tier, points, total_spend,
       member_since, created_at, updated_at
FROM {_newest('customer_loyalty', 'loyalty_id')}""",
    "int_primary_cost": """
SELECT product_sk, tenant_id, product_id, supplier_sk AS primary_supplier_sk, cost_price
FROM stg_product_supplier
WHERE is_primary
QUALIFY row_number() OVER (PARTITION BY product_sk
                           ORDER BY updated_at DESC, product_supplier_id DESC) = 1""",
    "int_sales_enriched": """
SELECT li.item_sk AS sales_sk, li.tenant_id, li.transaction_sk, li.transaction_id, hd.date_key,
       hd.transaction_date, hd.customer_sk, hd.store_sk, st.city AS store_city, hd.employee_sk,
       em.employee_name, em.role AS employee_role, li.product_sk, pr.product_name, pr.category,
       ct.primary_supplier_sk, li.quantity, li.unit_price, li.subtotal AS net_amount,
       li.quantity * li.unit_price AS gross_amount,
       ifnull(ct.cost_price, 0) AS cost_price,
       li.quantity * ifnull(ct.cost_price, 0) AS cost_amount,
       li.subtotal - li.quantity * ifnull(ct.cost_price, 0) AS margin_amount
FROM stg_transactions AS hd
JOIN stg_transaction_items AS li USING (transaction_sk)
LEFT JOIN stg_products AS pr ON pr.product_sk = li.product_sk
LEFT JOIN int_primary_cost AS ct ON ct.product_sk = li.product_sk
LEFT JOIN stg_stores AS st ON st.store_sk = hd.store_sk
LEFT JOIN stg_employees AS em ON em.employee_sk = hd.employee_sk""",
    "dim_customer": """
SELECT customer_sk, tenant_id, customer_id, customer_name, phone, email, gender, city,
       created_at AS customer_since
FROM stg_customers""",
    "dim_product": """
SELECT product_sk, tenant_id, product_id, product_name, category, brand, unit_price, is_active
FROM stg_products""",
    "dim_store": """
SELECT store_sk, tenant_id, store_id, store_name, city, province, store_type, opened_at, is_active
FROM stg_stores""",
    "dim_promotion": """
SELECT promo_sk, tenant_id, promo_id, promo_name, promo_type, discount_pct, start_date, end_date,
       min_purchase
FROM stg_promotions""",
    "dim_employee": """
SELECT employee_sk, tenant_id, employee_id, store_sk, store_id, employee_name, role, hire_date,
       is_active
FROM stg_employees""",
    "dim_supplier": """
SELECT supplier_sk, tenant_id, supplier_id, supplier_name, contact_name, city, country
FROM stg_suppliers""",
    "dim_date": """
SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, date_day,
       CAST(year(date_day) AS INTEGER) AS year, CAST(quarter(date_day) AS INTEGER) AS quarter,
       CAST(month(date_day) AS INTEGER) AS month, strftime(date_day, '%Y-%m') AS year_month,
       strftime(date_day, '%b') AS month_name, CAST(day(date_day) AS INTEGER) AS day_of_month,
       CAST(isodow(date_day) AS INTEGER) AS day_of_week, strftime(date_day, '%a') AS day_name,
       CASE WHEN isodow(date_day) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min(CAST(transaction_date AS DATE)),
                                         max(CAST(transaction_date AS DATE)),
                                         INTERVAL 1 DAY)) AS DATE) AS date_day
      FROM stg_transactions) AS days""",
    "dim_loyalty_tier": """
SELECT tier AS tier_sk, tier, tier_rank, CAST(min_spend AS DECIMAL(18,2)) AS min_spend
FROM (VALUES ('bronze', 1, 0), ('silver', 2, 500000), ('gold', 3, 1500000),
             ('platinum', 4, 3000000)) AS tiers(tier, tier_rank, min_spend)""",
    "fact_sales": """
SELECT li.item_sk AS sales_sk, li.tenant_id, li.transaction_sk, li.transaction_id, hd.date_key,
       hd.transaction_date, hd.customer_sk, hd.store_sk, hd.employee_sk, li.product_sk,
       li.product_id, li.quantity, li.unit_price, li.discount AS line_discount_pct,
       li.quantity * li.unit_price AS gross_amount, li.subtotal AS net_amount, hd.payment_method,
       ifnull(pm.given, 0) AS txn_promo_discount,
       CASE WHEN pm.uses IS NULL THEN 0 ELSE 1 END AS is_promo_transaction
FROM stg_transactions AS hd
JOIN stg_transaction_items AS li USING (transaction_sk)
LEFT JOIN (SELECT transaction_sk, sum(discount_applied) AS given, count(*) AS uses
           FROM stg_transaction_promotions GROUP BY 1) AS pm USING (transaction_sk)""",
    "fact_promotion_usage": """
SELECT us.txn_promo_sk, us.tenant_id, us.transaction_sk, us.transaction_id, us.promo_sk,
       hd.store_sk, hd.customer_sk, hd.date_key, hd.transaction_date, us.discount_applied,
       hd.total_amount AS transaction_amount
FROM stg_transactions AS hd JOIN stg_transaction_promotions AS us USING (transaction_sk)""",
    "fact_inventory_movement": """
SELECT inv.inventory_sk, inv.tenant_id, inv.store_sk, inv.product_sk, inv.supplier_sk,
       inv.stock_qty, inv.reorder_level, ifnull(moved.units, 0) AS qty_sold,
       CASE WHEN inv.stock_qty > 0
            THEN floor(CAST(ifnull(moved.units, 0) AS DOUBLE) / inv.stock_qty * 10000.0 + 0.5)
                 / 10000.0
            ELSE 0.0 END AS turnover_rate,
       CASE WHEN inv.stock_qty <= inv.reorder_level THEN 1 ELSE 0 END AS below_reorder,
       inv.last_restocked
FROM stg_inventory AS inv
LEFT JOIN (SELECT store_sk, product_sk, CAST(sum(quantity) AS BIGINT) AS units
           FROM int_sales_enriched GROUP BY ALL) AS moved
       ON moved.store_sk = inv.store_sk AND moved.product_sk = inv.product_sk""",
    "fact_loyalty_activity": """
SELECT loyalty_sk, tenant_id, customer_sk, customer_id, tier AS tier_sk, tier, points,
       total_spend AS recorded_total_spend, member_since
FROM stg_customer_loyalty""",
}
