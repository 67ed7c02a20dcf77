"""The twelve raw tables derived from the star tables, in DuckDB SQL (all versions)."""

from __future__ import annotations

_ALL = "(VALUES ('tenant_01'), ('tenant_02'), ('tenant_03')) AS every_tenant(tenant_id)"


def _tenant(key: str) -> str:
    return f"('tenant_0' || CAST({key} % 3 + 1 AS VARCHAR))"


def _day(start: str, key: str, spread: int) -> str:
    return f"CAST(DATE '{start}' + CAST({key} % {spread} AS INTEGER) AS DATE)"


def _at(start: str, key: str, spread: int) -> str:
    return f"CAST({_day(start, key, spread)} AS TIMESTAMP)"


def _stamps(key: str, start: str = "1993-01-01", spread: int = 700) -> str:
    at = _at(start, key, spread)
    return f"{at} AS created_at, {at} AS updated_at"


RAW_PARTS = {
    "raw_customers": f"""
SELECT tenant_id,
       c_custkey + 1 AS customer_id,
       CASE WHEN version = 0 THEN 'old ' || c_name ELSE '  ' || c_name || ' ' END AS name,
       '08' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone,
       upper('c' || CAST(c_custkey AS VARCHAR) || '@mail.test') AS email,
       CASE WHEN c_custkey % 53 = 0 THEN 'Other' WHEN c_custkey % 2 = 0 THEN 'Female'
            ELSE 'Male' END AS gender,
       n_name AS city,
       {_at('1993-01-01', 'c_custkey', 700)} AS created_at,
       CAST({_day('1993-01-01', 'c_custkey', 700)} + CAST(version * 30 AS INTEGER) AS TIMESTAMP)
           AS updated_at
FROM customer
JOIN nation ON c_nationkey = n_nationkey
JOIN (VALUES (0), (1)) AS versions(version) ON version = 1 OR c_mktsegment = 'BUILDING'
CROSS JOIN {_ALL}""",
    "raw_products": f"""
SELECT tenant_id,
       p_partkey + 1 AS product_id,
       ' ' || p_name || '  ' AS product_name,
       CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 41 = 0 THEN '' ELSE p_type END
           AS category,
       p_brand AS brand,
       CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
       p_partkey % 19 <> 0 AS is_active,
       {_stamps('p_partkey')}
FROM part CROSS JOIN {_ALL}""",
    "raw_stores": f"""
SELECT tenant_id,
       block + 1 AS store_id,
       ' Store ' || CAST(block + 1 AS VARCHAR) || ' ' AS store_name,
       n_name AS city,
       r_name AS province,
       CASE WHEN block % 11 = 10 THEN 'kiosk' WHEN block % 3 = 0 THEN 'minimarket'
            WHEN block % 3 = 1 THEN 'supermarket' ELSE 'express' END AS store_type,
       {_day('1990-01-01', 'block', 900)} AS opened_at,
       TRUE AS is_active,
       {_stamps('block')}
FROM (SELECT c_custkey // 50 AS block, arg_min(c_nationkey, c_custkey) AS home_nation
      FROM customer GROUP BY 1) AS blocks
JOIN nation ON home_nation = n_nationkey
JOIN region ON n_regionkey = r_regionkey
CROSS JOIN {_ALL}""",
    "raw_employees": f"""
SELECT tenant_id,
       block + 1 AS employee_id,
       first_customer // 50 + 1 AS store_id,
       ' Clerk ' || CAST(block % 40 AS VARCHAR) || ' ' AS name,
       CASE WHEN block % 23 = 22 THEN 'Trainee' WHEN block % 5 = 0 THEN 'Manager'
            WHEN block % 5 = 1 THEN 'SUPERVISOR' ELSE 'Cashier' END AS role,
       {_day('1991-01-01', 'block', 800)} AS hire_date,
       block % 17 <> 0 AS is_active,
       {_stamps('block')}
FROM (SELECT c_custkey // 10 AS block, min(c_custkey) AS first_customer
      FROM customer GROUP BY 1) AS crew
CROSS JOIN {_ALL}""",
    "raw_suppliers": f"""
SELECT tenant_id,
       s_suppkey + 1 AS supplier_id,
       s_name AS supplier_name,
       'Contact ' || CAST(s_suppkey AS VARCHAR) AS contact_name,
       n_name AS city,
       r_name AS country,
       {_stamps('s_suppkey')}
FROM supplier
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
CROSS JOIN {_ALL}""",
    "raw_promotions": f"""
SELECT tenant_id,
       block + 1 AS promo_id,
       'Campaign ' || CAST(block + 1 AS VARCHAR) AS promo_name,
       CASE block % 3 WHEN 0 THEN 'discount' WHEN 1 THEN 'bundle' ELSE 'cashback' END AS promo_type,
       CAST(3 + block % 13 AS DECIMAL(18,2)) AS discount_pct,
       {_day('1995-01-01', 'block', 900)} AS start_date,
       CAST({_day('1995-01-01', 'block', 900)} + 90 AS DATE) AS end_date,
       CAST(members * 1000 AS DECIMAL(18,2)) AS min_purchase,
       {_stamps('block')}
FROM (SELECT c_custkey // 15 AS block, count(*) AS members FROM customer GROUP BY 1) AS campaigns
CROSS JOIN {_ALL}""",
    "raw_product_supplier": f"""
SELECT tenant_id,
       p_partkey * 4 + slot + 1 AS id,
       p_partkey + 1 AS product_id,
       p_partkey // 20 - slot + 1 AS supplier_id,
       CAST(round(CAST(p_retailprice AS DECIMAL(18,2))
                  * CAST(55 + (p_partkey // 20 - slot) % 26 AS DECIMAL(5,0))
                  * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS cost_price,
       CAST(2 + slot * 3 AS BIGINT) AS lead_time_days,
       slot = 0 AS is_primary,
       {_stamps('p_partkey')}
FROM part
JOIN (VALUES (0), (1), (2)) AS slots(slot) ON slot < least(p_size % 4, p_partkey // 20 + 1)
CROSS JOIN {_ALL}""",
    "raw_inventory": f"""
SELECT tenant_id,
       p_partkey * 3 + slot + 1 AS inventory_id,
       p_partkey + 1 AS product_id,
       CASE slot WHEN 0 THEN home WHEN 1 THEN home - 1 ELSE 1 END AS store_id,
       p_partkey // 20 + 1 AS supplier_id,
       (p_partkey * 7 + slot * 13) % 60 AS stock_qty,
       5 + p_partkey % 16 AS reorder_level,
       CASE WHEN p_partkey % 17 <> 0 THEN {_at('2001-01-01', 'p_partkey', 200)} END
           AS last_restocked,
       {_stamps('p_partkey')}
FROM (SELECT p_partkey, p_partkey // 67 + 1 AS home FROM part) AS placed
JOIN (VALUES (0), (1), (2)) AS slots(slot) ON slot < least(home, 3)
CROSS JOIN {_ALL}""",
    "raw_customer_loyalty": f"""
SELECT tenant_id,
       c_custkey * 2 + card + 1 AS loyalty_id,
       c_custkey + 1 AS customer_id,
       CASE WHEN card = 1 THEN 'BRONZE' WHEN spend >= 3000000 THEN 'platinum'
            WHEN spend >= 1500000 THEN 'Gold' WHEN spend >= 500000 THEN 'SILVER'
            ELSE 'bronze' END AS tier,
       CAST(floor(CAST(spend AS DOUBLE) / 1000) AS BIGINT) AS points,
       CAST(spend AS DECIMAL(18,2)) AS total_spend,
       CAST({_day('1994-01-01', 'c_custkey', 500)} + CAST(card * 40 AS INTEGER) AS DATE)
           AS member_since,
       {_stamps('c_custkey', '1994-01-01', 500)}
FROM (SELECT *, greatest(CAST(c_acctbal AS DECIMAL(18,2)), 0) * 400 AS spend
      FROM customer WHERE c_mktsegment <> 'MACHINERY') AS members
JOIN (VALUES (0), (1)) AS cards(card) ON card = 0 OR c_mktsegment = 'AUTOMOBILE'
CROSS JOIN {_ALL}""",
    "raw_transactions": f"""
SELECT {_tenant('o_orderkey')} AS tenant_id,
       o_orderkey + 1 AS transaction_id,
       CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey + 1 END AS customer_id,
       CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey // 50 + 1 END AS store_id,
       CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey // 10 + 1 END AS employee_id,
       o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS INTEGER)) AS transaction_date,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit' WHEN '2-HIGH' THEN 'DEBIT'
            WHEN '3-MEDIUM' THEN 'e-Wallet' ELSE 'Cash' END AS payment_method,
       CASE WHEN version = 0 THEN 'pending' WHEN o_orderstatus = 'P' THEN 'cancelled'
            ELSE 'completed' END AS status,
       o_orderdate AS created_at,
       o_orderdate + to_days(CAST(version AS INTEGER)) AS updated_at
FROM orders
JOIN (VALUES (0), (1)) AS versions(version) ON version = 1 OR o_orderpriority = '5-LOW'""",
    "raw_transaction_items": f"""
SELECT {_tenant('l_orderkey')} AS tenant_id,
       l_orderkey * 10 + l_linenumber AS item_id,
       l_orderkey + 1 AS transaction_id,
       l_partkey + 1 AS product_id,
       CAST(l_quantity AS BIGINT) AS quantity,
       CAST(floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS DECIMAL(18,2)) AS unit_price,
       CAST(l_discount * 100 AS DECIMAL(18,2)) AS discount,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
                  * (CAST(1 AS DECIMAL(5,2)) - CAST(l_discount AS DECIMAL(4,2))), 2)
            AS DECIMAL(18,2)) AS subtotal,
       l_shipdate AS created_at,
       l_shipdate AS updated_at
FROM lineitem""",
    "raw_transaction_promotions": f"""
SELECT {_tenant('o_orderkey')} AS tenant_id,
       o_orderkey * 2 + slot + 1 AS id,
       o_orderkey + 1 AS transaction_id,
       CASE slot WHEN 0 THEN first_block ELSE greatest(first_block - 2, 0) END + 1 AS promo_id,
       CAST(round(CAST(o_totalprice AS DECIMAL(18,2))
                  * CAST(3 + (o_orderkey + slot) % 13 AS DECIMAL(5,0))
                  * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS discount_applied,
       o_orderdate AS created_at,
       o_orderdate AS updated_at
FROM (SELECT *, o_custkey // 15 - CASE WHEN o_custkey // 15 % 8 = 7 THEN 1 ELSE 0 END
                AS first_block
      FROM orders WHERE o_orderpriority = '1-URGENT') AS urgent
JOIN (VALUES (0), (1)) AS slots(slot) ON slot = 0 OR o_totalprice > 300000""",
}
