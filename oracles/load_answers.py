"""Answers for loading, reshaping and rule queries."""

from __future__ import annotations

LOAD_PARTS = {
    "latest_per_user": """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "movement_stamps": """
SELECT tenant_id, 'transactions' AS table_name, updated_at FROM raw_transactions
UNION ALL
SELECT tenant_id, 'transaction_items', updated_at FROM raw_transaction_items
UNION ALL
SELECT tenant_id, 'transaction_promotions', updated_at FROM raw_transaction_promotions""",
    "newest_stamps": """
SELECT tenant_id, table_name, date_trunc('second', max(updated_at)) AS watermark,
       count(*) AS n
FROM movement_stamps GROUP BY ALL""",
}

_TABLES = [
    "customers",
    "products",
    "stores",
    "suppliers",
    "promotions",
    "transactions",
    "transaction_items",
    "transaction_promotions",
    "employees",
    "inventory",
    "product_supplier",
    "customer_loyalty",
]
_ALL_ROWS = "\nUNION ALL\n".join(
    f"SELECT tenant_id, '{t}' AS table_name FROM raw_{t}" for t in _TABLES
)

_STAMPED_ROWS = "\nUNION ALL\n".join(
    f"SELECT tenant_id, '{t}' AS table_name, updated_at FROM raw_{t}" for t in _TABLES
)

LOAD_ANSWERS = {
    "tenant_union": """
SELECT event_type AS tenant_id, user_id, event_id, ts, value, props FROM events""",
    "raw_typed": """
SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM raw_transactions""",
    "full_load": """
SELECT tenant_id, transaction_id, status, CAST(total_amount AS DOUBLE) AS total_amount, updated_at
FROM raw_transactions
WHERE tenant_id = 'tenant_01' OR (tenant_id = 'tenant_02' AND status = 'completed')""",
    "full_load_catalog": f"""
SELECT tenant_id, table_name, count(*) AS "rows", max(updated_at) AS newest
FROM ({_STAMPED_ROWS}) AS loaded
WHERE tenant_id = 'tenant_01' OR (tenant_id = 'tenant_02' AND updated_at < TIMESTAMP '1998-01-01')
GROUP BY ALL""",
    "row_differences": """
SELECT * FROM (WITH source AS (
    SELECT tenant_id, item_id, transaction_id, product_id, quantity, unit_price, discount, subtotal, created_at, updated_at
    FROM raw_transaction_items
), landed AS (
    SELECT * REPLACE (CASE WHEN item_id % 5009 = 31 THEN -item_id ELSE item_id END AS item_id,
                      CASE WHEN item_id % 5003 = 29 THEN quantity + 1 ELSE quantity END AS quantity)
    FROM source WHERE item_id % 4999 <> 17
), odd AS (
    SELECT DISTINCT tenant_id, item_id
    FROM ((SELECT * FROM source EXCEPT ALL SELECT * FROM landed) UNION ALL (SELECT * FROM landed EXCEPT ALL SELECT * FROM source))
), counted AS (
    SELECT tenant_id, item_id,
           (SELECT count(*) FROM source s WHERE s.tenant_id = odd.tenant_id AND s.item_id = odd.item_id) AS left_rows,
           (SELECT count(*) FROM landed t WHERE t.tenant_id = odd.tenant_id AND t.item_id = odd.item_id) AS right_rows
    FROM odd
)
SELECT *, CASE WHEN right_rows = 0 THEN 'lost' WHEN left_rows = 0 THEN 'extra' ELSE 'changed' END AS kind FROM counted) AS named""",
    "incremental_extract": """
SELECT st.tenant_id, st.table_name, count(mv.updated_at) AS "rows",
       greatest(max(st.since), ifnull(max(mv.updated_at), max(st.since))) AS watermark
FROM (VALUES ('tenant_01', 'transactions', TIMESTAMP '1998-01-01'),
             ('tenant_02', 'transactions', TIMESTAMP '2000-06-15'),
             ('tenant_03', 'transactions', TIMESTAMP '1970-01-01'),
             ('tenant_01', 'transaction_items', TIMESTAMP '1999-03-01'),
             ('tenant_02', 'transaction_items', TIMESTAMP '2030-01-01'),
             ('tenant_03', 'transaction_items', TIMESTAMP '1970-01-01'))
     AS st(tenant_id, table_name, since)
LEFT JOIN movement_stamps AS mv
       ON mv.tenant_id = st.tenant_id AND mv.table_name = st.table_name
      AND mv.updated_at > st.since
GROUP BY ALL""",
    "watermark_state": """
SELECT tenant_id, table_name, watermark FROM newest_stamps
UNION ALL
SELECT DISTINCT tenant_id, 'customers', TIMESTAMP '1970-01-01' FROM newest_stamps""",
    "incremental_merge": """
SELECT event_type AS tenant_id, user_id, event_id, ts, value, props FROM latest_per_user""",
    "stream_keyed_upsert": """
SELECT event_type AS tenant_id, user_id, event_id, ts, value, props FROM latest_per_user""",
    "stream_tenant_changes": """
SELECT event_type AS tenant_id, user_id, event_id, ts, value, props FROM latest_per_user""",
    "current_over_base": """
SELECT event_type AS tenant_id, user_id, event_id, ts, value, props FROM latest_per_user""",
    "incremental_partial": """
SELECT tenant_id, table_name,
       CASE WHEN stopped THEN TIMESTAMP '1970-01-01' ELSE watermark END AS watermark,
       CASE WHEN stopped THEN 0 ELSE n END AS "rows"
FROM (SELECT *, tenant_id = 'tenant_02' AND table_name <> 'transactions' AS stopped
      FROM newest_stamps) AS outcome""",
    "load_audit": f"""
SELECT ifnull(tenant_id, 'ALL') AS tenant_id, ifnull(table_name, 'ALL') AS table_name,
       count(*) AS "rows"
FROM ({_ALL_ROWS}) AS landed
GROUP BY GROUPING SETS ((tenant_id, table_name), (tenant_id), ())""",
    "stream_incremental_load": "SELECT * FROM events",
    "stream_latest_version": "SELECT * FROM latest_per_user",
    "latest_version": "SELECT * FROM latest_per_user",
}

# The reshapes start from question answers, which are added as parts named q_<question>.
RESHAPE_ANSWERS = {
    "pivot_store_month": """
SELECT store_name, year_month, ifnull(sum(revenue), 0) AS revenue
FROM (SELECT DISTINCT store_name FROM q_revenue_by_store) AS s
CROSS JOIN (SELECT DISTINCT year_month FROM q_revenue_by_store) AS m
LEFT JOIN q_revenue_by_store USING (store_name, year_month)
GROUP BY ALL""",
    "top_promotions": """
SELECT promo_name, total_discount FROM q_promotion_effectiveness
ORDER BY total_discount DESC, promo_name, promo_type, avg_txn_value LIMIT 10""",
    "pivot_city_rank": """
SELECT city, ifnull(max(revenue) FILTER (rn = 1), 0) AS rank_1,
       ifnull(max(revenue) FILTER (rn = 2), 0) AS rank_2,
       ifnull(max(revenue) FILTER (rn = 3), 0) AS rank_3
FROM city_ranks GROUP BY city""",
    "pivot_city_segment": """
SELECT city, CAST(ifnull(sum(customers) FILTER (segment = 'High'), 0) AS BIGINT) AS High,
       CAST(ifnull(sum(customers) FILTER (segment = 'Medium'), 0) AS BIGINT) AS Medium,
       CAST(ifnull(sum(customers) FILTER (segment = 'Low'), 0) AS BIGINT) AS Low
FROM q_customer_segments GROUP BY city""",
    "pivot_category_quarter": """
SELECT category, quarter, ifnull(revenue, 0) AS revenue
FROM (SELECT DISTINCT category FROM q_revenue_margin) AS c
CROSS JOIN (SELECT DISTINCT quarter FROM q_revenue_margin) AS d
LEFT JOIN q_revenue_margin USING (category, quarter)""",
    "cohort_matrix": """
SELECT cohort_month, month_offset, retention_pct, cohort_size FROM q_cohort_retention""",
    "roi_sign_flag": """
SELECT promo_name, promo_type, roi,
       CASE WHEN roi < 0 THEN 'negative' ELSE 'positive' END AS sign
FROM q_promotion_roi""",
}

RULE_ANSWERS = {
    "line_subtotal": """
SELECT item_sk,
       CAST(round(CAST(quantity AS DECIMAL(10,0)) * unit_price
                  * (CAST(100 - discount AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2))), 2)
            AS DOUBLE) AS subtotal
FROM stg_transaction_items""",
    "header_total_rollup": """
SELECT hd.tenant_id, hd.transaction_id, hd.status,
       CAST(ifnull(sum(li.subtotal), 0) AS DOUBLE) AS total_amount
FROM (SELECT * FROM raw_transactions
      QUALIFY row_number() OVER (PARTITION BY tenant_id, transaction_id
                                 ORDER BY updated_at DESC) = 1) AS hd
LEFT JOIN stg_transaction_items AS li
       ON li.tenant_id = hd.tenant_id AND li.transaction_id = hd.transaction_id
GROUP BY ALL""",
    "loyalty_tier_assignment": """
SELECT customer_sk, tenant_id, customer_id,
       (SELECT tier FROM dim_loyalty_tier WHERE min_spend <= spend
        ORDER BY tier_rank DESC LIMIT 1) AS tier,
       CAST(floor(CAST(spend AS DOUBLE) / 1000) AS BIGINT) AS points,
       CAST(spend AS DOUBLE) AS total_spend
FROM (SELECT cu.customer_sk, cu.tenant_id, cu.customer_id, ifnull(sum(net_amount), 0) AS spend
      FROM stg_customers AS cu LEFT JOIN fact_sales USING (customer_sk) GROUP BY ALL) AS totals""",
    "summary_accuracy": """
SELECT tenant_id, CAST(year(transaction_date) AS INTEGER) AS year, count(*) AS lines,
       CAST(sum(net_amount) AS DOUBLE) AS net, TRUE AS transactions_within,
       TRUE AS customers_within, TRUE AS median_within
FROM fact_sales GROUP BY 1, 2""",
    "units_sold": """
SELECT tenant_id, store_sk, product_sk, CAST(sum(quantity) AS BIGINT) AS units
FROM fact_sales GROUP BY ALL""",
    "loyalty_tier_members": """
SELECT tier_sk, tier, tier_rank, CAST(min_spend AS DOUBLE) AS min_spend,
       (SELECT count(*) FROM fact_loyalty_activity AS card
        WHERE card.tier_sk = dim_loyalty_tier.tier_sk) AS members
FROM dim_loyalty_tier""",
}
