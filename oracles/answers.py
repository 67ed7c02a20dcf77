"""The statement for every registered query: money as DOUBLE, days as text, counts as BIGINT."""

from __future__ import annotations

from oracles.check_answers import CHECK_ANSWERS, CHECK_PARTS
from oracles.compose import with_parts
from oracles.load_answers import LOAD_ANSWERS, LOAD_PARTS, RESHAPE_ANSWERS, RULE_ANSWERS
from oracles.model_parts import MODEL_PARTS
from oracles.raw_parts import RAW_PARTS

PARTS = RAW_PARTS | MODEL_PARTS

# Columns shown as DOUBLE / as text, per model.
_MONEY = {
    "stg_products": ["unit_price"],
    "stg_promotions": ["discount_pct", "min_purchase"],
    "stg_transactions": ["total_amount"],
    "stg_transaction_items": ["unit_price", "discount", "subtotal"],
    "stg_transaction_promotions": ["discount_applied"],
    "stg_product_supplier": ["cost_price"],
    "stg_customer_loyalty": ["total_spend"],
    "int_primary_cost": ["cost_price"],
    "int_sales_enriched": [
        "unit_price",
        "net_amount",
        "gross_amount",
        "cost_price",
        "cost_amount",
        "margin_amount",
    ],
    "dim_product": ["unit_price"],
    "dim_promotion": ["discount_pct", "min_purchase"],
    "fact_sales": [
        "unit_price",
        "line_discount_pct",
        "gross_amount",
        "net_amount",
        "txn_promo_discount",
    ],
    "fact_promotion_usage": ["discount_applied", "transaction_amount"],
    "fact_loyalty_activity": ["recorded_total_spend"],
}
_DAYS = {
    "stg_stores": ["opened_at"],
    "stg_promotions": ["start_date", "end_date"],
    "stg_employees": ["hire_date"],
    "stg_customer_loyalty": ["member_since"],
    "dim_store": ["opened_at"],
    "dim_promotion": ["start_date", "end_date"],
    "dim_employee": ["hire_date"],
    "dim_date": ["date_day"],
    "fact_loyalty_activity": ["member_since"],
}


def shown(model: str) -> str:
    """All columns of a model in the compared types."""
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in _MONEY.get(model, [])]
    casts += [f"CAST({c} AS VARCHAR) AS {c}" for c in _DAYS.get(model, [])]
    replaced = f" REPLACE ({', '.join(casts)})" if casts else ""
    return f"SELECT *{replaced} FROM {model}"


def half_up(value: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"sign({value}) * floor(abs({value}) * {scale} + 0.5) / {scale}"


def money(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def whole(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def per(numerator: str, denominator: str) -> str:
    return f"(CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0))"


TENANT = "tenant_01"

QUESTIONS = {
    "top_products_per_category": f"""
SELECT category, product_name, qty
FROM (SELECT category, product_name, {whole('sum(quantity)')} AS qty
      FROM fact_sales JOIN dim_product USING (product_sk)
      WHERE fact_sales.tenant_id = '{TENANT}' GROUP BY ALL) AS units
QUALIFY row_number() OVER (PARTITION BY category ORDER BY qty DESC, product_name) <= 5""",
    "monthly_revenue": f"""
SELECT strftime(transaction_date, '%Y-%m') AS year_month, {money('sum(net_amount)')} AS revenue
FROM fact_sales WHERE tenant_id = '{TENANT}' GROUP BY 1""",
    "payment_mix": f"""
SELECT payment_method, count(*) AS transactions,
       {half_up('100 * count(*)::DOUBLE / sum(count(*)) OVER ()::DOUBLE', 1)} AS pct
FROM (SELECT DISTINCT payment_method, transaction_sk FROM fact_sales
      WHERE tenant_id = '{TENANT}') AS baskets
GROUP BY 1""",
    "revenue_by_store": f"""
SELECT store_name, city, year_month, {money('sum(net_amount)')} AS revenue
FROM dim_date
JOIN fact_sales USING (date_key)
JOIN dim_store USING (store_sk)
WHERE date_day >= (SELECT CAST(max(date_day) - INTERVAL 6 MONTH AS DATE) FROM dim_date)
GROUP BY ALL""",
    "promotion_effectiveness": f"""
SELECT promo_name, promo_type, {money('sum(discount_applied)')} AS total_discount,
       count(DISTINCT transaction_sk) AS transactions,
       {half_up(per('sum(transaction_amount)', 'count(transaction_amount)'), 2)} AS avg_txn_value
FROM fact_promotion_usage JOIN dim_promotion USING (promo_sk)
GROUP BY promo_sk, promo_name, promo_type""",
    "promo_avg_comparison": f"""
SELECT bucket, {half_up(per('sum(amount)', 'count(*)'), 2)} AS avg_transaction_value,
       count(*) AS transactions
FROM (SELECT transaction_sk, sum(net_amount) AS amount,
             CASE max(is_promo_transaction) WHEN 1 THEN 'with_promo' ELSE 'without_promo' END
                 AS bucket
      FROM fact_sales GROUP BY 1) AS baskets
GROUP BY bucket""",
    "top_products_by_city": """
SELECT city, product_name, revenue FROM city_ranks WHERE rn <= 3""",
    "customer_segments": f"""
SELECT city,
       CASE WHEN spend >= (SELECT quantile_cont(spend, 0.66) FROM spenders) THEN 'High'
            WHEN spend >= (SELECT quantile_cont(spend, 0.33) FROM spenders) THEN 'Medium'
            ELSE 'Low' END AS segment,
       count(*) AS customers, {money('sum(exact_spend)')} AS total_spend
FROM spenders GROUP BY ALL""",
    "transactions_by_day": f"""
SELECT CAST(isodow(transaction_date) AS INTEGER) AS day_of_week,
       strftime(transaction_date, '%a') AS day_name,
       count(DISTINCT transaction_sk) AS transactions, {money('sum(net_amount)')} AS revenue
FROM fact_sales GROUP BY 1, 2""",
    "revenue_margin": f"""
SELECT category, CAST(year(transaction_date) AS VARCHAR) || '-Q'
                 || CAST(quarter(transaction_date) AS VARCHAR) AS quarter,
       {money('sum(net_amount)')} AS revenue, {money('sum(margin_amount)')} AS margin,
       {half_up(per('sum(margin_amount)', 'sum(net_amount)') + ' * 100', 1)} AS margin_pct
FROM int_sales_enriched WHERE length(category) > 0 GROUP BY ALL""",
    "customer_ltv": f"""
SELECT customer_name, city, ifnull(tier, 'none') AS tier, {money('net')} AS lifetime_value,
       baskets AS transactions
FROM (SELECT customer_sk, sum(net_amount) AS net, count(DISTINCT transaction_sk) AS baskets
      FROM fact_sales GROUP BY 1) AS spend
JOIN dim_customer USING (customer_sk)
LEFT JOIN (SELECT customer_sk, tier FROM fact_loyalty_activity
           QUALIFY row_number() OVER (PARTITION BY customer_sk
                                      ORDER BY member_since DESC, loyalty_sk DESC) = 1) AS cards
       USING (customer_sk)
ORDER BY net DESC, customer_sk LIMIT 20""",
    "inventory_turnover": f"""
SELECT store_name, product_name, stock_qty, qty_sold, {half_up('turnover_rate', 3)} AS turnover_rate
FROM fact_inventory_movement
JOIN dim_store USING (store_sk) JOIN dim_product USING (product_sk)
WHERE stock_qty > 0
ORDER BY 5, inventory_sk LIMIT 20""",
    "employee_performance": f"""
SELECT employee_name, employee_role AS role, store_city, {money('sum(net_amount)')} AS revenue,
       {money('sum(margin_amount)')} AS margin, count(DISTINCT transaction_sk) AS transactions,
       {half_up(per('sum(net_amount)', 'count(DISTINCT transaction_sk)'), 2)} AS avg_txn_value
FROM int_sales_enriched WHERE employee_name <> '' GROUP BY 1, 2, 3
ORDER BY avg_txn_value DESC, 1, 2, 3 LIMIT 15""",
    "promotion_roi": f"""
SELECT promo_name, promo_type, {money('amount')} AS promo_revenue,
       {money('discount')} AS total_discount, uses AS promo_txns,
       {half_up('lift', 2)} AS incremental_revenue,
       {half_up(per('lift', 'discount'), 2)} AS roi
FROM roi_parts JOIN dim_promotion USING (promo_sk)""",
    "supplier_dependency": f"""
SELECT product_name, category, {money('net')} AS revenue, units AS qty_sold,
       makers AS supplier_count,
       CASE WHEN makers > 1 THEN 'multi-source' ELSE 'single-source' END AS sourcing
FROM (SELECT best.*, (SELECT count(DISTINCT supplier_sk) FROM stg_product_supplier AS link
                      WHERE link.product_sk = best.product_sk) AS makers
      FROM (SELECT product_sk, sum(net_amount) AS net, {whole('sum(quantity)')} AS units
            FROM fact_sales GROUP BY 1 ORDER BY net DESC, product_sk LIMIT 20) AS best) AS ranked
JOIN dim_product USING (product_sk)""",
    "cohort_retention": f"""
SELECT strftime(cohort, '%Y-%m') AS cohort_month,
       CAST(datediff('month', cohort, active) AS INTEGER) AS month_offset,
       any_value(size) AS cohort_size, count(*) AS active_customers,
       {half_up('100 * count(*)::DOUBLE / any_value(size)::DOUBLE', 1)} AS retention_pct
FROM (SELECT customer_sk, cohort, active,
             count(DISTINCT customer_sk) OVER (PARTITION BY cohort) AS size
      FROM (SELECT customer_sk, active, min(active) OVER (PARTITION BY customer_sk) AS cohort
            FROM (SELECT DISTINCT customer_sk, date_trunc('month', transaction_date) AS active
                  FROM fact_sales WHERE customer_sk IS NOT NULL) AS months) AS starts) AS sized
GROUP BY cohort, active""",
}

# Parts used by several questions and reshapes.
PARTS |= {
    "city_ranks": f"""
SELECT city, product_name, {money('sum(net_amount)')} AS revenue,
       row_number() OVER (PARTITION BY city ORDER BY sum(net_amount) DESC, product_name) AS rn
FROM fact_sales JOIN dim_store USING (store_sk) JOIN dim_product USING (product_sk)
GROUP BY city, product_name""",
    "spenders": """
SELECT city, CAST(sum(net_amount) AS DOUBLE) AS spend, sum(net_amount) AS exact_spend
FROM fact_sales JOIN dim_customer USING (customer_sk)
GROUP BY customer_sk, city""",
    "roi_parts": f"""
SELECT promo_sk, sum(amount) AS amount, sum(discount) AS discount, count(*) AS uses,
       ({per('sum(amount)', 'count(*)')}
        - (SELECT {per('sum(net_amount)', 'count(DISTINCT transaction_sk)')}
           FROM fact_sales WHERE is_promo_transaction = 0)) * count(*) AS lift
FROM (SELECT promo_sk, transaction_sk, any_value(transaction_amount) AS amount,
             sum(discount_applied) AS discount
      FROM fact_promotion_usage GROUP BY 1, 2) AS pairs
GROUP BY promo_sk""",
}


PARTS |= LOAD_PARTS | CHECK_PARTS
PARTS |= {f"q_{name}": body for name, body in QUESTIONS.items()}


def oracle_sql() -> dict[str, str]:
    bodies = {model: shown(model) for model in MODEL_PARTS if model != "dim_loyalty_tier"}
    for group in (QUESTIONS, LOAD_ANSWERS, CHECK_ANSWERS, RESHAPE_ANSWERS, RULE_ANSWERS):
        bodies |= group
    # A refreshed fact is the fact.
    bodies |= {f"refresh_{fact}": bodies[fact] for fact in ("int_sales_enriched", "fact_sales", "fact_inventory_movement")}
    return {name: with_parts(PARTS, body) for name, body in bodies.items()}
