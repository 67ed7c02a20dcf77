"""Answers for the quality queries, one counting sub-select per declared check."""

from __future__ import annotations

from oracles.declared_checks import CHECKS, Declared

_VERDICT = """CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail'
       ELSE 'warn' END"""


def _listed(values: tuple) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _failures(c: Declared) -> str:
    model, column = c.model.replace("raw.", "raw_"), c.column
    if c.kind == "not_null":
        return f"SELECT count(*) FROM {model} WHERE {column} IS NULL"
    if c.kind == "accepted_values":
        return f"SELECT count(*) FROM {model} WHERE {column} NOT IN ({_listed(c.values)})"
    if c.kind == "unique":
        return (
            f"SELECT count(*) FROM (SELECT 1 FROM {model} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1) AS twice"
        )
    return (
        f"SELECT count(*) FROM {model} AS child WHERE child.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {c.parent} AS up WHERE up.{c.parent_column} = child.{column})"
    )


def results(checks: list[Declared]) -> str:
    rows = "\nUNION ALL\n".join(
        f"SELECT '{c.layer}' AS layer, '{c.model}' AS model, '{c.column}' AS \"column\", "
        f"'{c.label}' AS \"check\", '{c.severity}' AS severity, ({_failures(c)}) AS failures"
        for c in checks
    )
    return f"SELECT *, {_VERDICT} AS status FROM ({rows}) AS counted"


_KEY_COLUMNS = {
    "products": "product_id",
    "stores": "store_id",
    "suppliers": "supplier_id",
    "promotions": "promo_id",
    "employees": "employee_id",
    "inventory": "inventory_id",
    "product_supplier": "id",
    "customer_loyalty": "loyalty_id",
}
_KEYS = "\nUNION ALL\n".join(
    f"SELECT tenant_id, '{t}', count(DISTINCT {k}) FROM raw_{t} GROUP BY ALL" for t, k in _KEY_COLUMNS.items()
)

def results_of(kind: str) -> str:
    return results([c for c in CHECKS if c.kind == kind])


RECONCILED = """
SELECT ifnull(src.tenant_id, dst.tenant_id) AS tenant_id,
       ifnull(src.table_name, dst.table_name) AS table_name,
       ifnull(src.n, 0) AS source_rows, ifnull(dst.n, 0) AS landed_rows,
       CASE WHEN dst.n < src.n THEN 'FAIL' WHEN dst.n > src.n THEN 'WARN' ELSE 'OK' END AS status
FROM source_rows AS src
FULL JOIN (
    SELECT tenant_id, 'transactions' AS table_name, count(DISTINCT transaction_id) AS n
    FROM raw_transactions GROUP BY ALL
    UNION ALL
    SELECT tenant_id, 'transaction_items', count(*) FROM stg_transaction_items GROUP BY ALL
    UNION ALL
    SELECT tenant_id, 'transaction_promotions', count(*)
    FROM stg_transaction_promotions GROUP BY ALL
    UNION ALL
    SELECT tenant_id, 'customers', count(*) FROM stg_customers GROUP BY ALL
    UNION ALL
    """ + _KEYS + """
) AS dst ON dst.tenant_id = src.tenant_id AND dst.table_name = src.table_name"""

CHECK_PARTS = {
    "source_rows": """
SELECT 'tenant_0' || CAST(o_orderkey % 3 + 1 AS VARCHAR) AS tenant_id,
       'transactions' AS table_name, count(*) AS n
FROM orders GROUP BY 1
UNION ALL
SELECT 'tenant_0' || CAST(o_orderkey % 3 + 1 AS VARCHAR), 'transaction_promotions', count(*)
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1
UNION ALL
SELECT 'tenant_0' || CAST(l_orderkey % 3 + 1 AS VARCHAR), 'transaction_items', count(*)
FROM lineitem GROUP BY 1
UNION ALL
SELECT t.tenant_id, 'customers', count(*)
FROM customer CROSS JOIN (VALUES ('tenant_01'), ('tenant_02'), ('tenant_03')) AS t(tenant_id)
GROUP BY 1
UNION ALL
""" + _KEYS,
    "row_counts": RECONCILED,
    "revenue_totals": """
SELECT (SELECT sum(net_amount) FROM fact_sales) AS fact_revenue,
       (SELECT sum(subtotal) FROM stg_transaction_items
        WHERE transaction_sk IN (SELECT transaction_sk FROM stg_transactions)) AS staged_revenue""",
    "revenue_check": """
SELECT CAST(fact_revenue AS DOUBLE) AS fact_revenue, CAST(staged_revenue AS DOUBLE)
           AS staged_revenue,
       CAST(abs(fact_revenue - staged_revenue) AS DOUBLE) AS diff,
       CASE WHEN abs(fact_revenue - staged_revenue) <= 1 THEN 'pass' ELSE 'fail' END AS status
FROM revenue_totals""",
    "freshness_check": """
SELECT newest AS last_loaded_at, newest + INTERVAL 12 HOUR AS checked_at,
       datediff('hour', newest, newest + INTERVAL 12 HOUR) AS hours,
       CASE WHEN newest IS NULL THEN 'fail' ELSE 'pass' END AS status
FROM (SELECT max(updated_at) AS newest FROM raw_transactions WHERE EXISTS (SELECT 1 FROM fact_sales)) AS ages""",
    "declared_results": results(CHECKS),
    "gate_counts": """
SELECT layer, status FROM declared_results
UNION ALL
SELECT 'raw', CASE status WHEN 'FAIL' THEN 'fail' WHEN 'WARN' THEN 'warn' ELSE 'pass' END
FROM row_counts
UNION ALL
SELECT 'marts', status FROM revenue_check
UNION ALL
SELECT 'marts', status FROM freshness_check""",
}

CHECK_ANSWERS = {
    "dq_not_null": results_of("not_null"),
    "dq_unique": results_of("unique"),
    "dq_relationships": results_of("relationships"),
    "dq_accepted_values": results_of("accepted_values"),
    "dq_severity": f"""
SELECT severity, status, count(*) AS checks, CAST(sum(failures) AS BIGINT) AS failures
FROM ({results([c for c in CHECKS if not c.model.startswith('raw.')])}) AS scanned GROUP BY ALL""",
    "dq_row_count_reconcile": "SELECT * FROM row_counts",
    "source_counts": 'SELECT tenant_id, table_name, n AS "rows" FROM source_rows',
    "dq_revenue_reconcile": "SELECT * FROM revenue_check",
    "dq_freshness": "SELECT * FROM freshness_check",
    "dq_gate": """
SELECT CAST(list_position(['raw', 'staging', 'marts'], layer) AS INTEGER) AS position, layer,
       checks, errors, warnings,
       CASE WHEN ifnull(max(errors) OVER (ORDER BY list_position(['raw', 'staging', 'marts'], layer)
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 THEN 'blocked'
            WHEN errors > 0 THEN 'failed' ELSE 'passed' END AS state
FROM (SELECT layer, count(*) AS checks, count(*) FILTER (WHERE status = 'fail') AS errors,
             count(*) FILTER (WHERE status = 'warn') AS warnings
      FROM gate_counts GROUP BY layer) AS layers""",
}
