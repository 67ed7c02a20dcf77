"""The declared checks of every layer, and how to run them over a warehouse."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.operators.checks import (
    ERROR,
    WARN,
    Check,
    amount_reconcile,
    enforce,
    freshness,
    keyed_checks,
    relationship_check,
    row_count_reconcile,
    scan_checks,
    union_all,
)
from storelake.operators.versions import current_rows
from storelake.plans.warehouse import Warehouse
from storelake.session import written
from storelake.sources.bases import Bases
from storelake.sources.catalog import TENANT, spec_of

# Gate order.  Source checks run with the staging layer.
GATES = ("staging", "marts")

# The raw tables of most rows, whose newest rows are sorted out once for all passes, and their columns
# that a check or a model below one reads.
LARGE = {
    "transactions": ("transaction_id", "customer_id", "store_id", "transaction_date", "payment_method", "status"),
    "transaction_items": ("item_id", "transaction_id", "product_id", "quantity", "subtotal"),
    "transaction_promotions": ("id", "transaction_id", "promo_id"),
    "inventory": ("inventory_id", "product_id", "store_id", "stock_qty"),
}
# Columns of a checked model that the checked models above it read.
READ_ABOVE = {"int_sales_enriched": ("tenant_id", "store_sk", "product_sk", "quantity")}

# Accepted codes.
GENDERS = ("Male", "Female")
STORE_TYPES = ("minimarket", "supermarket", "express")
PROMO_TYPES = ("discount", "bundle", "cashback")
PAYMENTS = ("cash", "debit", "credit", "e-wallet")
ROLES = ("cashier", "supervisor", "manager")
TIERS = ("bronze", "silver", "gold", "platinum")

# Columns of the landed tables that may not be NULL.
SOURCE_NOT_NULL = {
    "customers": ["customer_id"],
    "products": ["product_id", "unit_price"],
    "stores": ["store_id"],
    "suppliers": ["supplier_id"],
    "promotions": ["promo_id"],
    "transactions": ["transaction_id", "transaction_date", "total_amount"],
    "transaction_items": ["item_id", "quantity"],
    "transaction_promotions": ["id"],
    "employees": ["employee_id"],
    "inventory": ["inventory_id", "stock_qty"],
    "product_supplier": ["id"],
    "customer_loyalty": ["loyalty_id"],
}


class _Suite:
    def __init__(self, layer: str):
        self.layer = layer
        self.checks: list[Check] = []

    def key(self, model: str, column: str) -> None:
        self.filled(model, column)
        self.checks.append(Check(self.layer, model, column, "unique"))

    def filled(self, model: str, column: str, severity: str = ERROR) -> None:
        self.checks.append(Check(self.layer, model, column, "not_null", severity))

    def one_of(self, model: str, column: str, values: tuple, severity: str = ERROR) -> None:
        self.checks.append(Check(self.layer, model, column, "accepted_values", severity, values))

    def refers(self, model: str, column: str, parent: str, severity: str = ERROR) -> None:
        self.checks.append(
            Check(self.layer, model, column, "relationships", severity, (), parent, column)
        )


def source_checks() -> list[Check]:
    suite = _Suite("staging")
    for table, columns in SOURCE_NOT_NULL.items():
        for column in columns:
            suite.filled(f"raw.{table}", column)
    return suite.checks


def staging_checks() -> list[Check]:
    s = _Suite("staging")
    s.key("stg_customers", "customer_sk")
    s.filled("stg_customers", "customer_id")
    s.one_of("stg_customers", "gender", GENDERS, WARN)
    s.key("stg_products", "product_sk")
    s.filled("stg_products", "unit_price")
    s.filled("stg_products", "product_id")
    s.key("stg_stores", "store_sk")
    s.one_of("stg_stores", "store_type", STORE_TYPES, WARN)
    s.key("stg_suppliers", "supplier_sk")
    s.key("stg_promotions", "promo_sk")
    s.one_of("stg_promotions", "promo_type", PROMO_TYPES, WARN)
    s.key("stg_transactions", "transaction_sk")
    s.refers("stg_transactions", "customer_sk", "stg_customers")
    s.refers("stg_transactions", "store_sk", "stg_stores", WARN)
    s.one_of("stg_transactions", "payment_method", PAYMENTS)
    s.one_of("stg_transactions", "status", ("completed",))
    s.key("stg_transaction_items", "item_sk")
    s.refers("stg_transaction_items", "product_sk", "stg_products")
    s.filled("stg_transaction_items", "quantity")
    s.key("stg_transaction_promotions", "txn_promo_sk")
    s.refers("stg_transaction_promotions", "promo_sk", "stg_promotions")
    s.key("stg_employees", "employee_sk")
    s.refers("stg_employees", "store_sk", "stg_stores", WARN)
    s.one_of("stg_employees", "role", ROLES, WARN)
    s.key("stg_inventory", "inventory_sk")
    s.refers("stg_inventory", "product_sk", "stg_products", WARN)
    s.filled("stg_inventory", "stock_qty")
    s.key("stg_product_supplier", "product_supplier_sk")
    s.refers("stg_product_supplier", "supplier_sk", "stg_suppliers", WARN)
    s.key("stg_customer_loyalty", "loyalty_sk")
    s.refers("stg_customer_loyalty", "customer_sk", "stg_customers", WARN)
    s.one_of("stg_customer_loyalty", "tier", TIERS)
    return s.checks


def mart_checks() -> list[Check]:
    s = _Suite("marts")
    s.key("dim_customer", "customer_sk")
    s.key("dim_product", "product_sk")
    s.filled("dim_product", "category", WARN)
    s.key("dim_store", "store_sk")
    s.key("dim_promotion", "promo_sk")
    s.key("dim_date", "date_key")
    s.one_of("dim_date", "day_of_week", (1, 2, 3, 4, 5, 6, 7))
    s.key("fact_sales", "sales_sk")
    s.refers("fact_sales", "customer_sk", "dim_customer")
    s.refers("fact_sales", "product_sk", "dim_product")
    s.refers("fact_sales", "store_sk", "dim_store", WARN)
    s.refers("fact_sales", "date_key", "dim_date")
    s.filled("fact_sales", "net_amount")
    s.key("fact_promotion_usage", "txn_promo_sk")
    s.refers("fact_promotion_usage", "promo_sk", "dim_promotion")
    s.refers("fact_promotion_usage", "transaction_sk", "fact_sales", WARN)
    s.key("int_sales_enriched", "sales_sk")
    s.filled("int_sales_enriched", "net_amount")
    s.key("dim_employee", "employee_sk")
    s.one_of("dim_employee", "role", ROLES, WARN)
    s.key("dim_supplier", "supplier_sk")
    s.key("dim_loyalty_tier", "tier_sk")
    s.one_of("dim_loyalty_tier", "tier", TIERS)
    s.key("fact_inventory_movement", "inventory_sk")
    s.refers("fact_inventory_movement", "product_sk", "dim_product", WARN)
    s.filled("fact_inventory_movement", "stock_qty")
    s.key("fact_loyalty_activity", "loyalty_sk")
    s.refers("fact_loyalty_activity", "tier_sk", "dim_loyalty_tier", WARN)
    s.refers("fact_loyalty_activity", "customer_sk", "dim_customer", WARN)
    return s.checks


def all_checks() -> list[Check]:
    return source_checks() + staging_checks() + mart_checks()


def checked(kind: str) -> list[Check]:
    return [c for c in all_checks() if c.kind == kind]


def _frame(wh: Warehouse, name: str) -> DataFrame:
    return wh.raw[name.removeprefix("raw.")] if name.startswith("raw.") else wh[name]


def _written_all(frames: Mapping[str, DataFrame], purpose: str) -> dict[str, DataFrame]:
    """Stored side by side: small tables leave most executors idle."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(frames, pool.map(lambda df: written(df, purpose), frames.values()), strict=True))


def _unread(table: str, field: T.StructField) -> Column:
    """A column that was not stored: no value is made up for one that is read after all."""
    message = f"{table}.{field.name} is not among the columns stored for the checks"
    return F.raise_error(F.lit(message)).cast(field.dataType).alias(field.name)


def sorted_out(wh: Warehouse, tables: Iterable[str] = tuple(LARGE)) -> Warehouse:
    """Another warehouse, for checks, over stored newest rows of these large raw tables, so that no
    pass over it and no model in it chooses versions again.  Bases hold newest rows already."""
    if isinstance(wh.raw, Bases):
        return wh
    current = {t: current_rows(wh.raw[t], spec_of(t)) for t in tables if t not in wh.newest}
    kept = _written_all({t: df.select(TENANT, *LARGE[t]) for t, df in current.items()}, "newest")
    newest = {
        t: kept[t].select(*[f.name if f.name in kept[t].columns else _unread(t, f) for f in df.schema])
        for t, df in current.items()
    }
    return wh.above(newest)


def _shared(wh: Warehouse, checks: Sequence[Check], read: Sequence[tuple[str, str]] = ()) -> tuple[Warehouse, dict[str, DataFrame]]:
    """The warehouse over stored newest rows of the large raw tables that several checked models
    read, and the checked columns, stored, of models that several passes read.

    ``read``: columns of models that further passes read."""
    passes = list(dict.fromkeys(c.model for c in checks if c.kind != "relationships"))
    uniques = Counter(c.model for c in checks if c.kind == "unique")
    passes += [m for m, n in uniques.items() for _ in range(n - 1)]
    relations = [c for c in checks if c.kind == "relationships"]
    passes += [c.model for c in relations] + [c.parent for c in relations] + [m for m, _ in read]
    models = [m for m in dict.fromkeys(passes) if not m.startswith("raw.")]
    used = Counter(u for m in models for u in wh.uses(m))
    wh = sorted_out(wh, [t for t in LARGE if used[f"stg_{t}"] > 1 and not wh.has(f"stg_{t}")])
    columns: dict[str, list[str]] = {}
    for m, column in [(c.model, c.column) for c in checks] + [(c.parent, c.parent_column) for c in relations] + list(read):
        if column:
            columns.setdefault(m, []).append(column)
    below = [m for m in READ_ABOVE if m in models and used[m] > 1 and not wh.has(m)]
    for m in below:
        kept = dict.fromkeys([*columns[m], *READ_ABOVE[m]])
        wh = wh.above(frames={m: written(wh[m].select(*kept), "checked")})
    several = [m for m, n in Counter(passes).items() if n > 1 and m in models and m not in wh.stored]
    # A staged view of stored newest rows is read from there.
    several = [m for m in several if m.removeprefix("stg_") not in wh.newest]
    narrow = {m: wh[m].select(*dict.fromkeys(columns[m])) for m in several}
    return wh, _written_all(narrow, "checked")


def run_checks(wh: Warehouse, checks: Sequence[Check], store: bool = True) -> DataFrame:
    """One result row per check.

    Column checks and the key check of a model share one pass; each relationship is one
    more.  What several passes read is written to the scratch folder first, unless it is stored
    already: newest rows of large raw tables, and of models the checked columns; the warehouse
    stays as it is."""
    wh, narrow = _shared(wh, checks) if store else (wh, {})
    return _run_over(wh, narrow, checks)


def _run_over(wh: Warehouse, narrow: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    columns: dict[str, list[Check]] = {}
    keys: dict[str, Check] = {}
    more_keys: list[Check] = []
    relations: list[Check] = []
    for check in checks:
        if check.kind == "relationships":
            relations.append(check)
        elif check.kind != "unique":
            columns.setdefault(check.model, []).append(check)
        elif check.model in keys:
            more_keys.append(check)
        else:
            keys[check.model] = check
    frame = lambda name: narrow[name] if name in narrow else _frame(wh, name)
    frames = []
    for model in dict.fromkeys([*columns, *keys]):
        found = columns.get(model, [])
        if model in keys:
            frames.append(keyed_checks(frame(model), keys[model], found))
        else:
            frames.append(scan_checks(frame(model), found))
    frames += [keyed_checks(frame(c.model), c) for c in more_keys]
    for check in relations:
        frames.append(relationship_check(frame(check.model), frame(check.parent), check))
    return union_all(frames)


def source_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per tenant and table of a source."""
    return union_all(
        df.groupBy("tenant_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("tenant_id", F.lit(name).alias("table_name"), "rows")
        for name, df in sources.items()
    )


def on_grid(counts: DataFrame, tenants: Sequence[str], tables: Sequence[str], *zeros: str) -> DataFrame:
    """Every pair of tenant and table; pairs without a row count 0."""
    grid = counts.sparkSession.createDataFrame(
        [(t, n) for t in tenants for n in tables], "tenant_id string, table_name string"
    )
    filled = {c: F.coalesce(c, F.lit(0).cast("long")) for c in zeros}
    return grid.join(counts, ["tenant_id", "table_name"], "left").withColumns(filled)


def landed_counts(
    raw: Mapping[str, DataFrame], tables: Sequence[str], newest: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Rows per tenant and table after collapsing versions (``newest``: tables where that is done)."""
    newest = newest or {}
    return source_counts({n: newest[n] if n in newest else current_rows(raw[n], spec_of(n)) for n in tables})


def reconcile_landing(
    sources: Mapping[str, DataFrame],
    raw: Mapping[str, DataFrame],
    tables: Sequence[str] | None = None,
    tolerance: int = 0,
    tenants: Sequence[str] | None = None,
    newest: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Landed against source counts; an unknown table is an error.

    With ``tenants`` exactly the pairs of those tenants and the tables are reported, also
    those without any row."""
    names = list(sources) if tables is None else list(tables)
    for name in names:
        spec_of(name)
    compared = row_count_reconcile(
        source_counts({n: sources[n] for n in names}), landed_counts(raw, names, newest), tolerance
    )
    return compared if tenants is None else on_grid(compared, tenants, names, "source_rows", "landed_rows").withColumn(
        "status", F.coalesce("status", F.lit("OK"))
    )


def revenue_reconcile(wh: Warehouse) -> DataFrame:
    """Revenue of the sales fact against the staged lines of completed transactions."""
    key = ["transaction_id", "tenant_id"]
    # One row per transaction before the join: a transaction with very many lines is
    # summed map-side.
    baskets = wh["stg_transaction_items"].groupBy(*key).agg(F.sum("subtotal").alias("subtotal"))
    staged = baskets.join(wh["stg_transactions"].select(*key), key, "left_semi")
    return amount_reconcile(wh["fact_sales"], "net_amount", staged, "subtotal").withColumnsRenamed(
        {"left_total": "fact_revenue", "right_total": "staged_revenue"}
    )


def sales_freshness(wh: Warehouse, now=None, limit_hours: int = 24) -> DataFrame:
    moment = F.current_timestamp() if now is None else now
    return freshness(wh["fact_sales"], "dbt_loaded_at", moment, limit_hours)


def _single(layer: str, model: str, column: str, name: str, outcome: DataFrame) -> DataFrame:
    """A one-row outcome as a result row of severity error."""
    failed = F.when(F.col("status") == "pass", 0).otherwise(1).cast("long")
    return outcome.select(
        F.lit(layer).alias("layer"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column"),
        F.lit(name).alias("check"),
        F.lit(ERROR).alias("severity"),
        failed.alias("failures"),
        "status",
    )


def layer_results(wh: Warehouse, layer: str, now=None) -> DataFrame:
    """All results that gate one layer."""
    if layer == "staging":
        return run_checks(wh, source_checks() + staging_checks())
    checks = mart_checks()
    wh, narrow = _shared(wh, checks, [("fact_sales", "net_amount"), ("fact_sales", "dbt_loaded_at")])
    results = _run_over(wh, narrow, checks)
    sales = wh.above(frames={"fact_sales": narrow["fact_sales"]} if "fact_sales" in narrow else {})
    return union_all(
        [
            results,
            _single("marts", "fact_sales", "net_amount", "revenue_reconcile", revenue_reconcile(sales)),
            _single("marts", "fact_sales", "dbt_loaded_at", "freshness", sales_freshness(sales, now)),
        ]
    )


def run_gates(
    wh: Warehouse,
    sources: Mapping[str, DataFrame] | None = None,
    now=None,
    tolerance: int = 0,
) -> None:
    """Fail fast: landing counts, then staging, then marts; the first failed gate raises."""
    wh = sorted_out(wh)
    if sources is not None:
        counts = reconcile_landing(sources, wh.raw, tolerance=tolerance, newest=wh.newest)
        missing = counts.filter(F.col("status") == "FAIL").select(
            F.col("tenant_id").alias("model"),
            F.col("table_name").alias("column"),
            F.lit("row_count").alias("check"),
            (F.col("source_rows") - F.col("landed_rows")).alias("failures"),
            F.lit("fail").alias("status"),
        )
        enforce(missing)
    for layer in GATES:
        enforce(layer_results(wh, layer, now))
