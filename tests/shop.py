"""Tiny hand-made shops: raw tables from dictionaries, everything else filled in."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import types as T

from storelake.plans import marts, staging  # noqa: F401  (fill MODELS)
from storelake.plans.warehouse import Warehouse
from storelake.sources.catalog import CATALOG

BASE = datetime.datetime(2024, 1, 1)


def ts(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text)


def day(text: str) -> datetime.date:
    return datetime.date.fromisoformat(text)


def money(text) -> Decimal:
    return Decimal(str(text)).quantize(Decimal("0.01"))


_DEFAULTS = {
    T.LongType: 0,
    T.StringType: "",
    T.DecimalType: Decimal("0.00"),
    T.BooleanType: True,
    T.DateType: datetime.date(2024, 1, 1),
    T.TimestampType: BASE,
}


def raw_table(spark, name, rows):
    schema = CATALOG[name].raw_schema
    filled = []
    for row in rows:
        unknown = set(row) - set(schema.names)
        assert not unknown, unknown
        values = []
        for field in schema.fields:
            if field.name in row:
                value = row[field.name]
                if isinstance(field.dataType, T.DecimalType) and value is not None:
                    value = money(value)
            elif field.name == "tenant_id":
                value = "t1"
            else:
                value = None if field.nullable else _DEFAULTS[type(field.dataType)]
            values.append(value)
        filled.append(tuple(values))
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(filled, loose)


def shop(spark, loaded_at=None, **tables) -> Warehouse:
    raw = {name: raw_table(spark, name, tables.get(name, [])) for name in CATALOG}
    return Warehouse(raw, loaded_at)


def rows(df):
    return [tuple(r) for r in df.collect()]


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def sale(txn, customer=1, store=1, employee=1, when="2024-03-05T10:00:00", status="completed", **more):
    return dict(
        transaction_id=txn,
        customer_id=customer,
        store_id=store,
        employee_id=employee,
        transaction_date=ts(when),
        status=status,
        payment_method=more.pop("payment", "Cash"),
        **more,
    )


def line(item, txn, product=1, qty=1, price="10", subtotal=None, **more):
    return dict(
        item_id=item,
        transaction_id=txn,
        product_id=product,
        quantity=qty,
        unit_price=price,
        subtotal=price if subtotal is None else subtotal,
        **more,
    )
