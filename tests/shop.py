"""Small hand-built tables: rows name only the columns a test is about."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tillmetrics.schemas import TABLES

DEFAULTS = {
    "customers": {
        "first_name": "Ann",
        "last_name": "Lee",
        "signup_date": dt.date(2023, 1, 1),
        "customer_tier": "standard",
        "country": "Peru",
        "city": "Lima",
        "loyalty_score": 50.0,
        "is_active": True,
    },
    "products": {
        "product_name": "Thing",
        "category": "Books",
        "subcategory": "novel",
        "price": 10,
        "cost_price": 5,
        "stock_quantity": 100,
        "supplier": "Acme",
        "creation_date": dt.date(2022, 1, 1),
        "is_active": True,
    },
    "orders": {
        "customer_id": 1,
        "order_date": dt.datetime(2023, 3, 1, 12),
        "status": "delivered",
        "shipping_country": "Peru",
        "shipping_city": "Lima",
        "total_amount": 100,
    },
    "order_items": {
        "order_id": 1,
        "product_id": 1,
        "quantity": 1,
        "unit_price": 10,
        "subtotal": 10,
    },
    "payments": {
        "order_id": 1,
        "payment_method": "paypal",
        "amount": 100,
        "payment_status": "completed",
        "payment_date": dt.datetime(2023, 3, 1, 14),
        "risk_score": 0.1,
    },
}
PER_ROW = {  # unique values, from the row's number
    "email": lambda i: f"user{i}@example.com",
    "transaction_id": lambda i: f"txn-{i}",
}


def frame(spark, name, rows=()):
    """A table whose missing columns have defaults and whose keys count from one."""
    table = TABLES[name]
    records = []
    for i, row in enumerate(rows, 1):
        record = []
        for f in table.schema.fields:
            if f.name in row:
                value = row[f.name]
            elif f.name == table.primary_key:
                value = i
            elif f.name in PER_ROW:
                value = PER_ROW[f.name](i)
            else:
                value = DEFAULTS[name][f.name]
            if f.dataType.typeName() == "decimal" and value is not None:
                value = Decimal(str(value))
            record.append(value)
        records.append(tuple(record))
    nullable = [(f.name, f.dataType) for f in table.schema.fields]
    schema = ", ".join(f"{n} {t.simpleString()}" for n, t in nullable)
    return spark.createDataFrame(records, schema)


def shop(spark, **tables):
    return {name: frame(spark, name, tables.get(name, ())) for name in TABLES}


def rows(df):
    return [r.asDict() for r in df.collect()]


def by(df, column):
    return {r[column]: r.asDict() for r in df.collect()}
