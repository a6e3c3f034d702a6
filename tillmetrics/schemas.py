"""The five tables: columns, keys and the rules their values must keep.

Spark does not enforce nullability or keys when it reads files, so everything
declared here is turned into checks by ``tillmetrics.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(*columns: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType(
        [T.StructField(c[0], c[1], c[2] if len(c) > 2 else False) for c in columns]
    )


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    primary_key: str
    description: str
    critical: tuple[str, ...]
    unique: tuple[str, ...] = ()
    foreign_keys: dict[str, str] = field(default_factory=dict)  # column -> parent table
    max_length: dict[str, int] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


# The value sets, length limits and critical columns of the data model.
ORDER_STATUSES = ("pending", "processing", "shipped", "delivered", "cancelled")
PAYMENT_STATUSES = ("completed", "failed", "refunded")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "apple_pay")
CUSTOMER_TIERS = ("standard", "premium")
CATEGORIES = ("Electronics", "Clothing", "Home & Garden", "Books", "Sports", "Beauty")

CUSTOMERS = Table(
    name="customers",
    description="One row per customer with contact, place, tier and loyalty score",
    schema=_struct(
        ("customer_id", T.LongType()),
        ("first_name", T.StringType()),
        ("last_name", T.StringType()),
        ("email", T.StringType()),
        ("signup_date", T.DateType()),
        ("customer_tier", T.StringType()),
        ("country", T.StringType()),
        ("city", T.StringType()),
        ("loyalty_score", T.DoubleType()),
        ("is_active", T.BooleanType(), True),
    ),
    primary_key="customer_id",
    critical=("customer_id", "email", "first_name", "last_name"),
    unique=("email",),
    max_length={
        "first_name": 100,
        "last_name": 100,
        "email": 255,
        "customer_tier": 20,
        "country": 100,
        "city": 100,
    },
    domains={"customer_tier": CUSTOMER_TIERS},
)

PRODUCTS = Table(
    name="products",
    description="One row per product with price, cost and stock",
    schema=_struct(
        ("product_id", T.LongType()),
        ("product_name", T.StringType()),
        ("category", T.StringType()),
        ("subcategory", T.StringType()),
        ("price", MONEY),
        ("cost_price", MONEY),
        ("stock_quantity", T.IntegerType()),
        ("supplier", T.StringType()),
        ("creation_date", T.DateType()),
        ("is_active", T.BooleanType(), True),
    ),
    primary_key="product_id",
    critical=("product_id", "product_name", "price"),
    max_length={"product_name": 255, "category": 100, "subcategory": 100, "supplier": 255},
    domains={"category": CATEGORIES},
)

ORDERS = Table(
    name="orders",
    description="One row per order with customer, time, status and total",
    schema=_struct(
        ("order_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("order_date", T.TimestampNTZType()),
        ("status", T.StringType()),
        ("shipping_country", T.StringType()),
        ("shipping_city", T.StringType()),
        ("total_amount", MONEY),
    ),
    primary_key="order_id",
    critical=("order_id", "customer_id", "order_date", "total_amount"),
    foreign_keys={"customer_id": "customers"},
    max_length={"status": 50, "shipping_country": 100, "shipping_city": 100},
    domains={"status": ORDER_STATUSES},
)

ORDER_ITEMS = Table(
    name="order_items",
    description="One row per order line with product, quantity and charged amount",
    schema=_struct(
        ("order_item_id", T.LongType()),
        ("order_id", T.LongType()),
        ("product_id", T.LongType()),
        ("quantity", T.IntegerType()),
        ("unit_price", MONEY),
        ("subtotal", MONEY),
    ),
    primary_key="order_item_id",
    critical=("order_item_id", "order_id", "product_id", "quantity"),
    foreign_keys={"order_id": "orders", "product_id": "products"},
)

PAYMENTS = Table(
    name="payments",
    description="One row per payment attempt with method, amount, outcome and risk score",
    schema=_struct(
        ("payment_id", T.LongType()),
        ("order_id", T.LongType()),
        ("payment_method", T.StringType()),
        ("amount", MONEY),
        ("payment_status", T.StringType()),
        ("payment_date", T.TimestampNTZType()),
        ("transaction_id", T.StringType()),
        ("risk_score", T.DoubleType()),
    ),
    primary_key="payment_id",
    critical=("payment_id", "order_id", "amount", "payment_status"),
    unique=("transaction_id",),
    foreign_keys={"order_id": "orders"},
    max_length={"payment_method": 50, "payment_status": 50, "transaction_id": 50},
    domains={"payment_method": PAYMENT_METHODS, "payment_status": PAYMENT_STATUSES},
)

# Parents come before the children that refer to them.
TABLES: dict[str, Table] = {
    t.name: t for t in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS)
}
