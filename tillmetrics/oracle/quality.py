"""SQL of the quality checks, one SELECT per table and check."""

from __future__ import annotations

# What each table must keep, written out for the SQL.
_CRITICAL = {
    "customers": ["customer_id", "email", "first_name", "last_name"],
    "products": ["product_id", "product_name", "price"],
    "orders": ["order_id", "customer_id", "order_date", "total_amount"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity"],
    "payments": ["payment_id", "order_id", "amount", "payment_status"],
}
_REQUIRED = {
    "customers": [
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "signup_date",
        "customer_tier",
        "country",
        "city",
        "loyalty_score",
    ],
    "products": [
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "price",
        "cost_price",
        "stock_quantity",
        "supplier",
        "creation_date",
    ],
    "orders": [
        "order_id",
        "customer_id",
        "order_date",
        "status",
        "shipping_country",
        "shipping_city",
        "total_amount",
    ],
    "order_items": [
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        "subtotal",
    ],
    "payments": [
        "payment_id",
        "order_id",
        "payment_method",
        "amount",
        "payment_status",
        "payment_date",
        "transaction_id",
        "risk_score",
    ],
}
_LENGTHS = {
    "customers": {
        "first_name": 100,
        "last_name": 100,
        "email": 255,
        "customer_tier": 20,
        "country": 100,
        "city": 100,
    },
    "products": {"product_name": 255, "category": 100, "subcategory": 100, "supplier": 255},
    "orders": {"status": 50, "shipping_country": 100, "shipping_city": 100},
    "payments": {"payment_method": 50, "payment_status": 50, "transaction_id": 50},
}
_DOMAINS = {
    ("customers", "customer_tier"): "'standard', 'premium'",
    ("products", "category"): "'Electronics', 'Clothing', 'Home & Garden', 'Books', 'Sports', "
    "'Beauty'",
    ("orders", "status"): "'pending', 'processing', 'shipped', 'delivered', 'cancelled'",
    ("payments", "payment_method"): "'credit_card', 'debit_card', 'paypal', 'apple_pay'",
    ("payments", "payment_status"): "'completed', 'failed', 'refunded'",
}
_RANGES = [
    ("order_items", "range", "quantity", "quantity <= 0"),
    ("order_items", "integrity_range", "quantity", "quantity <= 0"),
    ("order_items", "integrity_range", "unit_price", "unit_price < 0"),
    ("products", "range", "price", "price < 0"),
    ("products", "integrity_range", "price", "price <= 0"),
]
_UNIQUE = [
    ("customers", "customer_id"),
    ("customers", "email"),
    ("products", "product_id"),
    ("orders", "order_id"),
    ("order_items", "order_item_id"),
    ("payments", "payment_id"),
    ("payments", "transaction_id"),
]
_REFERENCES = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("payments", "order_id", "orders"),
]


def _view(table: str) -> str:
    return "v_orders_full" if table == "orders" else f"v_{table}"


def _check(table: str, check: str, column: str, violations: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
        f"CAST({violations} AS BIGINT) AS violations, {violations} = 0 AS passed FROM {source}"
    )


def _count(table: str, check: str, column: str, condition: str) -> str:
    return _check(table, check, column, f"count(*) FILTER ({condition})", _view(table))


def _nulls(columns: dict[str, list[str]], check: str) -> list[str]:
    return [
        _count(t, check, c, f"{c} IS NULL") for t, names in columns.items() for c in names
    ]


def _all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _unique(table: str, column: str) -> str:
    return _check(table, "unique", column, f"(count({column}) - count(DISTINCT {column}))",
                  f"v_{table}")


def _reference(table: str, column: str, parent: str) -> str:
    orphan = f"SELECT * FROM v_{table} c WHERE {column} IS NOT NULL AND NOT EXISTS " \
             f"(SELECT 1 FROM v_{parent} p WHERE p.{column} = c.{column})"  # fmt: skip
    return _check(table, "reference", column, "count(*)", f"({orphan})")


# Columns and types of the tables.
_TYPES = {
    "customers": [
        ("customer_id", "bigint"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("email", "string"),
        ("signup_date", "date"),
        ("customer_tier", "string"),
        ("country", "string"),
        ("city", "string"),
        ("loyalty_score", "double"),
        ("is_active", "boolean"),
    ],
    "products": [
        ("product_id", "bigint"),
        ("product_name", "string"),
        ("category", "string"),
        ("subcategory", "string"),
        ("price", "decimal(18,2)"),
        ("cost_price", "decimal(18,2)"),
        ("stock_quantity", "int"),
        ("supplier", "string"),
        ("creation_date", "date"),
        ("is_active", "boolean"),
    ],
    "orders": [
        ("order_id", "bigint"),
        ("customer_id", "bigint"),
        ("order_date", "timestamp_ntz"),
        ("status", "string"),
        ("shipping_country", "string"),
        ("shipping_city", "string"),
        ("total_amount", "decimal(18,2)"),
    ],
    "order_items": [
        ("order_item_id", "bigint"),
        ("order_id", "bigint"),
        ("product_id", "bigint"),
        ("quantity", "int"),
        ("unit_price", "decimal(18,2)"),
        ("subtotal", "decimal(18,2)"),
    ],
    "payments": [
        ("payment_id", "bigint"),
        ("order_id", "bigint"),
        ("payment_method", "string"),
        ("amount", "decimal(18,2)"),
        ("payment_status", "string"),
        ("payment_date", "timestamp_ntz"),
        ("transaction_id", "string"),
        ("risk_score", "double"),
    ],
}
_DESCRIPTIONS = {
    "customers": "One row per customer with contact, place, tier and loyalty score",
    "products": "One row per product with price, cost and stock",
    "orders": "One row per order with customer, time, status and total",
    "order_items": "One row per order line with product, quantity and charged amount",
    "payments": "One row per payment attempt with method, amount, outcome and risk score",
}


def _profile(table: str) -> list[str]:
    columns = _TYPES[table]
    return [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, "
        f"{len(columns)} AS total_columns, count(*) FILTER ({c} IS NULL) AS null_count "
        f"FROM {_view(table)}"
        for c, _ in columns
    ]


def _document(table: str) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, {i + 1} AS position, '{c}' AS column_name, "
        f"'{kind}' AS data_type, count(*) AS row_count, "
        f"'{_DESCRIPTIONS[table]}' AS description FROM {_view(table)}"
        for i, (c, kind) in enumerate(_TYPES[table])
    ]


_RECONCILED = """
totals AS (
  SELECT o.order_id, o.total_amount, i.items_total, coalesce(i.line_count, 0) AS line_count
  FROM v_orders o LEFT JOIN (
    SELECT order_id, sum(subtotal) AS items_total, count(*) AS line_count
    FROM v_order_items GROUP BY order_id) i USING (order_id)),
reconciled AS (
  SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount,
         CAST(items_total AS DOUBLE) AS items_total, line_count,
         CAST(total_amount - items_total AS DOUBLE) AS difference,
         CASE WHEN line_count = 0 THEN 'no_items'
              WHEN abs(total_amount - items_total) <= line_count * 0.01 THEN 'match'
              ELSE 'mismatch' END AS verdict
  FROM totals)
"""

_PAID = "v_payments p LEFT JOIN v_orders o USING (order_id)"


_PAYMENT_RULES = {
    ("order_amount", "amount"): "amount <> total_amount",
    ("payment_window", "payment_date"): "payment_date <= order_date OR "
    "payment_date >= order_date + INTERVAL 24 HOUR",
    ("order_status", "payment_status"): "(status = 'cancelled' AND payment_status NOT IN "
    "('refunded', 'failed')) OR (status <> 'cancelled' AND payment_status NOT IN "
    "('completed', 'failed'))",
}


def _violating_payments() -> str:
    names = ", ".join(
        f"CASE WHEN {condition} THEN '{check}:{column}' END"
        for (check, column), condition in _PAYMENT_RULES.items()
    )
    return f"""
SELECT payment_id, concat_ws(', ', {names}) AS violated_rules FROM {_PAID}
WHERE {" OR ".join(f"({c})" for c in _PAYMENT_RULES.values())}"""


def _payment(check: str, column: str, condition: str) -> str:
    return _check("payments", check, column, f"count(*) FILTER ({condition})", _PAID)


def _priced(table: str, check: str, column: str, condition: str) -> str:
    source = (
        "v_products"
        if table == "products"
        else "v_order_items JOIN v_products USING (product_id)"
    )
    return _check(table, check, column, f"count(*) FILTER ({condition})", source)


# What price and stock of a category keep to, and those of any other category.
_CATEGORY_RULES = """
rules(category, multiplier, low, high) AS (VALUES
  ('Electronics', 1.2, 10, 100), ('Clothing', 1.0, 20, 200), ('Books', 0.7, 50, 500),
  ('Sports', 0.9, 10, 100), ('Home & Garden', 0.8, 15, 150), ('Beauty', 1.1, 25, 250))"""
# Every product with its multiplier and stock range; dear electronics have one of their own.
_RULED = """(
  SELECT p.*, coalesce(multiplier, 1.0) AS multiplier,
         CASE WHEN p.category = 'Electronics' AND price > 100 THEN 5 ELSE coalesce(low, 10) END AS low,
         CASE WHEN p.category = 'Electronics' AND price > 100 THEN 50 ELSE coalesce(high, 100) END AS high
  FROM v_products p LEFT JOIN rules r ON r.category = p.category)"""


def _ruled(check: str, column: str, condition: str) -> str:
    return _check("products", check, column, f"count(*) FILTER ({condition})", _RULED)


_PRICING = [
    _ruled("price_range", "price", "price < 5 * multiplier OR price > 500 * multiplier"),
    _priced(
        "products",
        "cost_range",
        "cost_price",
        "cost_price < price * 0.3 - 0.005 OR cost_price > price * 0.7 + 0.005",
    ),
    _ruled("stock_range", "stock_quantity", "stock_quantity < low OR stock_quantity >= high"),
    _priced(
        "order_items",
        "discount_range",
        "unit_price",
        "unit_price < price * 0.8 - 0.005 OR unit_price > price + 0.005",
    ),
]


def issues(table: str, only: str = "true") -> str:
    """What keeps a table from being loaded, as text; empty if nothing does."""
    counts = [(f"null({c})", f"count(*) FILTER ({c} IS NULL)") for c in _CRITICAL[table]]
    counts += [(f"required({c})", f"count(*) FILTER ({c} IS NULL)") for c in _REQUIRED[table]]
    counts += [
        (f"range({c})", f"count(*) FILTER ({condition})")
        for t, check, c, condition in _RANGES
        if t == table and check == "range"
    ]
    counts += [(f"unique({c})", f"(count({c}) - count(DISTINCT {c}))") for t, c in _UNIQUE if t == table]
    found = ", ".join(f"CASE WHEN {n} > 0 THEN '{name}=' || {n} END" for name, n in counts)
    return f"array_to_string(list_sort(list_filter([{found}], lambda x: x IS NOT NULL)), ', ')"


def _validation(table: str) -> str:
    columns = [c for c, _ in _TYPES[table]]
    nulls = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns)
    return (
        f"SELECT '{table}' AS table_name, {issues(table)} = '' AS is_valid, "
        f"{issues(table)} AS issues, count(*) AS total_rows, {len(columns)} AS total_columns, "
        f"CAST({nulls} AS BIGINT) AS null_values FROM {_view(table)}"
    )


QUALITY_SQL: dict[str, str] = {
    "dq_nulls": _all(_nulls(_CRITICAL, "null")),
    "dq_ranges": _all([_count(*r) for r in _RANGES]),
    "dq_declared": _all(
        _nulls(_REQUIRED, "required")
        + [
            _count(t, "length", c, f"length({c}) > {n}")
            for t, limits in _LENGTHS.items()
            for c, n in limits.items()
        ]
    ),
    "dq_domains": _all(
        [_count(t, "domain", c, f"{c} NOT IN ({v})") for (t, c), v in _DOMAINS.items()]
    ),
    "dq_line_amounts": _all(
        [
            _count(
                "order_items", "exact_line_amount", "subtotal", "subtotal <> quantity * unit_price"
            ),
            _count(
                "order_items",
                "line_amount",
                "subtotal",
                "abs(subtotal - quantity * unit_price) > quantity * 0.01",
            ),
        ]
    ),
    "dq_unique": _all([_unique(t, c) for t, c in _UNIQUE]),
    "dq_fk": _all([_reference(*r) for r in _REFERENCES]),
    "dq_profile": _all([part for t in _TYPES for part in _profile(t)]),
    "dq_order_reconciliation": f"WITH {_RECONCILED} SELECT * FROM reconciled",
    "dq_order_reconciliation_summary": f"""WITH {_RECONCILED}
SELECT verdict, count(*) AS order_count FROM reconciled GROUP BY verdict""",
    "dq_payment_reconciliation": _all(
        [_payment(check, column, c) for (check, column), c in _PAYMENT_RULES.items()]
    ),
    "dq_pricing": f"WITH {_CATEGORY_RULES} {_all(_PRICING)}",
    "dq_violating_payments": _violating_payments(),
    "dq_duplicate_keys": """
SELECT order_item_id, count(*) AS copies FROM v_order_items
GROUP BY order_item_id HAVING count(*) > 1""",
    "dq_integrity": _all(
        [_reference(*r) for r in _REFERENCES]
        + [_count(*r) for r in _RANGES if r[1] == "integrity_range"]
    ),
    "dq_validation": _all([_validation(t) for t in _TYPES]),
    "table_schema_doc": _all([part for t in _TYPES for part in _document(t)]),
}
