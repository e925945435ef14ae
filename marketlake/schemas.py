"""Explicit schemas: nothing is inferred, so empty folders and odd files cost no extra pass."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, DOUBLE, INT, FLAG = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


ITEM = struct(product_id=TEXT, category=TEXT, quantity=INT, unit_price=DOUBLE, freight=DOUBLE)
ADDRESS = struct(city=TEXT, state=TEXT, country=TEXT)

ORDER_EVENT = struct(
    event_type=TEXT,
    event_id=TEXT,
    order_id=TEXT,
    customer_id=TEXT,
    customer_tier=TEXT,
    items=T.ArrayType(ITEM),
    subtotal=DOUBLE,
    discount=DOUBLE,
    total=DOUBLE,
    payment_method=TEXT,
    shipping_address=ADDRESS,
    status=TEXT,
    created_at=TEXT,
    is_suspicious=FLAG,
)

# The raw zone also holds orders whose amounts were stored as text, and the stored score.
RAW_ORDER = struct(
    event_type=TEXT,
    event_id=TEXT,
    order_id=TEXT,
    customer_id=TEXT,
    customer_tier=TEXT,
    items=T.ArrayType(ITEM),
    subtotal=TEXT,
    discount=TEXT,
    total=TEXT,
    payment_method=TEXT,
    shipping_address=ADDRESS,
    status=TEXT,
    created_at=TEXT,
    is_suspicious=FLAG,
    fraud_score=TEXT,
    fraud_flags=T.ArrayType(TEXT),
)

CLICK_EVENT = struct(
    event_type=TEXT,
    event_id=TEXT,
    session_id=TEXT,
    customer_id=TEXT,
    product_id=TEXT,
    action=TEXT,
    page=TEXT,
    referrer=TEXT,
    device=TEXT,
    timestamp=TEXT,
    duration_ms=INT,
)

INVENTORY_EVENT = struct(
    event_type=TEXT,
    event_id=TEXT,
    product_id=TEXT,
    category=TEXT,
    previous_stock=INT,
    current_stock=INT,
    delta=INT,
    warehouse_id=TEXT,
    timestamp=TEXT,
)

FRAUD_ALERT = struct(
    order_id=TEXT,
    customer_id=TEXT,
    total=DOUBLE,
    fraud_score=DOUBLE,
    fraud_flags=T.ArrayType(TEXT),
    timestamp=TEXT,
)

RECO_REQUEST = struct(customer_id=TEXT, n=INT, category=TEXT)

# Header CSV tables: the columns in use.
CSV_TABLES = {
    "orders": struct(order_id=TEXT, customer_id=TEXT, order_status=TEXT),
    "order_items": struct(order_id=TEXT, product_id=TEXT, price=DOUBLE, freight_value=DOUBLE),
    "payments": struct(order_id=TEXT, payment_sequential=INT, payment_type=TEXT, payment_value=DOUBLE),
    "customers": struct(customer_id=TEXT, customer_unique_id=TEXT, customer_city=TEXT, customer_state=TEXT),
    "products": struct(product_id=TEXT, product_category_name=TEXT),
    "sellers": struct(seller_id=TEXT),
    "translations": struct(product_category_name=TEXT, product_category_name_english=TEXT),
}
