"""Declared table schemas (never inferred) and their type limits.

The warehouse types of the source project are VARCHAR(n), DATE,
DATETIME, INT, BIGINT and DECIMAL(p,s).  Spark strings have no length
limit, so the ``n`` of each VARCHAR is kept here and enforced as a data
quality rule (see ``operators.quality``).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DateType()

# Column names, order and VARCHAR lengths of the source DDL.
CUSTOMER_COLUMNS = ["customer_id", "customer_name", "city", "email", "created_date"]
ORDER_COLUMNS = ["order_id", "customer_id", "order_date", "quantity", "unit_price"]
FACT_COLUMNS = ORDER_COLUMNS + ["total_amount"]
DIM_COLUMNS = ["customer_key"] + CUSTOMER_COLUMNS
TRACKER_COLUMNS = ["file_name", "status", "processed_at", "record_count", "error_message"]

VARCHAR_LIMITS = {
    "customers": {"customer_id": 50, "customer_name": 150, "city": 100, "email": 200},
    "orders": {"order_id": 50, "customer_id": 50},
    "tracker": {"file_name": 500, "status": 20, "error_message": 1000},
}

PRICE_TYPE = T.DecimalType(12, 2)
TOTAL_TYPE = T.DecimalType(14, 2)
# Report sums are widened to the largest decimal, as a warehouse does.
SUM_TYPE = T.DecimalType(38, 2)
# Parse type for raw prices: as many integer digits as PRICE_TYPE has, and
# 17 fraction digits, so that the product with an INT quantity (10 digits)
# fits in 38 digits without rounding.  Prices with more decimals are a
# violation (D17), never rounded.
RAW_PRICE_TYPE = T.DecimalType(27, 17)


def _struct(fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


STG_CUSTOMERS = _struct([
    ("customer_id", S, True), ("customer_name", S, True), ("city", S, True),
    ("email", S, True), ("created_date", D, True)])

STG_ORDERS = _struct([
    ("order_id", S, True), ("customer_id", S, True), ("order_date", D, True),
    ("quantity", T.IntegerType(), True), ("unit_price", PRICE_TYPE, True)])

FACT_ORDER = _struct([(f.name, f.dataType, True) for f in STG_ORDERS.fields]
                     + [("total_amount", TOTAL_TYPE, True)])

DIM_CUSTOMER = _struct([("customer_key", T.LongType(), False)]
                       + [(f.name, f.dataType, True) for f in STG_CUSTOMERS.fields])

# Incremental tables: same columns, unique business key.
INC_CUSTOMERS = STG_CUSTOMERS
INC_ORDERS = FACT_ORDER

TRACKER = _struct([
    ("file_name", S, False), ("status", S, True),
    ("processed_at", T.TimestampType(), True),
    ("record_count", T.LongType(), True), ("error_message", S, True)])

TABLES = {
    "stg_customers": STG_CUSTOMERS,
    "stg_orders": STG_ORDERS,
    "dim_customer": DIM_CUSTOMER,
    "fact_order": FACT_ORDER,
    "inc_customers": INC_CUSTOMERS,
    "inc_orders": INC_ORDERS,
    "ingestion_tracker": TRACKER,
}

# Unique keys of the upsert tables.
TABLE_KEYS = {"inc_customers": "customer_id", "inc_orders": "order_id",
              "ingestion_tracker": "file_name"}


def describe(schema: T.StructType) -> list[tuple[str, str]]:
    """(column, type) pairs, like ``DESCRIBE``."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def ddl(name: str, schema: T.StructType, location: str) -> str:
    """``CREATE TABLE`` text for a Parquet table at ``location``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     + ("" if f.nullable else " NOT NULL") for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet LOCATION '{location}'"
