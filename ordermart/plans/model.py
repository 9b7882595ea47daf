"""Full-refresh model: staging (K1), transform (K2), dimension/fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.amounts import to_price, total_refresh
from ..functions.clean import clean_text, lower_trim, trim_spaces
from ..functions.parse import parse_date_loose, parse_decimal, parse_int
from ..operators.keys import add_row_number
from ..schemas import CUSTOMER_COLUMNS, FACT_COLUMNS, ORDER_COLUMNS


def stage_customers(raw: DataFrame) -> DataFrame:
    """K1: raw text -> stg_customers types (strings + DATE)."""
    return raw.select("customer_id", "customer_name", "city", "email",
                      parse_date_loose("created_date").alias("created_date"))


def stage_orders(raw: DataFrame, keep_raw: bool = False) -> DataFrame:
    """K1: raw text -> stg_orders types (INT quantity, DECIMAL(12,2) price).

    ``keep_raw`` carries the number texts along, for the type-limit rules.
    """
    extra = ([F.col("quantity").alias("quantity_text"),
              F.col("unit_price").alias("unit_price_text")] if keep_raw else [])
    return raw.select("order_id", "customer_id",
                      parse_date_loose("order_date").alias("order_date"),
                      parse_int("quantity").alias("quantity"),
                      to_price(parse_decimal("unit_price")).alias("unit_price"), *extra)


def transform_customers(stg: DataFrame) -> DataFrame:
    """K2 customers: trim id, clean name and city, normalise e-mail."""
    return stg.select(trim_spaces("customer_id").alias("customer_id"),
                      clean_text("customer_name").alias("customer_name"),
                      clean_text("city").alias("city"),
                      lower_trim("email").alias("email"),
                      "created_date")


def transform_orders(stg: DataFrame) -> DataFrame:
    """K2 orders: total_amount = quantity * unit_price."""
    extra = [c for c in stg.columns if c not in ORDER_COLUMNS]
    return stg.select(*ORDER_COLUMNS,
                      total_refresh("quantity", "unit_price").alias("total_amount"), *extra)


def build_dim_customer(customers: DataFrame) -> DataFrame:
    """K3 + W1: dim_customer with customer_key = row number by customer_id."""
    return add_row_number(customers.select(*CUSTOMER_COLUMNS), "customer_id", "customer_key")


def build_fact_order(orders: DataFrame) -> DataFrame:
    """K3: fact_order, one row per order, explicit column list."""
    return orders.select(*FACT_COLUMNS)


def model_from_raw(raw_customers: DataFrame, raw_orders: DataFrame):
    """(stg_customers, stg_orders, transformed customers, transformed orders)."""
    stg_c = stage_customers(raw_customers)
    stg_o = stage_orders(raw_orders)
    return stg_c, stg_o, transform_customers(stg_c), transform_orders(stg_o)
