"""Sales and verification reports.

Joins of the fact with the dimension aggregate the fact per customer
*before* the join.  SUM and COUNT are linear, so per-customer partial
results joined to the dimension give exactly the sums of the row-level
join, also when the dimension holds a customer_id twice (each copy
multiplies the partial, as it would multiply the rows).  The join then
sees at most one row per customer instead of one per order, and a
customer owning a third of all orders is folded by the map-side partial
aggregation instead of landing in one join task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.amounts import sum_amount
from ..functions.clean import month_bucket


def monthly_sales(fact: DataFrame) -> DataFrame:
    """Month, orders, sales; by month."""
    return (fact.groupBy(month_bucket("order_date").alias("sales_month"))
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 sum_amount("total_amount").alias("total_sales"))
            .orderBy(F.col("sales_month").asc_nulls_first()))


def _per_customer(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("customer_id")
            .agg(F.count("order_id").alias("_orders"),
                 F.sum("total_amount").alias("_sales")))


def sales_by_city(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """R2: city, orders, sales; sales descending (city breaks ties)."""
    joined = _per_customer(fact).join(dim.select("customer_id", "city"), "customer_id", "inner")
    return (joined.groupBy("city")
            .agg(F.sum("_orders").cast("bigint").alias("total_orders"),
                 sum_amount("_sales").alias("total_sales"))
            .orderBy(F.col("total_sales").desc_nulls_last(), F.col("city").asc_nulls_first()))


def sales_by_customer(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Customer, name, orders, sales; sales descending (id breaks ties)."""
    joined = _per_customer(fact).join(
        dim.select("customer_id", "customer_name"), "customer_id", "inner")
    return (joined.groupBy("customer_id", "customer_name")
            .agg(F.sum("_orders").cast("bigint").alias("total_orders"),
                 sum_amount("_sales").alias("total_sales"))
            .orderBy(F.col("total_sales").desc_nulls_last(),
                     F.col("customer_id").asc_nulls_first()))


def surrogate_key_listing(dim: DataFrame) -> DataFrame:
    """Surrogate and business key side by side, by key."""
    return (dim.select(F.col("customer_key").alias("surrogate_key"),
                       F.col("customer_id").alias("source_business_key"),
                       "customer_name", "city", "email")
            .orderBy("surrogate_key"))


def surrogate_key_audit(dim: DataFrame) -> DataFrame:
    """R5 (A9): rows, rows with a key, distinct keys."""
    return dim.agg(F.count(F.lit(1)).alias("total_customers"),
                   F.count("customer_key").alias("customers_with_surrogate_keys"),
                   F.count_distinct("customer_key").alias("unique_surrogate_keys"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """R6 (A1): one row per table with its row count, in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, cols: list[str], order_by: str, n: int = 10) -> DataFrame:
    """R7 (O3): a LIMIT 10 preview, ordered so that it is repeatable.

    The limit is the feature here; ``orderBy(...).limit`` runs as a
    top-k (TakeOrderedAndProject), not as a global sort.
    """
    return df.select(*cols).orderBy(F.col(order_by).asc_nulls_first(), *cols).limit(n)
