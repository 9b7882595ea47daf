"""Surrogate keys: ``ROW_NUMBER() OVER (ORDER BY key)`` without one task.

A global ``row_number`` window has no partition clause, so Spark moves
every row into a single task.  Here the rows are range-partitioned on
the order key (plus the scan position as tie-break, so a key held by a
third of all rows is still split over many partitions), sorted inside
each partition, and numbered as

    key = rows in all earlier partitions + position in own partition.

The number of ranges is left to adaptive execution, which joins
neighbouring ranges by their bytes; a range keeps its place in the order.
The per-partition counts are one row per partition (bounded by the
partition count), so broadcasting them is safe.  The ranged data is
written once, as Parquet in the shared folder: range bounds come
from sampling, so two evaluations could cut differently, and a lost
executor must not change the numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import written

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | row position


def add_row_number(df: DataFrame, order_col: str | list[str], key_col: str,
                   num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY order_col...)`` as a bigint column, distributed."""
    order = [F.col(c).asc_nulls_first() for c in ([order_col] if isinstance(order_col, str) else order_col)]
    ranged = (df.withColumn("_scan_pos", F.monotonically_increasing_id())
              .repartitionByRange(*([num_partitions] if num_partitions else []), *order, F.col("_scan_pos"))
              .sortWithinPartitions(*order, F.col("_scan_pos"))
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("bigint"), _POS_BITS))
              .drop("_scan_pos"))
    ranged = written(ranged, "ranged")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a tiny frame, numbered in a single task on purpose
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_offset"))
    offsets = offsets.select("_part", F.coalesce("_offset", F.lit(0)).alias("_offset"))
    keyed = ranged.join(F.broadcast(offsets), "_part", "inner")
    cols = [c for c in df.columns]
    return keyed.select((F.col("_offset") + F.col("_pos") + 1).alias(key_col), *cols)
