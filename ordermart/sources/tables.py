"""Reading the given Parquet tables."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession

# The given tables are read-only: one lazy DataFrame per session and path
# saves the file listing and footer reads of a new ``read.parquet`` call.
_READS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()

GIVEN_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                "lineitem", "events", "documents", "embeddings", "pages",
                "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    path = table_path(sf_dir, name)
    per_session = _READS.setdefault(spark, {})
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]
