"""Path-based Parquet tables with declared schemas (K1-K3, K6).

A table is a Parquet directory under the warehouse root.  Writes project
and cast to the declared schema (so a bad type fails at plan time, not
half-way through a write); reads pass the declared schema, so no schema
inference pass over the files is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import TABLES, ddl


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def conform(self, name: str, df: DataFrame) -> DataFrame:
        schema = TABLES[name]
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

    def write(self, name: str, df: DataFrame, mode: str = "overwrite",
              partition_by: list[str] | None = None) -> None:
        """K1/K3: full refresh (truncate + insert) is an overwrite."""
        w = self.conform(name, df).write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(self.path(name))

    def create_tables(self, database: str, names: list[str] | None = None) -> None:
        """K6: register each table with its declared DDL in a catalog database.

        The database lives in the warehouse folder (shared storage), not in
        a machine-local default warehouse directory.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/_catalog'")
        for name in names or list(TABLES):
            self.spark.sql(ddl(f"{database}.{name}", TABLES[name], self.path(name)))

    def describe(self, database: str, name: str) -> DataFrame:
        """(table_name, col_name, data_type) of a registered table."""
        return (self.spark.sql(f"DESCRIBE TABLE {database}.{name}")
                .where(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))
                .select(F.lit(name).alias("table_name"), "col_name", "data_type"))
