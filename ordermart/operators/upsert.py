"""Unique-key tables as append-only change logs (K4, K5).

A warehouse UNIQUE KEY table (a later row replaces an earlier one with the
same key) is kept as Parquet partitioned by ``batch_id``.  A run writes
its rows into its own batch partition (dynamic partition overwrite, so a
replayed batch replaces itself: idempotent), and readers see the latest
row per key in the order of, e.g., (batch_id, file_ordinal,
row_number): last batch, then last file, then last row wins, and the
whole row is replaced.

The greatest order number of a key is an ordinary hash aggregate with a
map-side partial step, so a key that holds a third of all rows is reduced
inside each task before the shuffle; no group is ever collected whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def folder_values(spark: SparkSession, path: str, name: str) -> list[int]:
    """Values of the folders ``name=value`` in ``path``; no file is opened."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{name}="))


class ChangeLog:
    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType,
                 order_cols: tuple[str, ...]):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = schema            # value columns (incl. key), without batch_id
        self.order_cols = order_cols    # tie-break columns inside a batch

    @property
    def log_schema(self) -> T.StructType:
        fields = list(self.schema.fields) + [T.StructField(c, T.LongType()) for c in self.order_cols]
        return T.StructType(fields + [T.StructField("batch_id", T.LongType())])

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Write one batch; a replay of the same batch replaces it."""
        cols = [F.col(f.name).cast(f.dataType).alias(f.name)
                for f in self.log_schema.fields if f.name != "batch_id"]
        (rows.select(*cols, F.lit(batch_id).cast("long").alias("batch_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(self.path))

    def log(self) -> DataFrame:
        if not _exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.log_schema)
        return self.spark.read.schema(self.log_schema).parquet(self.path)

    def batches(self) -> list[int]:
        """Batch ids in the log, from its folder names."""
        return folder_values(self.spark, self.path, "batch_id")

    def max_batch(self) -> int:
        return max(self.batches(), default=0)

    def drop_batch(self, batch_id: int) -> None:
        fs, p = _fs(self.spark, f"{self.path}/batch_id={batch_id}")
        fs.delete(p, True)

    def bytes(self) -> int:
        """Size of the log's files (file metadata only)."""
        fs, p = _fs(self.spark, self.path)
        return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0

    def _rank(self) -> Column:
        """One fixed-width number in the order of (batch_id, order_cols); -1 is the least order value.

        A batch id has up to 13 digits, a file ordinal 11 and a row number 14.
        """
        digits = (11, 14)[-len(self.order_cols):]
        rank = F.col("batch_id").cast("decimal(38,0)")
        for c, n in zip(self.order_cols, digits):
            rank = (rank * F.lit(10 ** n).cast("decimal(15,0)") + F.col(c) + 1).cast("decimal(38,0)")
        return rank

    def latest(self, log: DataFrame | None = None) -> DataFrame:
        """One row per key: the row with the greatest (batch_id, order_cols).

        The greatest rank of a key is a hash aggregate over a number; the
        rows are then found by a semi-join, which adaptive execution splits
        for a hot key.
        """
        log = (self.log() if log is None else log).withColumn("_rank", self._rank())
        best = log.groupBy(self.key).agg(F.max("_rank").alias("_rank"))
        same_key = log[self.key].eqNullSafe(best[self.key])
        return (log.join(best, same_key & (log["_rank"] == best["_rank"]), "left_semi")
                .select(*[f.name for f in self.schema.fields]))
