"""Write rows out as named CSV objects in a landing zone.

Used to lay derived data down as raw files (the object-store layout the
ingestion reads: ``<root>/raw/customers/*.csv``, ``<root>/raw/orders/*.csv``).
The rows are written by Spark (one task per file after a hash
repartition on the file name, lines in their given order), then each
part file is renamed to its object name.  Renames are metadata calls on
the Hadoop file system, one per file; no row passes through the driver.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def csv_field(c) -> Column:
    """RFC-4180 field: quote when the text holds a comma, quote or newline."""
    c = F.col(c) if isinstance(c, str) else c
    needs = c.rlike('[,"\\r\\n]')
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(c.isNull(), F.lit("")).when(needs, quoted).otherwise(c)


def csv_line(cols) -> Column:
    return F.concat_ws(",", *[csv_field(c) for c in cols])


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def write_named_files(lines: DataFrame, root: str, num_partitions: int | None = None) -> list[str]:
    """Write ``lines(file_name, seq, line)`` as files ``<root>/<file_name>``.

    Returns the object names written.  ``seq`` orders lines inside a file.
    """
    spark = lines.sparkSession
    root = root.rstrip("/")
    staging = f"{root}/_staging"
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartition(n, "file_name")
     .sortWithinPartitions("file_name", "seq")
     .select("file_name", "line")
     .write.mode("overwrite").partitionBy("file_name").text(staging))
    fs, jvm = _hadoop_fs(spark, staging)
    Path = jvm.org.apache.hadoop.fs.Path
    names = []
    for d in fs.listStatus(Path(staging)):
        dname = d.getPath().getName()
        if not d.isDirectory() or not dname.startswith("file_name="):
            continue
        name = unquote(dname[len("file_name="):])
        parts = [s.getPath() for s in fs.listStatus(d.getPath())
                 if s.getPath().getName().startswith("part-")]
        target = Path(f"{root}/{name}")
        fs.mkdirs(target.getParent())
        # one hash partition per file name: exactly one part file
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file for {name}, found {len(parts)}")
        fs.rename(parts[0], target)
        names.append(name)
    return sorted(names)
