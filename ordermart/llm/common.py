"""Helpers shared by the operators: clash-free columns, scratch tables, Arrow loops."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Characters and texts handled at once inside a task; they bound the numpy work arrays.
CHUNK_CHARS, CHUNK_TEXTS = 1 << 20, 1024

#: CRC remainders that hold rows out of training, as the contracts fix them.
HELD_OUT_MOD4 = 2
HELD_OUT_MOD5 = 0


#: Spark deletes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: glibc's way to give freed pages back; other C libraries have none.
_malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def held_out_mod4(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4 is 2; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT_MOD4, F.lit(False))


def held_out_mod5(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 is 0; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == HELD_OUT_MOD5, F.lit(False))


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers once per Spark context (as --py-files would)."""
    import os
    import shutil
    import tempfile

    context = spark.sparkContext
    if not getattr(context, "_ordermart_shipped", False):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="ordermart-")  # the driver's file server reads it as long as the context runs
        shutil.copytree(top, f"{folder}/z/ordermart", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/ordermart", "zip", f"{folder}/z"))
        context._ordermart_shipped = True


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write once to the shared folder of spark.checkpoint.dir and read back.

    Parquet in the shared folder cuts the lineage like ``checkpoint()`` but
    is columnar and compressed, and survives the loss of any executor.  The
    write's own shuffle files are deleted as it ends: nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", tag)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_scratch = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files behind a frame made by ``materialise``."""
    path = getattr(df, "_llm_scratch", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def give_back() -> None:
    """Return the memory that a batch has freed to the system.

    Spark keeps a Python worker for later tasks of any stage, and the
    allocators would keep the work arrays of its largest batch as long.
    """
    pa.default_memory_pool().release_unused()
    if _malloc_trim is not None:
        _malloc_trim(0)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """(start, end) ranges of at most ``limit`` characters and CHUNK_TEXTS texts, one text at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and (size + len(t) > limit or i - start >= CHUNK_TEXTS):
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def map_texts(df: DataFrame, text: str, fn: Callable[[list[str], pa.RecordBatch], dict | None],
              schema: str, keep: list[str]) -> DataFrame:
    """Run ``fn`` over chunks of texts inside Arrow batches.

    ``fn(texts, rows)`` gets the texts (null: empty) and the Arrow rows with
    the ``keep`` columns, and returns the output columns by name as numpy
    arrays, lists or Arrow arrays (None: no row).  ``schema`` is DDL in the
    order of the output columns.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship_package(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    cols = [*dict.fromkeys([*keep, text])]

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(cols.index(text)).to_pylist()]
            for a, b in in_chunks(texts):
                out = fn(texts[a:b], batch.slice(a, b - a))
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [x if isinstance(x := out[f.name], pa.Array) else pa.array(x, type=f.type) for f in arrow],
                        schema=arrow)
            batch = texts = out = None
            give_back()

    return df.select(*cols).mapInArrow(run, schema)


def flat_lists(values, counts, kind: pa.DataType) -> pa.ListArray:
    """A list column from its concatenated values and the length of each list."""
    import numpy as np
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(values, type=kind))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from ..sources.tables import read_table
    return read_table(spark, sf_dir, name)
