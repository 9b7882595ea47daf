"""File layer: listing (S1-S3), CSV scan by header name (S4), per-file
contract (S5) and physical record numbers (S6).  The raw zone is only
read, never changed (S7).

Scan design, for any mix of headers:

* First pass over the text (``spark.read.text``): one row per split
  (``_metadata.file_path``, ``_metadata.file_block_start``) with its record
  count, its first line and whether a line leaves a quote open.  The rows
  are written once to the shared folder; headers, record numbers and the
  file contract all come from them.  The first line of a file is its
  header; a blank one is a header without names, as for ``csv.DictReader``.
* Second pass: a plain split where a line has no quote, else one
  ``regexp_extract_all`` with possessive loops (no recursion, any field
  length) and, as in Python's csv module, text after a closing quote kept.
  Whitespace-only records stay, later empty lines go.
* Record number = records in earlier splits + place in the split, the
  latter from ``monotonically_increasing_id``: the header is 1, data starts
  at 2.  No window and no sort runs over data rows.  The second pass checks
  each record against its split: if the file was cut otherwise in between,
  the job raises instead of losing or renumbering rows.
* Files in which a quoted field holds line feeds are read split by split
  too, after a prefix scan of the quote states of their splits
  (``sources.quoted``).
* Each required column is taken from the header position of its name
  (case-sensitive, the last one wins for a repeated name).

The split summary has fixed-width rows (40 bytes: file hash, block, first
id, count, offset).  It is broadcast if its counted rows are within
``BROADCAST_BYTES`` (800,000 splits take 32 MB), else joined by a normal
(AQE-managed) join.  Paths are decoded once, so names may hold any
character but a leading ``_`` or ``.``, which Spark's readers hide.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import written
from . import quoted

# Largest summary (one row per split, or one header per file) that is broadcast.
BROADCAST_BYTES = 256 << 20
SPLIT_ROW_BYTES, HEADER_ROW_BYTES = 40, 500


def _within(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast ``df`` if its counted rows fit; AQE decides otherwise."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def qualified(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def _norm_uri(p: str) -> str:
    """The file index writes local files as file:///x, scans as file:/x."""
    return "file:/" + p[len("file:///"):] if p.startswith("file:///") else p


LISTING_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()), T.StructField("modification_time", T.TimestampType())])


@dataclass
class Landing:
    """A raw zone: object keys are paths relative to ``root``."""
    spark: SparkSession
    root: str

    def __post_init__(self):
        self.root = qualified(self.spark, self.root)

    def key(self, path: Column) -> Column:
        return F.substr(path, F.lit(len(self.root) + 2))

    def exists(self, key: str) -> bool:
        fs, p = _hadoop(self.spark, f"{self.root}/{key}")
        return bool(fs.exists(p))

    def list_csv(self, prefix: str) -> DataFrame:
        """Recursive listing of ``*.csv`` (any case) under a prefix.

        The object list comes from Spark's file index (driver-side file
        metadata, as for any file source); sizes and times come from a
        ``binaryFile`` scan whose plan reads no content.  Zero-length
        objects produce no scan row, so they are kept by a left join with
        length 0.  A missing prefix is an empty listing.
        """
        base = f"{self.root}/{prefix.strip('/')}"
        if not self.exists(prefix.strip("/")):
            return self.spark.createDataFrame([], LISTING_SCHEMA)
        src = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
        names = [unquote(_norm_uri(p)) for p in src.inputFiles() if p.lower().endswith(".csv")]
        if not names:
            return self.spark.createDataFrame([], LISTING_SCHEMA)
        objects = self.spark.createDataFrame([(p,) for p in names], "path string")
        meta = src.select("path", "length", F.col("modificationTime").alias("modification_time"))
        ls = objects.join(meta, "path", "left")
        return ls.select(self.key(F.col("path")).alias("file_name"), "path",
                         F.coalesce("length", F.lit(0)).cast("long").alias("length"),
                         "modification_time")

    def listing(self, prefixes: list[str]) -> DataFrame:
        out = None
        for rank, prefix in enumerate(prefixes):
            df = self.list_csv(prefix).withColumn("prefix_rank", F.lit(rank))
            out = df if out is None else out.unionByName(df)
        return out


class MissingInput(FileNotFoundError):
    pass


def check_required(landing: Landing, keys: list[str]) -> None:
    """Every required object must exist; the first missing one is reported."""
    for key in keys:
        if not landing.exists(key):
            raise MissingInput(f"Required input file not found: {key}")


def check_any_files(listing: DataFrame) -> None:
    """S3: no CSV under any prefix is an error; one empty prefix is fine."""
    if listing.isEmpty():
        # fixed value: the source project's message, less a word
        raise MissingInput("No CSV files found under the configured customer/order prefixes.")


# One CSV field: a quoted part (doubled quotes inside) with what follows its
# closing quote, or a run of non-commas, at the line start or after a comma.
CSV_FIELD_RE = '(?<=^|,)("(?:[^"]++|"")*+"[^,]*+|[^,]*+)'
QUOTED_RE = '(?s)^"((?:[^"]++|"")*+)"(.*+)\\z'


def csv_fields(line) -> Column:
    """Split one CSV record without line feeds into its fields, as Python's csv module does."""
    line = F.col(line) if isinstance(line, str) else line
    raw = F.regexp_extract_all(line, F.lit(CSV_FIELD_RE), 1)
    quoted = F.transform(raw, lambda x: F.when(
        x.startswith('"') & x.rlike(QUOTED_RE),
        F.concat(F.replace(F.regexp_extract(x, QUOTED_RE, 1), F.lit('""'), F.lit('"')), F.regexp_extract(x, QUOTED_RE, 2)))
        .otherwise(x))
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ","))


@dataclass
class CsvScan:
    records: DataFrame   # path, record_number, fields, header
    splits: DataFrame    # path, n (records) per split
    headers: DataFrame   # path, header


def _reader_path(path: str) -> str:
    """A path as the reader takes it: pattern characters are escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, block, value) of every line; paths decoded."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    path = F.when(path.startswith("file:///"), F.concat(F.lit("file:/"), F.substr(path, F.lit(9)))).otherwise(path)
    return spark.read.text([_reader_path(p) for p in paths]).select(
        path.alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def _quoted_records(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Records (path, record_number, fields) and splits (path, n) of files with line feeds in quoted fields."""
    lines = _lines(spark, paths)
    starts = written(quoted.split_starts(quoted.split_states(lines)), "quoted-splits")
    rows = starts.count()
    placed = lines.join(_within(starts.select("path", "block", "inside", "offset"), rows, 200), ["path", "block"])
    if rows * 200 > BROADCAST_BYTES:    # a shuffled join loses the order of the lines: sort each split again
        placed = (lines.withColumn("pos", F.monotonically_increasing_id())
                  .join(starts.select("path", "block", "inside", "offset"), ["path", "block"])
                  .repartition("path", "block").sortWithinPartitions("path", "block", "pos"))
    parts = written(quoted.split_records(placed), "quoted-records")
    return quoted.join_pieces(parts), starts.select("path", "n")


def scan_records(spark: SparkSession, paths: list[str]) -> CsvScan:
    """S4 + S6: every CSV record with (path, record_number, fields, header)."""
    by_path = Window.partitionBy("path").orderBy("block")
    before = by_path.rowsBetween(Window.unboundedPreceding, -1)
    value = F.col("value")
    # one row per split, written once: what every later pass is checked against
    splits = (_lines(spark, paths).withColumn("at", F.monotonically_increasing_id())
              .groupBy("path", "block")
              .agg(F.min("at").alias("at"), F.count_if(value != "").alias("lines"), F.min_by("value", "at").alias("first_line"),
                   F.collect_set(F.when(quoted.opens(value), True)).alias("opens")))     # at most one element
    first = F.row_number().over(by_path) == 1
    in_task = Window.partitionBy(F.shiftright("at", 33)).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    splits = (splits.withColumn("file", F.xxhash64("path")).withColumn("first", first)
              .withColumn("open", F.size("opens") > 0)
              # the id of the split's first record among the records of its task
              .withColumn("first_rid", F.shiftleft(F.shiftright("at", 33), 33) + F.coalesce(F.sum("lines").over(in_task), F.lit(0)))
              # a leading blank line is the header
              .withColumn("blank", F.col("first") & (F.col("first_line") == ""))
              .withColumn("n", F.col("lines") + F.col("blank").cast("int"))
              .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)) + F.col("blank").cast("int"))
              .withColumn("first_line", F.when(F.col("first"), F.col("first_line")))
              .drop("at", "opens"))
    splits = written(splits, "splits")
    facts = splits.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("path").alias("paths"), F.countDistinct("file").alias("files"),
                       F.collect_set(F.when(F.col("open"), F.col("path"))).alias("opened")).first()
    if facts.paths != facts.files:
        raise RuntimeError("two file names have the same 64-bit hash; rename one of them")
    opened = facts.opened       # a part of ``paths``

    def without(df: DataFrame, names: list[str]) -> DataFrame:
        return df.join(F.broadcast(spark.createDataFrame([(p,) for p in names], "path string")), "path", "left_anti") if names else df

    lines = (_lines(spark, paths).where(value != "")
             .withColumn("file", F.xxhash64("path")).withColumn("rid", F.monotonically_increasing_id()))
    keys = _within(splits.select("file", "block", "first_rid", "lines", "offset"), facts.n, SPLIT_ROW_BYTES)
    index = F.col("rid") - F.col("first_rid")
    # a left join that raises: a split cut otherwise than in the first pass must not lose rows
    number = F.when(F.col("first_rid").isNotNull() & (index >= 0) & (index < F.col("lines")), F.col("offset") + index + 1).otherwise(
        F.raise_error(F.lit("a file was cut into other splits than when it was numbered; run the scan again")).cast("long"))
    numbered = without(lines, opened).join(keys, ["file", "block"], "left").select("path", number.alias("record_number"), "value")
    records = numbered.select("path", "record_number", csv_fields("value").alias("fields"))
    counts = splits.select("path", "n")
    heads = splits.where("first").select("path", F.when(F.col("blank"), F.array().cast("array<string>"))
                                         .otherwise(csv_fields("first_line")).alias("header"))
    if opened:
        streamed, quoted_counts = _quoted_records(spark, opened)
        blank = splits.where("blank").select("path")
        streamed = (streamed.join(_within(blank.withColumn("shift", F.lit(1)), facts.paths, HEADER_ROW_BYTES), "path", "left")
                    .select("path", (F.col("record_number") + F.coalesce("shift", F.lit(0))).alias("record_number"), "fields"))
        # a blank header line is one more record
        counts = (without(counts, opened).unionByName(quoted_counts)
                  .unionByName(splits.where(F.col("blank") & F.col("path").isin(opened)).select("path", F.lit(1).cast("long").alias("n"))))
        heads = (without(heads, opened)
                 .unionByName(streamed.where("record_number = 1").select("path", F.col("fields").alias("header")))
                 .unionByName(heads.where(F.col("path").isin(opened) & (F.size("header") == 0))))
        records = records.unionByName(streamed)
    # left join: predicates on the parsed fields must not be pushed into it
    records = records.join(_within(heads, facts.paths, HEADER_ROW_BYTES), "path", "left").select(
        "path", "record_number", "fields", "header")
    return CsvScan(records=records, splits=counts, headers=heads)


def field_by_name(name: str) -> Column:
    """Value of header column ``name`` (last occurrence), null when absent or short."""
    rpos = F.array_position(F.reverse("header"), F.lit(name))
    idx = (F.size("header") - rpos).cast("int")
    return F.when(rpos > 0, F.get("fields", idx))


def project_by_name(scan: CsvScan | DataFrame, columns: list[str]) -> DataFrame:
    """Data records (number >= 2) with the required columns by header name."""
    records = scan.records if isinstance(scan, CsvScan) else scan
    return (records.where(F.col("record_number") >= 2)
            .select("path", F.col("record_number").alias("row_number"),
                    *[field_by_name(c).alias(c) for c in columns]))


def header_names(header: Column) -> Column:
    return F.filter(header, lambda x: x.isNotNull())


def python_list_repr(arr: Column) -> Column:
    """``str(sorted_list)`` of plain strings: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                    F.lit("]"))


def file_contract(files: DataFrame, scan: CsvScan, columns: list[str]) -> DataFrame:
    """S5 per file: data rows exist, then required headers present.

    Works on the split summary and the headers (one row per split / file),
    never on the records.  ``files`` is the listing (file_name, path, ...);
    empty objects have no record and come in through the left join.
    Returns file_name, path, data_rows, missing_columns, contract_error.
    """
    counts = scan.splits.groupBy("path").agg((F.sum("n") - 1).alias("data_rows"))
    stats = counts.join(scan.headers, "path", "left")
    required = F.array(*[F.lit(c) for c in columns])
    j = files.join(stats, "path", "left")
    missing = F.array_sort(F.array_except(required, F.coalesce(header_names(F.col("header")),
                                                                F.array().cast("array<string>"))))
    data_rows = F.coalesce(F.col("data_rows"), F.lit(0)).cast("bigint")
    err = (F.when(data_rows == 0, F.concat(F.col("file_name"), F.lit(" contains no data rows.")))
           .when(F.size(missing) > 0,
                 F.concat(F.col("file_name"), F.lit(" is missing required columns: "),
                          python_list_repr(missing))))
    return j.select("file_name", "path", data_rows.alias("data_rows"),
                    missing.alias("missing_columns"), err.alias("contract_error"))
