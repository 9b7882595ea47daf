"""Incremental file ingestion with a per-file tracker.

One run, set-based:

1. list ``*.csv`` under the customer and order prefixes (S2); nothing at
   all is an error (S3);
2. order the files: customers first, then orders, each by name; join the
   tracker's latest status: SUCCESS -> SKIPPED (J3, I7), anything else is
   (re)processed (I6);
3. take the files to process in waves, in their order, of at most
   ``wave_bytes`` each; one scan reads both kinds.  The contract of a
   wave's files (headers and counts) is known from the scan's summary
   before any row is parsed;
4. stop-at-first-failure (I5): rows are parsed only of files before the
   first contract failure, written once to the shared folder, and judged
   (row rules, first error: D14-D16, D19).  ``cut`` = smallest ordinal of
   a FAILED file: files before it are published, the cut file is FAILED,
   later files are left untouched, and later waves are never read.
   ``on_error="continue"`` reads all waves and publishes every good file;
5. write tracker PROCESSING events, then the rows of the good files into
   their change logs, then the SUCCESS / FAILED events (K4, K5).  The
   folder of these last events commits the batch: readers leave out
   batches without it, so a crash between the writes leaves nothing
   half-visible and a retry is safe.

The plan (one row per file) is written before anything else, so the run
log does not change when the tracker does.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.amounts import to_price, total_incremental
from ..functions.clean import strip_all
from ..functions.parse import parse_date_strict, parse_decimal, parse_int
from ..operators.file_rules import file_verdicts
from ..operators.keys import add_row_number
from ..operators.upsert import ChangeLog, folder_values
from ..schemas import CUSTOMER_COLUMNS, INC_CUSTOMERS, INC_ORDERS, ORDER_COLUMNS, TRACKER
from ..session import drop_path, scratch_path, written
from ..sources.files import (Landing, check_any_files, file_contract, project_by_name,
                             scan_records)

KIND_COLUMNS = {"customers": CUSTOMER_COLUMNS, "orders": ORDER_COLUMNS}
ALL_COLUMNS = list(dict.fromkeys(CUSTOMER_COLUMNS + ORDER_COLUMNS))
ROW_SCHEMA = ("row_number long, file_name string, ordinal long, kind string, "
              + ", ".join(f"{c} string" for c in ALL_COLUMNS))
SUCCESS, FAILED, SKIPPED, PROCESSING, UNTOUCHED = "SUCCESS", "FAILED", "SKIPPED", "PROCESSING", "UNTOUCHED"
# Fixed value: the source project's limit of a stored error message.
ERROR_LIMIT = 1000
# Sequence number of a batch's last tracker events, which commit it.
FINAL = 2
SNAPSHOT_BUCKET_BYTES = 256 << 20


class IngestionError(ValueError):
    pass


def _with(schema: T.StructType, *extra: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(n, t) for n, t in extra])


class IngestionStore:
    """The three unique-key tables of the incremental path."""

    def __init__(self, spark: SparkSession, root: str):
        root = root.rstrip("/")
        self.spark = spark
        self.root = root
        self.customers = ChangeLog(spark, f"{root}/inc_customers", "customer_id",
                                   _with(INC_CUSTOMERS, ("file_name", T.StringType())),
                                   ("file_ordinal", "row_number"))
        self.orders = ChangeLog(spark, f"{root}/inc_orders", "order_id",
                                _with(INC_ORDERS, ("file_name", T.StringType())),
                                ("file_ordinal", "row_number"))
        self.tracker = ChangeLog(spark, f"{root}/ingestion_tracker", "file_name", TRACKER,
                                 ("event_seq",))

    def table(self, kind: str) -> ChangeLog:
        return {"customers": self.customers, "orders": self.orders, "tracker": self.tracker}[kind]

    def tracker_latest(self) -> DataFrame:
        return self.visible("tracker")

    def next_batch(self) -> int:
        """A run writes its tracker events before its data, so the tracker's
        folders always hold the newest batch id."""
        return self.tracker.max_batch() + 1

    def open_batches(self, kind: str) -> list[int]:
        """Batches with data whose final events were not written: crashed or still running.

        The folder of a batch's final events, moved into place last, commits
        the batch; folder names tell, no file is opened.
        """
        events = self.tracker
        return [b for b in self.table(kind).batches()
                if FINAL not in folder_values(self.spark, f"{events.path}/batch_id={b}", "event_seq")]

    def vacuum(self) -> list[int]:
        """Delete the data of open batches (no run may be under way); returns their ids."""
        gone = set()
        for kind in ("customers", "orders"):
            for b in self.open_batches(kind):
                self.table(kind).drop_batch(b)
                gone.add(b)
        return sorted(gone)

    def _columns(self, kind: str) -> list[str]:
        return [f.name for f in {"customers": INC_CUSTOMERS, "orders": INC_ORDERS, "tracker": TRACKER}[kind].fields]

    def _snapshot_root(self, kind: str) -> str:
        return f"{self.root}/snapshots/{kind}"

    def _snapshot(self, kind: str) -> tuple[int, int] | None:
        """(batch id, buckets) of the newest complete snapshot (directory listing only)."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self._snapshot_root(kind))
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return None
        done = [st.getPath().getName() for st in fs.listStatus(p)
                if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))]
        found = [tuple(int(x.split("=", 1)[1]) for x in n.split(",")) for n in done if n.startswith("batch=")]
        return max(found) if found else None

    def latest_snapshot(self, kind: str) -> int | None:
        """Batch id of the newest complete snapshot."""
        found = self._snapshot(kind)
        return found[0] if found else None

    def _bucketed(self, kind: str, batch: int, buckets: int) -> tuple[str, str]:
        """Folder of a snapshot and the table name it has in the session's catalog."""
        path = f"{self._snapshot_root(kind)}/batch={batch},buckets={buckets}"
        return path, "snapshot_" + hashlib.sha1(path.encode()).hexdigest()

    def snapshot_rows(self, kind: str) -> DataFrame | None:
        """The newest snapshot as a table bucketed and sorted by key."""
        found = self._snapshot(kind)
        if found is None:
            return None
        path, name = self._bucketed(kind, *found)
        if not self.spark.catalog.tableExists(name):
            key = self.table(kind).key
            cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.table(kind).schema.fields if f.name in self._columns(kind))
            self.spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                           f"INTO {found[1]} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def visible(self, kind: str) -> DataFrame:
        """K4 read side: rows of committed batches (which hold only files that succeeded), latest per key.

        With a snapshot at batch B, only log partitions after B are read (a
        partition filter) and reduced to a row per key; the snapshot gives
        the keys that they do not have, by a join on its buckets: its rows
        are neither shuffled nor ranked again.
        """
        table, snap = self.table(kind), self.latest_snapshot(kind)
        rows = table.log()
        if snap is not None:
            rows = rows.where(F.col("batch_id") > snap)
        if kind != "tracker" and (crashed := [b for b in self.open_batches(kind) if snap is None or b > snap]):
            rows = rows.where(~F.col("batch_id").isin(crashed))
        newer = table.latest(rows).select(*self._columns(kind))
        if snap is None:
            return newer
        # keys are never null: a row without one fails its file
        base = self.snapshot_rows(kind).select(*self._columns(kind))
        return base.join(newer.select(table.key), table.key, "left_anti").select(*self._columns(kind)).unionByName(newer)

    def compact(self, kind: str) -> int:
        """Write the current latest view ("customers", "orders" or "tracker") as a snapshot at the newest batch.

        Later reads start from the snapshot, so the cost of the latest view
        stays proportional to the table plus the batches since, not to
        the whole history.  The snapshot is bucketed and sorted by key, with
        buckets of about SNAPSHOT_BUCKET_BYTES.  The log itself is left in place.
        """
        batch = max(self.tracker.max_batch(), self.table(kind).max_batch())
        buckets = max(1, -(-self.table(kind).bytes() // SNAPSHOT_BUCKET_BYTES))
        path, name = self._bucketed(kind, batch, buckets)
        key = self.table(kind).key
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        # the buckets' own hash: one file a bucket
        (self.visible(kind).repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", path)
         .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
        return batch

    def record_events(self, events: DataFrame, batch_id: int, event_seq: int) -> None:
        """K5: tracker upsert; error text cut to 1000 characters, null when none."""
        ev = events.select(
            "file_name", "status", F.current_timestamp().alias("processed_at"),
            F.coalesce(F.col("record_count"), F.lit(0)).cast("long").alias("record_count"),
            F.when(F.col("error_message").isNotNull() & (F.col("error_message") != ""),
                   F.substring("error_message", 1, ERROR_LIMIT)).alias("error_message"),
            F.lit(event_seq).cast("long").alias("event_seq"))
        (ev.select(*[F.col(f.name) for f in TRACKER.fields], "event_seq",
                   F.lit(batch_id).cast("long").alias("batch_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "event_seq").parquet(self.tracker.path))


@dataclass
class IncrementalConfig:
    customers_prefix: str = "raw/customers"
    orders_prefix: str = "raw/orders"
    on_error: str = "stop"          # "stop" (source behaviour) or "continue"
    wave_bytes: int = 1 << 40       # files read at once; in stop mode no wave after a failure is read


@dataclass
class RunResult:
    run_log: DataFrame              # file_name, kind, ordinal, status, record_count, error_message
    plan: DataFrame                 # every listed file, incl. UNTOUCHED
    batch_id: int | None = None
    error: str | None = None
    extra: dict = field(default_factory=dict)


def listed(landing: Landing, cfg: IncrementalConfig) -> DataFrame:
    """file_name, path, length and kind of every CSV object under the two prefixes."""
    kind = F.when(F.col("prefix_rank") == 0, "customers").otherwise("orders")
    return landing.listing([cfg.customers_prefix, cfg.orders_prefix]).select("file_name", "path", "length", kind.alias("kind"))


def list_files(landing: Landing, cfg: IncrementalConfig) -> DataFrame:
    """Listing with kind and processing ordinal (customers first, by name).

    The ordinal is numbered like the surrogate key (range partitions +
    per-partition counts), so even a very long listing is not funnelled
    through one task.
    """
    ls = listed(landing, cfg).withColumn("prefix_rank", F.when(F.col("kind") == "customers", 0).otherwise(1))
    return add_row_number(ls, ["prefix_rank", "file_name"], "ordinal").drop("prefix_rank")


def plan_files(listing: DataFrame, tracker_latest: DataFrame) -> DataFrame:
    """Join the tracker; SUCCESS files are skipped, the rest processed."""
    prev = tracker_latest.select("file_name", F.col("status").alias("prev_status"))
    return (listing.join(prev, "file_name", "left")
            .withColumn("action", F.when(F.col("prev_status") == SUCCESS, "SKIP").otherwise("PROCESS")))


def scan_files(spark: SparkSession, files: DataFrame):
    """Rows by name (file_name, kind, ordinal, row_number, columns of both kinds) and the contract of each file.

    ``files`` (file_name, path, kind, ordinal) is one small row per file;
    the reader needs their paths, as any Spark file source does.
    """
    scan = scan_records(spark, [r["path"] for r in files.select("path").collect()])
    names = files.select("path", "file_name", "kind", "ordinal")
    rows = project_by_name(scan, ALL_COLUMNS).join(names, "path", "left").drop("path")
    contract = None
    for kind, columns in KIND_COLUMNS.items():
        c = file_contract(files.where(F.col("kind") == kind).select("file_name", "path"), scan, columns)
        contract = c if contract is None else contract.unionByName(c)
    return rows, contract


def _waves(files: list, limit: int):
    """Files in their order, cut where the next would exceed ``limit`` bytes (one file at least)."""
    wave, size = [], 0
    for f in files:
        if wave and size + f.length > limit:
            yield wave
            wave, size = [], 0
        wave.append(f)
        size += f.length
    if wave:
        yield wave


def _judge(spark: SparkSession, files: DataFrame, stop: bool):
    """Verdicts of one wave, and the folder with the parsed rows of the files that may be published."""
    rows, contract = scan_files(spark, files)
    contract = written(contract, "contract")
    able = files.join(contract.where(F.col("contract_error").isNull()).select("file_name"), "file_name", "left_semi")
    if stop:        # no row after the first contract failure is parsed
        bad = files.join(contract.where(F.col("contract_error").isNotNull()), "file_name", "left_semi").agg(F.min("ordinal")).first()[0]
        if bad is not None:
            able = able.where(F.col("ordinal") < bad)
            before, after = files.agg(*[F.coalesce(F.sum(F.when(c, F.col("length"))), F.lit(0)) for c in
                                        (F.col("ordinal") < bad, F.col("ordinal") >= bad)]).first()
            if before == 0:
                return contract.select("file_name", "data_rows", F.when(F.col("contract_error").isNull(), "OK").otherwise(FAILED)
                                       .alias("status"), F.col("contract_error").alias("error_message")), None
            if after > before:      # to number the files before it anew reads less than what follows it
                rows, _ = scan_files(spark, able)
    rows = rows.join(able.select("file_name"), "file_name", "left_semi")
    path = scratch_path(spark, "rows")
    rows.write.partitionBy("kind").parquet(path)
    parsed = spark.read.schema(ROW_SCHEMA).parquet(path)
    # the rows lie in a folder per kind: each kind is judged by its own rules, no row is read twice
    kind_of = files.select("file_name", "kind")
    return reduce(DataFrame.unionByName, [
        file_verdicts(contract.join(kind_of.where(F.col("kind") == k), "file_name", "left_semi"), parsed.where(F.col("kind") == k), k)
        for k in KIND_COLUMNS]), path


def decide(spark: SparkSession, plan: DataFrame, cfg: IncrementalConfig):
    """Status of every file after the stop-at-first-failure cut.

    Returns the files, the folders with parsed rows and the cut's ordinal.
    """
    # one row per file, used several times: pin it (and the tracker state it was planned against)
    plan = written(plan, "plan")
    stop = cfg.on_error == "stop"
    columns = ["file_name", "path", "kind", "ordinal", "length"]
    todo = plan.where(F.col("action") == "PROCESS").select(*columns).orderBy("ordinal").collect()
    schema = plan.select(*columns).schema
    verdicts = spark.createDataFrame([], "file_name string, data_rows long, status string, error_message string")
    folders = []
    for wave in _waves(todo, cfg.wave_bytes):
        v, path = _judge(spark, spark.createDataFrame(wave, schema), stop)
        v = written(v, "verdicts")
        verdicts = verdicts.unionByName(v)
        folders += [path] if path else []
        if stop and not v.where(F.col("status") == FAILED).isEmpty():
            break
    d = plan.join(verdicts.withColumnRenamed("status", "verdict"), "file_name", "left")
    status = (F.when(F.col("action") == "SKIP", SKIPPED)
              .when(F.col("verdict") == "OK", SUCCESS)
              .when(F.col("verdict").isNotNull(), FAILED).otherwise(UNTOUCHED))
    d = written(d.withColumn("status", status), "decided")
    cut = None
    if stop:
        cut = d.where(F.col("status") == FAILED).agg(F.min("ordinal")).first()[0]
    if cut is not None:
        d = d.withColumn("status", F.when(F.col("ordinal") > cut, UNTOUCHED).otherwise(F.col("status")))
    d = d.select("file_name", "path", "kind", "ordinal", "prev_status", "status",
                 F.when(F.col("status") == SUCCESS, F.col("data_rows")).otherwise(F.lit(0))
                 .cast("long").alias("record_count"),
                 F.when(F.col("status") == FAILED, F.col("error_message")).alias("error_message"))
    return d, folders, cut


def publish_rows(kind: str, rows: DataFrame) -> DataFrame:
    """I2 / I3 value shaping: stripped text, lower e-mail, typed numbers."""
    if kind == "customers":
        return rows.select(
            strip_all("customer_id").alias("customer_id"), strip_all("customer_name").alias("customer_name"),
            strip_all("city").alias("city"), F.lower(strip_all("email")).alias("email"),
            parse_date_strict("created_date").alias("created_date"),
            "file_name", "file_ordinal", "row_number")
    q, p = parse_int("quantity"), parse_decimal("unit_price")
    return rows.select(
        strip_all("order_id").alias("order_id"), strip_all("customer_id").alias("customer_id"),
        parse_date_strict("order_date").alias("order_date"), q.alias("quantity"),
        to_price(p).alias("unit_price"), total_incremental(q, p).alias("total_amount"),
        "file_name", "file_ordinal", "row_number")


def listing_from_paths(landing: Landing, files: DataFrame, cfg: IncrementalConfig) -> DataFrame:
    """Listing (file_name, path, length, kind, ordinal) for given file paths.

    Used by the stream: a micro-batch brings new paths; only ``*.csv``
    under the two prefixes count, ordered customers first, then by name.
    """
    name = landing.key(F.col("path"))
    cp, op = cfg.customers_prefix.strip("/") + "/", cfg.orders_prefix.strip("/") + "/"
    kind = F.when(name.startswith(cp), "customers").when(name.startswith(op), "orders")
    ls = (files.select(name.alias("file_name"), "path", "length", kind.alias("kind"))
          .where(F.col("kind").isNotNull() & F.lower("file_name").endswith(".csv"))
          .withColumn("prefix_rank", F.when(F.col("kind") == "customers", 0).otherwise(1)))
    return add_row_number(ls, ["prefix_rank", "file_name"], "ordinal").drop("prefix_rank")


def run_incremental(spark: SparkSession, landing: Landing, store: IngestionStore,
                    cfg: IncrementalConfig | None = None, raise_on_error: bool = True,
                    batch_id: int | None = None, listing: DataFrame | None = None) -> RunResult:
    cfg = cfg or IncrementalConfig()
    listing = list_files(landing, cfg) if listing is None else listing
    check_any_files(listing)
    plan = plan_files(listing, store.tracker_latest())
    decided, folders, cut = decide(spark, plan, cfg)
    batch = batch_id if batch_id is not None else store.next_batch()
    touched = decided.where(F.col("status").isin(SUCCESS, FAILED))
    store.record_events(touched.select("file_name", F.lit(PROCESSING).alias("status"),
                                       F.lit(0).alias("record_count"),
                                       F.lit(None).cast("string").alias("error_message")), batch, 1)
    # one row per good file; AQE broadcasts it if its measured size allows
    good = decided.where(F.col("status") == SUCCESS).select("file_name", F.col("ordinal").alias("file_ordinal"))
    if folders:
        rows = reduce(DataFrame.unionByName, [spark.read.schema(ROW_SCHEMA).parquet(f) for f in folders])
        for kind in KIND_COLUMNS:
            pub = publish_rows(kind, rows.where(F.col("kind") == kind).drop("kind", "ordinal").join(good, "file_name", "inner"))
            store.table(kind).append(pub, batch)
    store.record_events(touched.select("file_name", "status", "record_count", "error_message"), batch, FINAL)
    for folder in folders:
        drop_path(spark, folder)
    run_log = decided.where(F.col("status") != UNTOUCHED).select(
        "file_name", "kind", "ordinal", "status", "record_count", "error_message")
    error = None
    if cut is not None:
        error = decided.where(F.col("ordinal") == cut).select("error_message").first()[0]
    res = RunResult(run_log=run_log, plan=decided, batch_id=batch, error=error)
    if error and raise_on_error:
        raise IngestionError(error)
    return res


def run_summary(run_log: DataFrame) -> DataFrame:
    """A10: newly processed and skipped file counts."""
    return run_log.agg(F.count_if(F.col("status") == SUCCESS).alias("processed_files"),
                       F.count_if(F.col("status") == SKIPPED).alias("skipped_files"),
                       F.count_if(F.col("status") == FAILED).alias("failed_files"))
