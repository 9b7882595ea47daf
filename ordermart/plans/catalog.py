"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the given tables (through ``sources.bindings``) so its
work grows with them; none runs on made-up input alone.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions import amounts, clean, parse, predicates
from ..operators import quality
from ..schemas import TABLES
from ..session import scratch_path
from ..sources.bindings import raw_customers, raw_orders, tamper_totals
from ..sources.tables import read_table
from . import model, reports
from .warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]


def _model(spark: SparkSession, sf_dir: str, messy: bool = False):
    return model.model_from_raw(raw_customers(spark, sf_dir, messy),
                                raw_orders(spark, sf_dir, messy))


def _fact(spark, sf_dir, messy=False) -> DataFrame:
    return model.build_fact_order(_model(spark, sf_dir, messy)[3])


def q_monthly_sales(spark, sf_dir):
    return reports.monthly_sales(_fact(spark, sf_dir))


def q_sales_by_city(spark, sf_dir):
    _, _, customers, orders = _model(spark, sf_dir)
    return reports.sales_by_city(model.build_fact_order(orders), customers)


def q_sales_by_customer(spark, sf_dir):
    _, _, customers, orders = _model(spark, sf_dir)
    return reports.sales_by_customer(model.build_fact_order(orders), customers)


# ------------------------------------------------------------ cleaning

def _messy_transformed_customers(spark, sf_dir):
    return model.transform_customers(model.stage_customers(raw_customers(spark, sf_dir, True)))


def _messy_transformed_orders(spark, sf_dir, keep_raw=False):
    return model.transform_orders(model.stage_orders(raw_orders(spark, sf_dir, True), keep_raw))


def q_clean_customers(spark, sf_dir):
    """P1-P4, P13."""
    return _messy_transformed_customers(spark, sf_dir).select(
        "customer_id", "customer_name", "city", "email")


def q_strip_fields(spark, sf_dir):
    """P5, F2: full whitespace strip of every field; any field blank."""
    raw = raw_customers(spark, sf_dir, True)
    cols = raw.columns
    return raw.select(*[clean.strip_all(c).alias(c) for c in cols],
                      predicates.any_of(predicates.is_blank_stripped(c) for c in cols)
                      .cast("int").alias("has_blank"))


def q_invalid_emails(spark, sf_dir):
    """Rows whose cleaned e-mail is null or malformed."""
    return (_messy_transformed_customers(spark, sf_dir)
            .where(predicates.email_invalid("email")).select("customer_id", "email"))


def q_order_totals_refresh(spark, sf_dir):
    """Total on the staged DECIMAL(12,2) price."""
    return _messy_transformed_orders(spark, sf_dir).select(
        "order_id", "quantity", "unit_price", "total_amount")


def q_order_totals_incremental(spark, sf_dir):
    """Total on the unrounded price, half-even to cents."""
    raw = raw_orders(spark, sf_dir)
    # prices with 11 to 17 decimals, at and near half a cent
    key = F.substr("order_id", F.lit(2)).try_cast("bigint")
    price = F.col("unit_price")
    raw = raw.withColumn("unit_price", F.when(key % 29 == 7, F.lit("0.01499999999999999"))
                         .when(key % 29 == 11, F.lit("0.00500000000001"))
                         .when(key % 29 == 13, F.concat(price, F.lit("500000000000001")))
                         .when(key % 29 == 17, F.concat(price, F.lit("500000000")))
                         .otherwise(price))
    q = parse.parse_int("quantity")
    p = parse.parse_decimal("unit_price")
    return raw.select("order_id", q.alias("quantity"), amounts.to_price(p).alias("unit_price"),
                      amounts.total_incremental(q, p).alias("total_amount"))


# Number texts that probe the parser, by order key mod 12.
NUMBER_TEXTS = [" 4 ", "+4", "4.0", "1_000", "1e3", "NaN", ".5", "-3", "12abc",
                "\t7\u00a0", "99999999999"]


def _number_text():
    k = F.col("o_orderkey")
    price = F.concat(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("5"))
    expr = None
    for i, t in enumerate(NUMBER_TEXTS):
        expr = (F.when(k % 12 == i, F.lit(t)) if expr is None
                else expr.when(k % 12 == i, F.lit(t)))
    return expr.otherwise(price)


def q_parse_numbers(spark, sf_dir):
    """Integer and decimal parsing of raw text."""
    o = read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"),
        _number_text().alias("number_text"))
    t = "number_text"
    return o.select("order_id", t,
                    parse.parse_int(t).alias("int_value"),
                    parse.is_int_text(t).cast("int").alias("is_int"),
                    parse.parse_decimal(t).alias("decimal_value"),
                    parse.is_decimal_text(t).cast("int").alias("is_decimal"),
                    parse.is_non_finite_text(t).cast("int").alias("is_non_finite"))


def _date_texts(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    k, d = F.col("o_orderkey"), F.col("d")
    iso = d.cast("string")
    y, m, day = F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string")
    text = (F.when(k % 10 == 0, iso)
            .when(k % 10 == 1, F.concat_ws("-", y, m, day))
            .when(k % 10 == 2, F.lit("2026-02-30"))
            .when(k % 10 == 3, F.date_format(d, "dd/MM/yyyy"))
            .when(k % 10 == 4, F.concat(F.lit(" "), iso, F.lit("\t")))
            .when(k % 10 == 5, F.lit("0999-01-01"))
            .when(k % 10 == 6, F.concat(iso, F.lit("T00:00")))
            .when(k % 10 == 7, F.concat(y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("- "), day))
            .when(k % 10 == 8, F.lit("")))
    return o.select(F.concat(F.lit("O"), k.cast("string")).alias("order_id"), text.alias("date_text"))


def q_parse_dates_strict(spark, sf_dir):
    """P10: zero-padded ISO dates that exist."""
    p = parse.parse_date_strict("date_text")
    return _date_texts(spark, sf_dir).select("order_id", "date_text", p.alias("parsed_date"),
                                             p.isNotNull().cast("int").alias("is_valid"))


def q_parse_dates_lenient(spark, sf_dir):
    """Strptime-style dates, month/day unpadded allowed."""
    p = parse.parse_date_lenient("date_text")
    return _date_texts(spark, sf_dir).select("order_id", "date_text", p.alias("parsed_date"),
                                             p.isNotNull().cast("int").alias("is_valid"))


# ------------------------------------------------------------ star schema

def q_dim_customer(spark, sf_dir):
    """dim_customer of the messy customers."""
    return model.build_dim_customer(_messy_transformed_customers(spark, sf_dir))


def q_surrogate_key_listing(spark, sf_dir):
    """R4."""
    return reports.surrogate_key_listing(q_dim_customer(spark, sf_dir))


def q_surrogate_key_audit(spark, sf_dir):
    """R5, A4, A9."""
    return reports.surrogate_key_audit(q_dim_customer(spark, sf_dir))


def _published(spark, sf_dir):
    """K1-K3 + K6: write staging and targets, return the warehouse."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    stg_c = model.stage_customers(raw_customers(spark, sf_dir, True))
    stg_o = model.stage_orders(raw_orders(spark, sf_dir, True))
    wh.write("stg_customers", stg_c)
    wh.write("stg_orders", stg_o)
    tr_c, tr_o = model.transform_customers(wh.read("stg_customers")), \
        model.transform_orders(wh.read("stg_orders"))
    wh.write("dim_customer", model.build_dim_customer(tr_c))
    wh.write("fact_order", model.build_fact_order(tr_o))
    return wh


def q_fact_order(spark, sf_dir):
    """K1-K3, K6: fact_order written with its declared schema, read back."""
    return _published(spark, sf_dir).read("fact_order")


def q_table_counts(spark, sf_dir):
    """Staging and target row counts."""
    wh = _published(spark, sf_dir)
    return reports.table_counts({n: wh.read(n) for n in
                                 ("stg_customers", "stg_orders", "dim_customer", "fact_order")})


def q_describe_tables(spark, sf_dir):
    """K6 + P15: the targets' DDL registered and DESCRIBEd, with the filled values of each column."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    db = "wh_" + wh.root.rsplit("/", 1)[-1]
    wh.create_tables(db, ["dim_customer", "fact_order"])
    wh.write("dim_customer", model.build_dim_customer(_messy_transformed_customers(spark, sf_dir)))
    wh.write("fact_order", model.build_fact_order(_messy_transformed_orders(spark, sf_dir)))
    out = None
    for name in ("dim_customer", "fact_order"):
        df = wh.read(name)
        cols = [f.name for f in TABLES[name].fields]
        filled = df.agg(*[F.count(c).alias(c) for c in cols]).select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("col_name"), F.col(c).alias("filled")) for c in cols])).alias("x")).select("x.*")
        part = wh.describe(db, name).join(filled, "col_name").select("table_name", "col_name", "data_type", "filled")
        out = part if out is None else out.unionByName(part)
    return out


def q_preview_customers(spark, sf_dir):
    """Ten cleaned customers, ordered."""
    return reports.preview(_messy_transformed_customers(spark, sf_dir),
                           ["customer_id", "customer_name", "city", "email"], "customer_id")


def q_preview_orders(spark, sf_dir):
    """Ten orders with their amounts, ordered."""
    return reports.preview(_messy_transformed_orders(spark, sf_dir),
                           ["order_id", "customer_id", "quantity", "unit_price", "total_amount"],
                           "order_id")


# ------------------------------------------------------------ quality

def _candidates(spark, sf_dir):
    # no rule reads the surrogate key, so it is not numbered here
    dim = _messy_transformed_customers(spark, sf_dir)
    fact = tamper_totals(_messy_transformed_orders(spark, sf_dir, keep_raw=True))
    return {"customers": dim, "orders": fact}


def q_dq_report(spark, sf_dir):
    """D1-D13, D17 on the candidate dimension and fact, one row per rule."""
    return quality.check(_candidates(spark, sf_dir))


def q_dq_verdict(spark, sf_dir):
    """Every failing rule in one message."""
    return quality.verdict(q_dq_report(spark, sf_dir))


def q_orphan_orders(spark, sf_dir):
    """Orders whose trimmed customer id has no customer."""
    t = _candidates(spark, sf_dir)
    return quality.orphan_rows(t["orders"], t["customers"], "customer_id").select(
        "order_id", "customer_id")


def q_duplicate_keys(spark, sf_dir):
    """Key values held by more than one row."""
    t = _candidates(spark, sf_dir)
    parts = []
    for table, key in (("customers", "customer_id"), ("orders", "order_id")):
        parts.append(t[table].groupBy(F.col(key).alias("key_value"))
                     .agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
                     .select(F.lit(table).alias("table_name"), "key_value", "copies"))
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------ files

# Landing zones derived from the given tables are read-only inputs, like
# the tables themselves: written once per session and source folder, then
# read (in full) by every file query.  A vanished folder is written again.
_LANDINGS: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def _memo_landing(spark, key, make):
    from ..sources.files import Landing
    memo = _LANDINGS.setdefault(spark, {})
    landing = memo.get(key)
    if landing is None or not landing.exists(""):
        landing = Landing(spark, make())
        memo[key] = landing
    return landing


def _landing(spark, sf_dir):
    from ..sources.bindings import materialize_landing
    return _memo_landing(spark, ("raw", sf_dir), lambda: materialize_landing(
        spark, sf_dir, scratch_path(spark, "landing")))


def _scan(spark, landing, kind):
    from ..sources.bindings import CUSTOMERS_PREFIX, ORDERS_PREFIX
    from .incremental import KIND_COLUMNS
    from ..sources.files import file_contract, project_by_name, scan_records
    ls = landing.list_csv(CUSTOMERS_PREFIX if kind == "customers" else ORDERS_PREFIX)
    scan = scan_records(spark, [r["path"] for r in ls.select("path").collect()])
    rows = project_by_name(scan, KIND_COLUMNS[kind]).withColumn("file_name", landing.key(F.col("path")))
    return ls, scan, rows, file_contract(ls, scan, KIND_COLUMNS[kind])


def q_required_inputs(spark, sf_dir):
    """Presence of the required objects (one is absent on purpose) and the check's error."""
    from ..sources.bindings import CUSTOMERS_PREFIX, ORDERS_PREFIX
    from ..sources.files import MissingInput, check_required
    landing = _landing(spark, sf_dir)
    listing = landing.listing([CUSTOMERS_PREFIX, ORDERS_PREFIX]).select("file_name")
    # The keys a full-refresh run requires.
    keys = [f"{CUSTOMERS_PREFIX}/customers_00.csv", f"{ORDERS_PREFIX}/orders_00.csv", f"{ORDERS_PREFIX}/orders.csv"]
    try:
        check_required(landing, keys)
        message = None
    except MissingInput as e:
        message = str(e)
    required = spark.createDataFrame([(i, k) for i, k in enumerate(keys, 1)], "check_order int, file_name string")
    present = listing.withColumn("present", F.lit(1))
    return (required.join(present, "file_name", "left")
            .select("check_order", "file_name", F.coalesce("present", F.lit(0)).alias("present"),
                    F.lit(message).cast("string").alias("check_error")))


def q_list_inputs(spark, sf_dir):
    """Recursive *.csv listing with kind and processing order."""
    from .incremental import IncrementalConfig, list_files
    landing = _landing(spark, sf_dir)
    ls = list_files(landing, IncrementalConfig())
    from ..sources.files import check_any_files
    check_any_files(ls)
    return ls.select("file_name", "kind", "ordinal")


def q_scan_by_name(spark, sf_dir):
    """Order files read by header name, with record numbers."""
    _, _, rows, _ = _scan(spark, _landing(spark, sf_dir), "orders")
    return rows.select("file_name", "row_number", "order_id", "customer_id", "order_date",
                       "quantity", "unit_price")


def q_scan_customers(spark, sf_dir):
    """Customer files (reordered headers, quoted commas) by name."""
    _, _, rows, _ = _scan(spark, _landing(spark, sf_dir), "customers")
    return rows.select("file_name", "row_number", "customer_id", "customer_name", "city",
                       "email", "created_date")


def q_scan_quoted(spark, sf_dir):
    """Files whose quoted fields hold line feeds, quotes and commas, by header name."""
    from ..sources.bindings import NOTES_PREFIX, materialize_notes
    from ..sources.files import project_by_name, scan_records
    landing = _memo_landing(spark, ("notes", sf_dir), lambda: materialize_notes(
        spark, sf_dir, scratch_path(spark, "landing-notes")))
    scan = scan_records(spark, [r["path"] for r in landing.list_csv(NOTES_PREFIX).select("path").collect()])
    rows = project_by_name(scan, ["order_id", "customer_id", "note"])
    return rows.select(landing.key(F.col("path")).alias("file_name"), "row_number", "order_id", "customer_id", "note")


def q_row_numbers(spark, sf_dir):
    """Physical record number of every order row."""
    _, _, rows, _ = _scan(spark, _landing(spark, sf_dir), "orders")
    return rows.select("file_name", "order_id", "row_number")


def _contracts(spark, landing):
    from ..sources.files import python_list_repr
    out = None
    for kind in ("customers", "orders"):
        _, _, _, c = _scan(spark, landing, kind)
        c = c.select("file_name", "data_rows", python_list_repr("missing_columns").alias("missing_columns"),
                     "contract_error")
        out = c if out is None else out.unionByName(c)
    return out


def q_file_contract(spark, sf_dir):
    """Data rows and missing required headers per file."""
    return _contracts(spark, _landing(spark, sf_dir))


def q_file_violations(spark, sf_dir):
    """Every violation of every row."""
    from ..operators.file_rules import row_violations
    landing = _landing(spark, sf_dir)
    out = None
    for kind in ("customers", "orders"):
        _, _, rows, _ = _scan(spark, landing, kind)
        v = row_violations(rows, kind)
        out = v if out is None else out.unionByName(v)
    return out


def q_date_violations(spark, sf_dir):
    """P11 check: every blank or non-strptime order date, all errors kept."""
    from ..operators.file_rules import date_violations
    _, _, rows, _ = _scan(spark, _landing(spark, sf_dir), "orders")
    return date_violations(rows, "order_date")


def q_file_verdicts(spark, sf_dir):
    """First error of each file, in the source's check order; one scan of both kinds."""
    from ..operators.file_rules import file_verdicts
    from .incremental import IncrementalConfig, listed, scan_files
    rows, contract = scan_files(spark, listed(_landing(spark, sf_dir), IncrementalConfig()).withColumn("ordinal", F.lit(0)))
    return file_verdicts(contract, rows)


def _seeded_store(spark, landing):
    """A fresh store whose tracker already knows three files (batch 0)."""
    from ..sources.bindings import CUSTOMERS_PREFIX, ORDERS_PREFIX
    from .incremental import IngestionStore
    store = IngestionStore(spark, scratch_path(spark, "ingest"))
    ls = landing.listing([CUSTOMERS_PREFIX, ORDERS_PREFIX])
    # Earlier outcomes of three files.
    seed = {f"{CUSTOMERS_PREFIX}/customers_01.csv": ("SUCCESS", None),
            f"{ORDERS_PREFIX}/orders_02.csv": ("SUCCESS", None),
            f"{ORDERS_PREFIX}/orders_04.csv": ("FAILED", "earlier failure")}
    status = F.coalesce(*[F.when(F.col("file_name") == k, F.lit(v[0])) for k, v in seed.items()])
    err = F.coalesce(*[F.when(F.col("file_name") == k, F.lit(v[1])) for k, v in seed.items()])
    store.record_events(ls.where(F.col("file_name").isin(list(seed))).select(
        "file_name", status.alias("status"), F.lit(0).alias("record_count"),
        err.cast("string").alias("error_message")), 0, 2)
    return store


def q_file_plan(spark, sf_dir):
    """J3, F5, I6, I7 + the I5 cut: what a run would do with every file."""
    from .incremental import IncrementalConfig, decide, list_files, plan_files
    landing = _landing(spark, sf_dir)
    store = _seeded_store(spark, landing)
    plan = plan_files(list_files(landing, IncrementalConfig()), store.tracker_latest())
    decided, _, _ = decide(spark, plan, IncrementalConfig())
    return decided.select("file_name", "ordinal", "prev_status", "status", "record_count", "error_message")


def _run(spark, sf_dir, on_error="stop"):
    from .incremental import IncrementalConfig, run_incremental
    landing = _landing(spark, sf_dir)
    store = _seeded_store(spark, landing)
    return run_incremental(spark, landing, store, IncrementalConfig(on_error=on_error), raise_on_error=False), store


def q_incremental_run(spark, sf_dir):
    """The run log of one incremental run (stops at the first failure)."""
    res, _ = _run(spark, sf_dir)
    return res.run_log.select("file_name", "status", "record_count", "error_message")


def q_incremental_continue(spark, sf_dir):
    """I5 in continue mode: the run log; good files after a failure are published too."""
    res, _ = _run(spark, sf_dir, "continue")
    return res.run_log.select("file_name", "status", "record_count", "error_message")


def q_upsert_continue(spark, sf_dir):
    """K4: the order table after a run in continue mode."""
    _, store = _run(spark, sf_dir, "continue")
    return store.visible("orders")


def q_run_summary(spark, sf_dir):
    """A10."""
    from .incremental import run_summary
    res, _ = _run(spark, sf_dir)
    return run_summary(res.run_log)


def q_upsert_latest(spark, sf_dir):
    """K4: the order table after the run: one row per order id, last file wins."""
    _, store = _run(spark, sf_dir)
    return store.visible("orders")


def q_upsert_compacted(spark, sf_dir):
    """K4 after compaction: the snapshot + later batches give the same view."""
    _, store = _run(spark, sf_dir)
    store.compact("orders")
    return store.visible("orders")


def q_upsert_customers(spark, sf_dir):
    """K4: the customer table after the run."""
    _, store = _run(spark, sf_dir)
    return store.visible("customers")


def q_tracker_history(spark, sf_dir):
    """Tracker rows, newest first (processed_at not compared)."""
    _, store = _run(spark, sf_dir)
    return (store.tracker_latest().orderBy(F.col("processed_at").desc(), "file_name")
            .select("file_name", "status", "record_count", "error_message"))


def q_files_per_status(spark, sf_dir):
    """R9."""
    _, store = _run(spark, sf_dir)
    return store.tracker_latest().groupBy("status").agg(F.count(F.lit(1)).alias("file_count"))


def q_incremental_counts(spark, sf_dir):
    """Customer and order counts and the order total after the run."""
    _, store = _run(spark, sf_dir)
    # two one-row aggregates side by side: a union and one more aggregate
    c = store.visible("customers").agg(
        F.count(F.lit(1)).alias("customer_count"), F.lit(None).cast("bigint").alias("order_count"),
        F.lit(None).cast("decimal(38,2)").alias("order_total"))
    o = store.visible("orders").agg(
        F.lit(None).cast("bigint").alias("customer_count"), F.count(F.lit(1)).alias("order_count"),
        amounts.sum_amount("total_amount").alias("order_total"))
    both = c.unionByName(o)
    return both.agg(*[F.max(x).alias(x) for x in ("customer_count", "order_count", "order_total")])


def q_order_totals_listing(spark, sf_dir):
    """Every order after the run with its quantity, price and total, ordered by id."""
    _, store = _run(spark, sf_dir)
    return store.visible("orders").select("order_id", "quantity", "unit_price", "total_amount").orderBy("order_id")


def q_stream_ingest(spark, sf_dir):
    """I8: the same ingestion as a file stream (availableNow); tracker afterwards."""
    from ..streaming.ingest import run_stream_once
    landing = _landing(spark, sf_dir)
    store = _seeded_store(spark, landing)
    run_stream_once(spark, landing, store, scratch_path(spark, "stream-checkpoint"))
    return store.tracker_latest().select("file_name", "status", "record_count", "error_message")


def q_full_refresh(spark, sf_dir):
    """CSV objects -> staging -> transform -> validate -> dim/fact; fact joined to dim."""
    from ..sources.bindings import full_refresh_lines
    from ..sources.files import Landing
    from ..sources.landing import write_named_files
    from .full_refresh import fact_with_customer, run_full_refresh
    def make():
        root = scratch_path(spark, "landing-full")
        write_named_files(full_refresh_lines(spark, sf_dir), root)
        return root
    landing = _memo_landing(spark, ("full", sf_dir), make)
    wh = Warehouse(spark, scratch_path(spark, "warehouse-full"))
    res = run_full_refresh(spark, landing, wh, "raw/full/customers", "raw/full/orders")
    return fact_with_customer(res.fact, res.dim)


QUERIES: dict[str, Query] = {
    "monthly_sales": q_monthly_sales,
    "sales_by_city": q_sales_by_city,
    "sales_by_customer": q_sales_by_customer,
    "clean_customers": q_clean_customers,
    "strip_fields": q_strip_fields,
    "invalid_emails": q_invalid_emails,
    "order_totals_refresh": q_order_totals_refresh,
    "order_totals_incremental": q_order_totals_incremental,
    "parse_numbers": q_parse_numbers,
    "parse_dates_strict": q_parse_dates_strict,
    "parse_dates_lenient": q_parse_dates_lenient,
    "dim_customer": q_dim_customer,
    "surrogate_key_listing": q_surrogate_key_listing,
    "surrogate_key_audit": q_surrogate_key_audit,
    "fact_order": q_fact_order,
    "table_counts": q_table_counts,
    "describe_tables": q_describe_tables,
    "preview_customers": q_preview_customers,
    "preview_orders": q_preview_orders,
    "dq_report": q_dq_report,
    "dq_verdict": q_dq_verdict,
    "orphan_orders": q_orphan_orders,
    "duplicate_keys": q_duplicate_keys,
    "required_inputs": q_required_inputs,
    "list_inputs": q_list_inputs,
    "scan_by_name": q_scan_by_name,
    "scan_customers": q_scan_customers,
    "scan_quoted": q_scan_quoted,
    "row_numbers": q_row_numbers,
    "file_contract": q_file_contract,
    "file_violations": q_file_violations,
    "file_verdicts": q_file_verdicts,
    "date_violations": q_date_violations,
    "file_plan": q_file_plan,
    "incremental_run": q_incremental_run,
    "incremental_continue": q_incremental_continue,
    "upsert_continue": q_upsert_continue,
    "run_summary": q_run_summary,
    "upsert_latest": q_upsert_latest,
    "upsert_compacted": q_upsert_compacted,
    "upsert_customers": q_upsert_customers,
    "tracker_history": q_tracker_history,
    "files_per_status": q_files_per_status,
    "incremental_counts": q_incremental_counts,
    "order_totals_listing": q_order_totals_listing,
    "stream_ingest": q_stream_ingest,
    "full_refresh": q_full_refresh,
}
