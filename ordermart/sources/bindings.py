"""Bind the given TPC-H-style tables to the customer/order data model.

The sales model needs raw customer and order CSV rows (all text).  They
are derived here, deterministically, from ``customer`` / ``nation`` and
``orders``, so every query's work grows with the given tables.  The
``messy`` variants inject dirt keyed on the source key (whitespace,
case, bad e-mails, bad dates, negative prices, duplicates, orphans,
over-long text, overflowing numbers) so that each quality rule fires.
The same derivations are written in SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import read_table

# The first created_date and the cycle of dates.
BASE_DATE = "2026-01-01"
DATE_CYCLE = 365
# Fixed value: offset that turns a customer key into one with no customer.
ORPHAN_OFFSET = 1000000000


def _s(c: Column) -> Column:
    return c.cast("string")


def _duplicate_where(df: DataFrame, cond: Column) -> DataFrame:
    """Emit rows matching ``cond`` twice (one scan, no union of two scans)."""
    copies = F.when(cond, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


def _customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # nation is the fixed 25-row TPC-H dimension: a proven size bound.
    nation = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey, "inner")


def raw_customers(spark: SparkSession, sf_dir: str, messy: bool = False) -> DataFrame:
    """customers.csv rows: customer_id, customer_name, city, email, created_date."""
    df = _customer_rows(spark, sf_dir)
    k = F.col("c_custkey")
    seg = F.lower("c_mktsegment")
    nat = F.lower("n_name")
    cid = F.concat(F.lit("C"), _s(k))
    name = F.concat(seg, F.lit("  "), F.replace(F.lower("c_name"), F.lit("#"), F.lit(" ")))
    city = F.col("n_name")
    email = F.concat(F.lit(" Customer."), _s(k), F.lit("@Example.com "))
    created = _s(F.date_add(F.lit(BASE_DATE).cast("date"), (k % DATE_CYCLE).cast("int")))
    if messy:
        cid = (F.when(k % 97 == 5, F.concat(F.lit("  "), cid, F.lit(" ")))
               .when(k % 97 == 7, F.concat(F.lit("\t"), cid))
               .when(k % 97 == 9, F.concat(F.lit("\u00a0"), cid, F.lit("\u001f")))
               .otherwise(cid))
        name = (F.when(k % 35 == 5, F.lit(None).cast("string"))
                .when(k % 35 == 6, F.lit("   "))
                .when(k % 997 == 3, F.repeat(F.lit("household "), 16))
                .when(k % 7 == 0, F.concat(F.lit("  "), seg, F.lit("   "), nat, F.lit("  ")))
                .when(k % 7 == 1, F.concat(F.upper(seg), F.lit("\t\t"), F.lit("o'"), nat))
                .when(k % 7 == 2, F.concat(seg, F.lit("-"), F.upper(nat), F.lit(" "), _s(k), F.lit("th")))
                .when(k % 7 == 3, F.concat(F.lit("\t"), seg, F.lit(" mc"), nat))
                .when(k % 7 == 4, F.concat(seg, F.lit("\n"), nat))
                .otherwise(name))
        city = (F.when(k % 3 == 0, F.replace(nat, F.lit("_"), F.lit("  ")))
                .when(k % 3 == 1, F.concat(F.lit(" "), F.upper(city), F.lit(" ")))
                .otherwise(city))
        email = (F.when(k % 11 == 0, F.lit(None).cast("string"))
                 .when(k % 11 == 1, F.lit("bad@"))
                 .when(k % 11 == 2, F.lit("a@b.c"))
                 .when(k % 11 == 3, F.concat(F.lit("customer."), _s(k), F.lit("@example.com\n")))
                 .when(k % 11 == 4, F.concat(F.lit("customer."), _s(k), F.lit("@example.com.")))
                 .otherwise(email))
        created = (F.when(k % 13 == 0, F.lit(None).cast("string"))
                   .when(k % 13 == 1, F.lit("2026-02-30"))
                   .when(k % 13 == 2, F.lit("2026-9-1"))
                   .when(k % 13 == 3, F.lit("10/9/2026"))
                   .otherwise(created))
    out = df.select(cid.alias("customer_id"), name.alias("customer_name"),
                    city.alias("city"), email.alias("email"),
                    created.alias("created_date"), k.alias("_key"))
    if messy:
        out = _duplicate_where(out, F.col("_key") % 89 == 0)
    return out.drop("_key")


def raw_orders(spark: SparkSession, sf_dir: str, messy: bool = False) -> DataFrame:
    """orders.csv rows: order_id, customer_id, order_date, quantity, unit_price."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    oid = F.concat(F.lit("O"), _s(k))
    cid = F.concat(F.lit("C"), _s(F.col("o_custkey")))
    odate = _s(F.col("o_orderdate").cast("date"))
    qty = _s(k % 5 + 1)
    base_price = _s(F.col("o_totalprice").cast("decimal(12,2)"))
    # every 17th price carries a third decimal, which staging rounds away
    price = F.when(k % 17 == 3, F.concat(base_price, F.lit("5"))).otherwise(base_price)
    if messy:
        oid = (F.when(k % 701 == 0, F.concat(F.lit(" "), oid))
               .when(k % 1009 == 0, F.concat(oid, F.repeat(F.lit("-x"), 30)))
               .otherwise(oid))
        cid = (F.when(k % 211 == 0, F.concat(F.lit("C"), _s(F.col("o_custkey") + ORPHAN_OFFSET)))
               .when(k % 701 == 1, F.concat(F.lit(" "), cid))
               .otherwise(cid))
        odate = (F.when(k % 313 == 0, F.lit(None).cast("string"))
                 .when(k % 317 == 0, F.lit("2026-13-01"))
                 .otherwise(odate))
        qty = (F.when(k % 607 == 0, F.lit("0"))
               .when(k % 809 == 0, F.lit("99999999999"))
               .when(k % 1019 == 0, F.lit("2000000000"))
               .otherwise(qty))
        price = (F.when(k % 389 == 0, F.concat(F.lit("-"), base_price))
                 .when(k % 919 == 0, F.lit("abc"))
                 .when(k % 1013 == 0, F.lit("12345678901.5"))
                 .otherwise(price))
    out = o.select(oid.alias("order_id"), cid.alias("customer_id"),
                   odate.alias("order_date"), qty.alias("quantity"),
                   price.alias("unit_price"), k.alias("_key"))
    if messy:
        out = _duplicate_where(out, F.col("_key") % 503 == 0)
    return out.drop("_key")


def tamper_totals(fact: DataFrame) -> DataFrame:
    """Candidate fact with every 401st order's total off by one cent."""
    key = F.substr(F.trim("order_id"), F.lit(2)).try_cast("bigint")
    return fact.withColumn(
        "total_amount",
        F.when(key % 401 == 0, (F.col("total_amount") + F.lit(0.01).cast("decimal(3,2)"))
               .try_cast("decimal(14,2)"))
        .otherwise(F.col("total_amount")))


# ---------------------------------------------------------------- raw files
#
# ``files_src``: the given tables cut into CSV objects of a landing zone.
# Orders go to 20 files by order key (raw/orders/orders_00.csv ...), lines
# ordered by key; customers to 4 files.  Chosen files carry one kind of
# defect each, some headers are reordered, extended or short of a column,
# one file has blank lines, and file 06 repeats order ids of file 03 with
# other values (the later file must win the upsert).

ORDER_FILES = 20
CUSTOMER_FILES = 4
ORDERS_PREFIX = "raw/orders"
CUSTOMERS_PREFIX = "raw/customers"


def _file_name(prefix: str, stem: str, idx: Column) -> Column:
    return F.concat(F.lit(f"{prefix}/{stem}_"), F.lpad(idx.cast("string"), 2, "0"), F.lit(".csv"))


def order_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_name, file_idx, seq, and the order fields as text."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    idx = (k % ORDER_FILES).cast("int")
    price = _s(F.col("o_totalprice").cast("decimal(12,2)"))
    oid = (F.when(k % 60 == 6, F.concat(F.lit("O"), _s(k - 3)))
           .when(k % 280 == 14, F.concat(F.lit("O"), _s(k), F.repeat(F.lit("-long"), 12)))
           .otherwise(F.concat(F.lit("O"), _s(k))))
    cid = F.when(k % 260 == 113, F.lit("  ")).otherwise(F.concat(F.lit("C"), _s(F.col("o_custkey"))))
    odate = F.when(k % 140 == 67, F.lit("10/9/2026")).otherwise(_s(F.col("o_orderdate").cast("date")))
    qty = (F.when(k % 220 == 11, F.lit("2.5"))
           .when(k % 340 == 17, F.lit("0"))
           .when(k % 260 == 13, F.lit("0"))
           .when(k % 60 == 6, _s(k % 7 + 10))
           .otherwise(_s(k % 5 + 1)))
    uprice = (F.when(k % 320 == 16, F.concat(F.lit("-"), price))
              .when(k % 360 == 18, F.lit("NaN"))
              .when(k % 300 == 15, F.lit("Infinity"))
              .when(k % 17 == 3, F.concat(price, F.lit("5")))
              .otherwise(price))
    return o.select(_file_name(ORDERS_PREFIX, "orders", idx).alias("file_name"), idx.alias("file_idx"),
                    k.alias("seq"), oid.alias("order_id"), cid.alias("customer_id"),
                    odate.alias("order_date"), qty.alias("quantity"), uprice.alias("unit_price"),
                    F.lit("n").alias("note"))


def customer_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _customer_rows(spark, sf_dir)
    k = F.col("c_custkey")
    idx = (k % CUSTOMER_FILES).cast("int")
    return df.select(
        _file_name(CUSTOMERS_PREFIX, "customers", idx).alias("file_name"), idx.alias("file_idx"),
        k.alias("seq"),
        F.concat(F.lit("C"), _s(k)).alias("customer_id"),
        F.concat(F.initcap("c_mktsegment"), F.lit(", "), F.replace("c_name", F.lit("#"), F.lit(" "))).alias("customer_name"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit("\t")).alias("city"),
        F.concat(F.lit("Customer."), _s(k), F.lit("@Example.com")).alias("email"),
        _s(F.date_add(F.lit(BASE_DATE).cast("date"), (k % DATE_CYCLE).cast("int"))).alias("created_date"))


# Header layouts of the raw files: (condition on file index, columns).
_ORDER_STD = ["order_id", "customer_id", "order_date", "quantity", "unit_price"]
_CUSTOMER_STD = ["customer_id", "customer_name", "city", "email", "created_date"]


def order_file_layouts(idx: Column) -> list[tuple[Column, list[str]]]:
    """Order files: 19 lacks unit_price, idx%3==1 reversed, idx%3==2 extra column."""
    return [(idx == 19, _ORDER_STD[:4]),
            (idx % 3 == 1, list(reversed(_ORDER_STD))),
            (idx % 3 == 2, _ORDER_STD + ["note"]),
            (F.lit(True), _ORDER_STD)]


def customer_file_layouts(idx: Column) -> list[tuple[Column, list[str]]]:
    s = _CUSTOMER_STD
    return [(idx % 2 == 1, [s[4], s[0], s[3], s[1], s[2]]), (F.lit(True), s)]


def _by_layout(layouts, build) -> Column:
    expr = None
    for cond, cols in layouts:
        v = build(cols)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr


def file_lines(rows: DataFrame, layouts, blank_after: Column | None = None) -> DataFrame:
    """(file_name, seq, line): header first, then one CSV line per row.

    Values are placed by the file's own header layout (a CASE over the few
    layouts, all in generated code); ``blank_after`` rows are followed by
    an empty line.
    """
    from .landing import csv_field
    line = _by_layout(layouts, lambda cols: F.concat_ws(",", *[csv_field(c) for c in cols]))
    data = rows.select("file_name", (F.col("seq") * 2).alias("seq"), line.alias("line"))
    # the header depends only on the file: a distinct of (file, index), no aggregate buffer
    head = _by_layout(layouts, lambda cols: F.lit(",".join(cols)))
    heads = (rows.select("file_name", "file_idx").distinct()
             .select("file_name", F.lit(-1).cast("bigint").alias("seq"), head.alias("line")))
    out = data.unionByName(heads)
    if blank_after is not None:
        out = out.unionByName(rows.where(blank_after).select(
            "file_name", (F.col("seq") * 2 + 1).alias("seq"), F.lit("").alias("line")))
    return out


def landing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = order_file_rows(spark, sf_dir)
    c = customer_file_rows(spark, sf_dir)
    ol = file_lines(o, order_file_layouts(F.col("file_idx")),
                    blank_after=(F.col("file_idx") == 5) & (F.col("seq") % 100 == 5))
    cl = file_lines(c, customer_file_layouts(F.col("file_idx")))
    return ol.unionByName(cl)


def materialize_landing(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write ``landing_lines`` as CSV objects under ``root``; returns root."""
    from .landing import write_named_files
    write_named_files(landing_lines(spark, sf_dir), root)
    return root


def full_refresh_lines(spark: SparkSession, sf_dir: str, messy: bool = False) -> DataFrame:
    """The raw customers/orders as CSV objects under raw/full/ (several files each)."""
    from .landing import csv_line
    parts = []
    for stem, df, n in (("customers", raw_customers(spark, sf_dir, messy), 4),
                        ("orders", raw_orders(spark, sf_dir, messy), 8)):
        cols = df.columns
        key = F.xxhash64(*cols)
        rows = df.select(
            F.concat(F.lit(f"raw/full/{stem}/{stem}_"), F.pmod(key, F.lit(n)).cast("string"), F.lit(".csv"))
            .alias("file_name"),
            F.monotonically_increasing_id().alias("seq"), csv_line(cols).alias("line"))
        heads = rows.select("file_name").distinct().select(
            "file_name", F.lit(-1).cast("bigint").alias("seq"), F.lit(",".join(cols)).alias("line"))
        parts += [rows, heads]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ``notes``: one CSV object for every NOTE_FILE_KEYS order keys, so their number
# grows with the data.  Most notes hold line feeds, quotes or commas.
NOTE_FILE_KEYS = 20_000
NOTES_PREFIX = "raw/notes"
_NOTE_STD = ["order_id", "customer_id", "note"]


def note_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_name, seq, line) of the notes; a line may hold line feeds inside quotes."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    idx = F.floor(k / NOTE_FILE_KEYS).cast("int")
    day = _s(F.col("o_orderdate").cast("date"))
    note = (F.when(k % 5 == 0, F.concat(F.lit('called "again"\n\non '), day, F.lit(', no "answer"')))
            .when(k % 5 == 1, F.concat(F.lit("\n"), _s(k), F.lit(",\n")))
            .when(k % 5 == 2, F.concat(F.lit("plain "), day))
            .when(k % 5 == 3, F.concat(F.lit('"x",\n"y'), F.repeat(F.lit('"\n'), (k % 4).cast("int")))))
    rows = o.select(F.concat(F.lit(f"{NOTES_PREFIX}/notes_"), F.lpad(_s(idx), 6, "0"), F.lit(".csv")).alias("file_name"),
                    idx.alias("file_idx"), k.alias("seq"), F.concat(F.lit("O"), _s(k)).alias("order_id"),
                    F.concat(F.lit("C"), _s(F.col("o_custkey"))).alias("customer_id"), note.alias("note"))
    return file_lines(rows, [(F.col("file_idx") % 2 == 1, [_NOTE_STD[2], _NOTE_STD[0], _NOTE_STD[1]]), (F.lit(True), _NOTE_STD)],
                      blank_after=F.col("seq") % 50 == 7)


def materialize_notes(spark: SparkSession, sf_dir: str, root: str) -> str:
    from .landing import write_named_files
    write_named_files(note_lines(spark, sf_dir), root)
    return root
