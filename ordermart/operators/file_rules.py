"""Per-file validation (D14-D16) and the first error of a file.

The source project walks each file row by row and raises on the first
problem, in this order:

  phase 0  contract: no data rows, then missing required columns;
  phase 1  per row: each required field present (column order), then
           each date column strict ISO;
  phase 2  orders only, per row: numbers parse, quantity > 0,
           unit_price >= 0, total quantises (non-finite prices fail);
  phase 3  the insert: values must fit the declared column types.

Here every row's candidate violations are built as an array of
``struct(phase, seq, message)``; the least is the row's first error, and the
message with the least (phase, row, seq) is the file's.  That is a partial
(map-side) aggregation, so a file of any size reduces to one row per task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.amounts import to_price, total_incremental
from ..functions.clean import strip_all
from ..functions.parse import (STRICT_DATE_SYNTAX as STRICT_DATE_RE, is_decimal_text, is_int_text,
                               has_excess_decimals, is_non_finite_text, parse_decimal, parse_int, parse_int_wide)
from ..schemas import CUSTOMER_COLUMNS, ORDER_COLUMNS, VARCHAR_LIMITS

# Message texts of the source project.
MSG_MISSING = "{file}, row {row}: {col} is missing."
MSG_BAD_DATE = "{file}, row {row}: invalid {col} '{value}'; expected YYYY-MM-DD."
MSG_NOT_NUMERIC = "{file}, row {row}: quantity/unit_price must be numeric."
MSG_QTY = "{file}, row {row}: quantity must be greater than 0."
MSG_PRICE = "{file}, row {row}: unit_price cannot be negative."
# str() of the decimal module's InvalidOperation, raised by NaN comparisons
# and by quantising an infinite total.
MSG_DECIMAL_OP = "[<class 'decimal.InvalidOperation'>]"

KINDS = {
    "customers": {"columns": CUSTOMER_COLUMNS, "dates": ["created_date"], "limits": "customers"},
    "orders": {"columns": ORDER_COLUMNS, "dates": ["order_date"], "limits": "orders"},
}

_NAN = r"(?i)^[+-]?s?nan[0-9]*\z"
_NEG_INF = r"(?i)^-(inf|infinity)\z"
_POS_INF = r"(?i)^\+?(inf|infinity)\z"


def _msg(template: str, col: str = "", value: Column | None = None) -> Column:
    head, rest = template.split("{file}", 1)
    pieces = [F.lit(head), F.col("file_name")]
    rest_parts = rest.split("{row}")
    pieces += [F.lit(rest_parts[0]), F.col("row_number").cast("string")]
    tail = rest_parts[1].replace("{col}", col)
    if "{value}" in tail:
        a, b = tail.split("{value}")
        pieces += [F.lit(a), value, F.lit(b)]
    else:
        pieces.append(F.lit(tail))
    return F.concat(*pieces)


def _v(cond: Column, phase: int, seq: int, message: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)),
                  F.struct(F.lit(phase).alias("phase"), F.lit(seq).alias("seq"),
                           message.alias("message")))


def prepare(rows: DataFrame, *kinds: str) -> DataFrame:
    """Strip and parse each field of the kinds once, as columns, before the checks.

    The checks read these columns many times; computing them in a
    projection of their own keeps every regex to one evaluation per row
    (Catalyst does not collapse a projection into one that would repeat
    a non-trivial expression) and keeps the generated code small.
    """
    cols = dict.fromkeys(c for k in kinds for c in KINDS[k]["columns"])
    extra = [strip_all(c).alias(f"_s_{c}") for c in cols]
    if "orders" in kinds:
        q, p = F.col("quantity"), F.col("unit_price")
        extra += [is_int_text(q).alias("_q_is_int"), parse_int_wide(q).alias("_q_wide"),
                  parse_int(q).alias("_q_int"), is_decimal_text(p).alias("_p_is_dec"),
                  is_non_finite_text(p).alias("_p_non_finite"),
                  has_excess_decimals(p).alias("_p_excess"), parse_decimal(p).alias("_p_dec")]
    out = rows.select("*", *extra)
    for c in dict.fromkeys(d for k in kinds for d in KINDS[k]["dates"]):
        s_ = F.col(f"_s_{c}")
        out = out.withColumn(f"_d_{c}", s_.rlike(STRICT_DATE_RE) & F.try_to_date(s_, "yyyy-MM-dd").isNotNull())
    if "orders" in kinds:
        out = out.withColumn("_p_price", to_price(F.col("_p_dec"))).withColumn(
            "_total", total_incremental(F.col("_q_int"), F.col("_p_dec")))
    return out


def row_checks(kind: str) -> list[Column]:
    """Candidate violations of one prepared row, as struct(phase, seq, message)."""
    spec = KINDS[kind]
    cols, dates = spec["columns"], spec["dates"]

    def blank(c):
        return F.col(c).isNull() | (F.col(f"_s_{c}") == "")

    checks = []
    for i, c in enumerate(cols):
        checks.append(_v(blank(c), 1, i, _msg(MSG_MISSING, c)))
    for j, c in enumerate(dates):
        checks.append(_v(~blank(c) & ~F.col(f"_d_{c}"), 1, 100 + j,
                         _msg(MSG_BAD_DATE, c, F.col(f"_s_{c}"))))
    if kind == "orders":
        ps = F.col("_s_unit_price")
        numeric = F.col("_q_is_int") & (F.col("_p_is_dec") | F.col("_p_non_finite"))
        checks += [
            _v(~numeric, 2, 0, _msg(MSG_NOT_NUMERIC)),
            _v(F.col("_q_wide") <= 0, 2, 1, _msg(MSG_QTY)),
            _v(ps.rlike(_NAN), 2, 2, F.lit(MSG_DECIMAL_OP)),
            _v((F.col("_p_dec") < 0) | ps.rlike(_NEG_INF), 2, 2, _msg(MSG_PRICE)),
            _v(ps.rlike(_POS_INF), 2, 3, F.lit(MSG_DECIMAL_OP)),
        ]
    # phase 3: the values must fit the declared column types
    for i, (c, n) in enumerate(VARCHAR_LIMITS[spec["limits"]].items()):
        v = F.col(f"_s_{c}") if c != "email" else F.lower(F.col(f"_s_{c}"))
        checks.append(_v(F.octet_length(v) > n, 3, i,
                         _msg("{file}, row {row}: {col} is longer than " + str(n) + " bytes.", c)))
    if kind == "orders":
        fin, qi, pr = F.col("_p_is_dec"), F.col("_q_int"), F.col("_p_price")
        checks += [
            _v(F.col("_q_is_int") & qi.isNull(), 3, 10,
               _msg("{file}, row {row}: {col} is outside the INT range.", "quantity")),
            _v(fin & pr.isNull(), 3, 11, _msg("{file}, row {row}: {col} is outside DECIMAL(12,2).", "unit_price")),
            _v(F.col("_p_excess"), 3, 11, _msg("{file}, row {row}: {col} has more than 17 decimals.", "unit_price")),
            _v(fin & qi.isNotNull() & pr.isNotNull() & F.col("_total").isNull(), 3, 12,
               _msg("{file}, row {row}: {col} is outside DECIMAL(14,2).", "total_amount")),
        ]
    return checks


def first_row_error(kind: str) -> Column:
    """struct(phase, seq, message) of a prepared row's first violation, or null.

    ``least`` skips nulls and orders structs field by field, so it is the
    smallest violated (phase, seq) without building an array or a lambda.
    """
    return F.least(*row_checks(kind))


def row_violations(rows: DataFrame, kind: str) -> DataFrame:
    """All violations of every row (for reports): file, row, phase, seq, message."""
    arr = F.filter(F.array(*row_checks(kind)), lambda x: x.isNotNull())
    return (prepare(rows, kind).select("file_name", "row_number", F.explode(arr).alias("v"))
            .select("file_name", "row_number", "v.phase", "v.seq", "v.message"))


def _error_key(e: Column) -> Column:
    """Fixed-width order key of a row's first error: phase, row, seq."""
    return F.when(e.isNotNull(),
                  F.shiftleft(e["phase"].cast("long"), 52)
                  + F.shiftleft(F.col("row_number").cast("long"), 12)
                  + e["seq"].cast("long"))


def file_verdicts(contract: DataFrame, rows: DataFrame, kind: str | None = None) -> DataFrame:
    """file_name, data_rows, status (OK/FAILED), error_message.

    One pass over the rows of one kind, or of all kinds with a ``kind``
    column.  Per file the message with the smallest (phase, row, seq) is
    kept by an object hash aggregate, which holds one message a file in
    each task: no sort of the rows and no second pass to rebuild messages.
    """
    kinds = [kind] if kind else list(KINDS)
    error = first_row_error(kinds[0]) if kind else F.coalesce(
        *[F.when(F.col("kind") == k, first_row_error(k)) for k in kinds])
    keyed = (prepare(rows, *kinds).select("file_name", "row_number", error.alias("e"))
             .select("file_name", _error_key(F.col("e")).alias("ekey"), F.col("e")["message"].alias("message")))
    # the set has one element at most; with it Spark takes the object hash aggregate
    first = (keyed.groupBy("file_name")
             .agg(F.min_by("message", "ekey").alias("message"), F.collect_set(F.when(F.col("ekey").isNotNull(), True)).alias("some"))
             .where(F.size("some") > 0).select("file_name", "message"))
    j = contract.join(first, "file_name", "left")
    err = F.coalesce(F.col("contract_error"), F.col("message"))
    return j.select("file_name", "data_rows",
                    F.when(err.isNull(), F.lit("OK")).otherwise(F.lit("FAILED")).alias("status"),
                    err.alias("error_message"))


# Texts of the source project's all-errors date check.
MSG_DATE_MISSING = "{file}, row {row}: {col} is missing."
MSG_DATE_INVALID = "{file}, row {row}: Invalid {col} '{value}'. Expected YYYY-MM-DD."
DATE_CHECK_HEADER = "Date validation failed:\n"


def date_violations(rows: DataFrame, date_col: str) -> DataFrame:
    """P11 as a check: every row whose date is blank or not ``strptime('%Y-%m-%d')``.

    Unlike the per-file verdict this keeps *all* errors (file_name,
    row_number, message), as the source's date check collects them.
    """
    from ..functions.parse import parse_date_lenient
    s_ = strip_all(date_col)
    blank = F.col(date_col).isNull() | (s_ == "")
    msg = (F.when(blank, _msg(MSG_DATE_MISSING, date_col))
           .when(parse_date_lenient(date_col).isNull(), _msg(MSG_DATE_INVALID, date_col, s_)))
    return rows.select("file_name", "row_number", msg.alias("message")).where(F.col("message").isNotNull())


class DateErrors(ValueError):
    """Carries the exact number of errors and the folder with all of them."""

    def __init__(self, total: int, path: str, shown: list[str]):
        self.total, self.path = total, path
        rest = "" if total == len(shown) else f"\n... {total} errors in all, every one of them in {path}"
        super().__init__(DATE_CHECK_HEADER + "\n".join(shown) + rest)


def raise_on_date_errors(violations: DataFrame, shown: int = 1000) -> None:
    """Raise once if there are violations.

    All of them are written to the shared folder; the message holds the
    first ``shown`` lines and, if there are more, the total and the folder.
    """
    from ..session import scratch_path
    spark = violations.sparkSession
    path = scratch_path(spark, "date-errors")
    violations.write.parquet(path)
    found = spark.read.schema(violations.schema).parquet(path)
    total = found.count()
    if total:
        first = found.orderBy("file_name", "row_number").limit(shown)
        raise DateErrors(total, path, [r.message for r in first.collect()])
