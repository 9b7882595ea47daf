"""DuckDB oracle SQL for the file layer and the incremental run.

The landing zone's rows (``sources.bindings.order_file_rows`` /
``customer_file_rows``) are derived again here in SQL; record numbers are
the row order inside each file (+1 for the header), and the per-file
rules, verdicts, the stop-at-first-failure cut, the upserts and the
tracker are all recomputed set-wise.
"""

from __future__ import annotations

from .oracle_sql import (DEC_RE, INT_RE, STRICT_DATE_RE, date_strict, parse_dec, parse_int,
                         strip, with_)

ORDER_COLS = ["order_id", "customer_id", "order_date", "quantity", "unit_price"]
CUSTOMER_COLS = ["customer_id", "customer_name", "city", "email", "created_date"]
Q = "'"


def _hdr(cols):
    return "[" + ", ".join(f"'{c}'" for c in cols) + "]"


def order_files_sql() -> str:
    k = "o_orderkey"
    price = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)"
    uprice = (f"CASE WHEN {k} % 320 = 16 THEN '-' || {price} WHEN {k} % 360 = 18 THEN 'NaN' "
              f"WHEN {k} % 300 = 15 THEN 'Infinity' WHEN {k} % 17 = 3 THEN {price} || '5' ELSE {price} END")
    std = ORDER_COLS
    header = (f"CASE WHEN {k} % 20 = 19 THEN {_hdr(std[:4])} "
              f"WHEN ({k} % 20) % 3 = 1 THEN {_hdr(list(reversed(std)))} "
              f"WHEN ({k} % 20) % 3 = 2 THEN {_hdr(std + ['note'])} ELSE {_hdr(std)} END")
    return f"""
SELECT 'raw/orders/orders_' || lpad(CAST({k} % 20 AS VARCHAR), 2, '0') || '.csv' AS file_name,
       2 AS kind_rank, {k} AS seq, {header} AS header,
       CASE WHEN {k} % 60 = 6 THEN 'O' || CAST({k} - 3 AS VARCHAR)
            WHEN {k} % 280 = 14 THEN 'O' || CAST({k} AS VARCHAR) || repeat('-long', 12)
            ELSE 'O' || CAST({k} AS VARCHAR) END AS order_id,
       CASE WHEN {k} % 260 = 113 THEN '  ' ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN {k} % 140 = 67 THEN '10/9/2026' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
       CASE WHEN {k} % 220 = 11 THEN '2.5' WHEN {k} % 340 = 17 THEN '0' WHEN {k} % 260 = 13 THEN '0'
            WHEN {k} % 60 = 6 THEN CAST({k} % 7 + 10 AS VARCHAR) ELSE CAST({k} % 5 + 1 AS VARCHAR) END AS quantity,
       CASE WHEN {k} % 20 = 19 THEN NULL ELSE {uprice} END AS unit_price
FROM orders"""


def customer_files_sql() -> str:
    k = "c_custkey"
    std = CUSTOMER_COLS
    header = (f"CASE WHEN ({k} % 4) % 2 = 1 THEN {_hdr([std[4], std[0], std[3], std[1], std[2]])} "
              f"ELSE {_hdr(std)} END")
    return f"""
SELECT 'raw/customers/customers_' || lpad(CAST({k} % 4 AS VARCHAR), 2, '0') || '.csv' AS file_name,
       1 AS kind_rank, {k} AS seq, {header} AS header,
       'C' || CAST({k} AS VARCHAR) AS customer_id,
       upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || ', '
           || replace(c_name, '#', ' ') AS customer_name,
       ' ' || n_name || chr(9) AS city,
       'Customer.' || CAST({k} AS VARCHAR) || '@Example.com' AS email,
       CAST(DATE '2026-01-01' + CAST({k} % 365 AS INTEGER) AS VARCHAR) AS created_date
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def file_ctes() -> dict[str, str]:
    return {
        "of": order_files_sql(),
        "cf": customer_files_sql(),
        "ro": "SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY seq) + 1 AS row_number FROM of",
        "rc": "SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY seq) + 1 AS row_number FROM cf",
    }


def _lit(text: str) -> str:
    return Q + text.replace(Q, Q + Q) + Q


def _m(*parts: str) -> str:
    return "file_name || ', row ' || CAST(row_number AS VARCHAR) || " + " || ".join(parts)


def _blank_s(c):
    return f"({c} IS NULL OR {strip(c)} = '')"


def _viol_selects(kind: str) -> list[str]:
    t = "ro" if kind == "orders" else "rc"
    cols = ORDER_COLS if kind == "orders" else CUSTOMER_COLS
    date = "order_date" if kind == "orders" else "created_date"
    out = []

    def sel(ph, seq, msg, cond):
        return (f"SELECT file_name, row_number, {ph} AS phase, {seq} AS seq, {msg} AS message "
                f"FROM {t} WHERE {cond}")

    for i, c in enumerate(cols):
        out.append(sel(1, i, _m(_lit(f": {c} is missing.")), _blank_s(c)))
    ds = strip(date)
    valid = f"(regexp_full_match({ds}, '{STRICT_DATE_RE}') AND try_strptime({ds}, '%Y-%m-%d') IS NOT NULL)"
    out.append(sel(1, 100, _m(_lit(f": invalid {date} '"), ds, _lit("'; expected YYYY-MM-DD.")),
                   f"NOT {_blank_s(date)} AND NOT {valid}"))
    if kind == "orders":
        qs, ps = strip("quantity"), strip("unit_price")
        is_int = f"regexp_full_match({qs}, '{INT_RE}')"
        is_dec = f"regexp_full_match({ps}, '{DEC_RE}')"
        nonfin = f"regexp_full_match(lower({ps}), '[+-]?(inf|infinity|s?nan[0-9]*)')"
        qwide = f"(CASE WHEN {is_int} THEN TRY_CAST(replace({qs}, '_', '') AS DECIMAL(38,0)) END)"
        dec = parse_dec("unit_price")
        qi = parse_int("quantity")
        price = f"TRY_CAST({dec} AS DECIMAL(12,2))"
        op = _lit("[<class 'decimal.InvalidOperation'>]")
        out += [
            sel(2, 0, _m(_lit(": quantity/unit_price must be numeric.")),
                f"NOT ({is_int} AND ({is_dec} OR {nonfin}))"),
            sel(2, 1, _m(_lit(": quantity must be greater than 0.")), f"{qwide} <= 0"),
            sel(2, 2, op, f"regexp_full_match(lower({ps}), '[+-]?s?nan[0-9]*')"),
            sel(2, 2, _m(_lit(": unit_price cannot be negative.")),
                f"({dec} < 0 OR regexp_full_match(lower({ps}), '-(inf|infinity)'))"),
            sel(2, 3, op, f"regexp_full_match(lower({ps}), '\\+?(inf|infinity)')"),
            sel(3, 0, _m(_lit(": order_id is longer than 50 bytes.")), f"strlen({strip('order_id')}) > 50"),
            sel(3, 1, _m(_lit(": customer_id is longer than 50 bytes.")), f"strlen({strip('customer_id')}) > 50"),
            sel(3, 10, _m(_lit(": quantity is outside the INT range.")), f"{is_int} AND {qi} IS NULL"),
            sel(3, 11, _m(_lit(": unit_price is outside DECIMAL(12,2).")), f"{is_dec} AND {price} IS NULL"),
            sel(3, 12, _m(_lit(": total_amount is outside DECIMAL(14,2).")),
                f"{is_dec} AND {qi} IS NOT NULL AND {price} IS NOT NULL AND "
                f"TRY_CAST(round_even({qi} * {dec}, 2) AS DECIMAL(14,2)) IS NULL"),
        ]
    else:
        for i, (c, n) in enumerate([("customer_id", 50), ("customer_name", 150), ("city", 100)]):
            out.append(sel(3, i, _m(_lit(f": {c} is longer than {n} bytes.")), f"strlen({strip(c)}) > {n}"))
        out.append(sel(3, 3, _m(_lit(": email is longer than 200 bytes.")),
                       f"strlen(lower({strip('email')})) > 200"))
    return out


def _repr(lst: str) -> str:
    return f"'[' || array_to_string(list_transform({lst}, lambda x: '''' || x || ''''), ', ') || ']'"


def violation_ctes() -> dict[str, str]:
    c = file_ctes()
    c["viol"] = "\nUNION ALL ".join(_viol_selects("customers") + _viol_selects("orders"))
    req = {"orders": _hdr(ORDER_COLS), "customers": _hdr(CUSTOMER_COLS)}
    parts = [f"SELECT file_name, count(*) AS data_rows, "
             f"list_sort(list_filter({req[kind]}, lambda x: NOT list_contains(first(header), x))) AS missing "
             f"FROM {t} GROUP BY file_name" for t, kind in (("ro", "orders"), ("rc", "customers"))]
    c["contract0"] = "\nUNION ALL ".join(parts)
    c["contract"] = f"""
SELECT file_name, CAST(data_rows AS BIGINT) AS data_rows, {_repr('missing')} AS missing_columns,
       CASE WHEN data_rows = 0 THEN file_name || ' contains no data rows.'
            WHEN len(missing) > 0 THEN file_name || ' is missing required columns: ' || {_repr('missing')}
       END AS contract_error
FROM contract0"""
    c["first_err"] = """
SELECT file_name, message FROM (
  SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY phase, row_number, seq) AS rn FROM viol)
WHERE rn = 1"""
    c["verdicts"] = """
SELECT c.file_name, c.data_rows, coalesce(c.contract_error, f.message) AS error_message
FROM contract c LEFT JOIN first_err f USING (file_name)"""
    return c


def required_inputs() -> str:
    return with_(file_ctes(), """
SELECT r.check_order, r.file_name,
       CASE WHEN r.file_name IN (SELECT file_name FROM of UNION SELECT file_name FROM cf) THEN 1 ELSE 0 END AS present,
       'Required input file not found: raw/orders/orders.csv' AS check_error
FROM (VALUES (1, 'raw/customers/customers_00.csv'), (2, 'raw/orders/orders_00.csv'),
             (3, 'raw/orders/orders.csv')) r(check_order, file_name)""")


def _listing_ctes() -> dict[str, str]:
    c = violation_ctes()
    c["files"] = ("SELECT DISTINCT file_name, kind_rank FROM "
                  "(SELECT file_name, kind_rank FROM of UNION ALL SELECT file_name, kind_rank FROM cf)")
    c["lst"] = ("SELECT file_name, CASE WHEN kind_rank = 1 THEN 'customers' ELSE 'orders' END AS kind, "
                "row_number() OVER (ORDER BY kind_rank, file_name) AS ordinal FROM files")
    return c


def list_inputs() -> str:
    return with_(_listing_ctes(), "SELECT file_name, kind, ordinal FROM lst")


def scan_by_name() -> str:
    return with_(file_ctes(), "SELECT file_name, row_number, order_id, customer_id, order_date, "
                              "quantity, unit_price FROM ro")


def scan_customers() -> str:
    return with_(file_ctes(), "SELECT file_name, row_number, customer_id, customer_name, city, email, "
                              "created_date FROM rc")


def scan_quoted() -> str:
    return """
WITH n AS (
  SELECT o_orderkey AS k, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
         'raw/notes/notes_' || lpad(CAST(o_orderkey // 20000 AS VARCHAR), 6, '0') || '.csv' AS file_name
  FROM orders)
SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY k) + 1 AS row_number,
       'O' || CAST(k AS VARCHAR) AS order_id, 'C' || CAST(o_custkey AS VARCHAR) AS customer_id,
       CASE k % 5 WHEN 0 THEN 'called "again"' || chr(10) || chr(10) || 'on ' || day || ', no "answer"'
                  WHEN 1 THEN chr(10) || CAST(k AS VARCHAR) || ',' || chr(10)
                  WHEN 2 THEN 'plain ' || day
                  WHEN 3 THEN '"x",' || chr(10) || '"y' || repeat('"' || chr(10), k % 4)
                  ELSE '' END AS note
FROM n"""


def row_numbers() -> str:
    return with_(file_ctes(), "SELECT file_name, order_id, row_number FROM ro")


def date_violations() -> str:
    from .oracle_sql import date_lenient
    ds = strip("order_date")
    return with_(file_ctes(), f"""
SELECT file_name, row_number,
       CASE WHEN order_date IS NULL OR {ds} = '' THEN {_m(_lit(': order_date is missing.'))}
            ELSE {_m(_lit(": Invalid order_date '"), ds, _lit("'. Expected YYYY-MM-DD."))} END AS message
FROM ro WHERE order_date IS NULL OR {ds} = '' OR {date_lenient('order_date')} IS NULL""")


def file_contract() -> str:
    return with_(violation_ctes(), "SELECT file_name, data_rows, missing_columns, contract_error FROM contract")


def file_violations() -> str:
    return with_(violation_ctes(), "SELECT file_name, row_number, phase, seq, message FROM viol")


def file_verdicts() -> str:
    return with_(violation_ctes(), """
SELECT file_name, data_rows, CASE WHEN error_message IS NULL THEN 'OK' ELSE 'FAILED' END AS status, error_message
FROM verdicts""")


def _run_ctes() -> dict[str, str]:
    c = _listing_ctes()
    c["seed"] = ("SELECT * FROM (VALUES ('raw/customers/customers_01.csv', 'SUCCESS', CAST(NULL AS VARCHAR)), "
                 "('raw/orders/orders_02.csv', 'SUCCESS', NULL), "
                 "('raw/orders/orders_04.csv', 'FAILED', 'earlier failure')) s(file_name, status, error_message)")
    c["pl"] = """
SELECT l.*, s.status AS prev_status, CASE WHEN s.status = 'SUCCESS' THEN 'SKIP' ELSE 'PROCESS' END AS action
FROM lst l LEFT JOIN seed s USING (file_name)"""
    c["d0"] = """
SELECT pl.*, v.data_rows, v.error_message AS verr,
       CASE WHEN action = 'SKIP' THEN 'SKIPPED' WHEN v.error_message IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS st
FROM pl LEFT JOIN verdicts v USING (file_name)"""
    c["cut"] = "SELECT min(ordinal) AS c FROM d0 WHERE st = 'FAILED'"
    c["d"] = """
SELECT file_name, kind, ordinal, prev_status,
       CASE WHEN cut.c IS NOT NULL AND ordinal > cut.c THEN 'UNTOUCHED' ELSE st END AS status,
       CASE WHEN (cut.c IS NULL OR ordinal <= cut.c) AND st = 'SUCCESS' THEN CAST(data_rows AS BIGINT)
            ELSE CAST(0 AS BIGINT) END AS record_count,
       CASE WHEN (cut.c IS NULL OR ordinal <= cut.c) AND st = 'FAILED' THEN verr END AS error_message
FROM d0, cut"""
    q, p = parse_int("quantity"), parse_dec("unit_price")
    c["ok_o"] = f"""
SELECT {strip('order_id')} AS order_id, {strip('customer_id')} AS customer_id,
       {date_strict('order_date')} AS order_date, {q} AS quantity,
       TRY_CAST({p} AS DECIMAL(12,2)) AS unit_price,
       TRY_CAST(round_even({q} * {p}, 2) AS DECIMAL(14,2)) AS total_amount,
       d.ordinal, ro.row_number
FROM ro JOIN d USING (file_name) WHERE d.status = 'SUCCESS'"""
    c["ok_c"] = f"""
SELECT {strip('customer_id')} AS customer_id, {strip('customer_name')} AS customer_name, {strip('city')} AS city,
       lower({strip('email')}) AS email, {date_strict('created_date')} AS created_date, d.ordinal, rc.row_number
FROM rc JOIN d USING (file_name) WHERE d.status = 'SUCCESS'"""
    c["tracker"] = """
SELECT file_name, status, record_count, error_message FROM d WHERE status IN ('SUCCESS', 'FAILED')
UNION ALL
SELECT s.file_name, s.status, CAST(0 AS BIGINT), s.error_message FROM seed s
WHERE s.file_name NOT IN (SELECT file_name FROM d WHERE status IN ('SUCCESS', 'FAILED'))"""
    return c


def file_plan() -> str:
    return with_(_run_ctes(), "SELECT file_name, ordinal, prev_status, status, record_count, error_message FROM d")


def incremental_run() -> str:
    return with_(_run_ctes(), "SELECT file_name, status, record_count, error_message FROM d "
                              "WHERE status <> 'UNTOUCHED'")


def _continue_ctes() -> dict[str, str]:
    c = _run_ctes()
    c["d"] = """
SELECT file_name, kind, ordinal, prev_status, st AS status,
       CASE WHEN st = 'SUCCESS' THEN CAST(data_rows AS BIGINT) ELSE CAST(0 AS BIGINT) END AS record_count,
       CASE WHEN st = 'FAILED' THEN verr END AS error_message
FROM d0"""
    return c


def incremental_continue() -> str:
    return with_(_continue_ctes(), "SELECT file_name, status, record_count, error_message FROM d")


def upsert_continue() -> str:
    return with_(_continue_ctes(), LATEST_ORDERS)


def run_summary() -> str:
    return with_(_run_ctes(), """
SELECT count(*) FILTER (WHERE status = 'SUCCESS') AS processed_files,
       count(*) FILTER (WHERE status = 'SKIPPED') AS skipped_files,
       count(*) FILTER (WHERE status = 'FAILED') AS failed_files
FROM d WHERE status <> 'UNTOUCHED'""")


def _latest(table: str, key: str, cols: list[str]) -> str:
    picks = ", ".join(f"arg_max({c}, (ordinal, row_number)) AS {c}" for c in cols)
    return f"SELECT {key}, {picks} FROM {table} GROUP BY {key}"


LATEST_ORDERS = _latest("ok_o", "order_id", ["customer_id", "order_date", "quantity", "unit_price", "total_amount"])
LATEST_CUSTOMERS = _latest("ok_c", "customer_id", ["customer_name", "city", "email", "created_date"])


def upsert_latest() -> str:
    return with_(_run_ctes(), LATEST_ORDERS)


def upsert_compacted() -> str:
    return upsert_latest()


def upsert_customers() -> str:
    return with_(_run_ctes(), LATEST_CUSTOMERS)


def tracker_history() -> str:
    return with_(_run_ctes(), "SELECT file_name, status, record_count, error_message FROM tracker")


def files_per_status() -> str:
    return with_(_run_ctes(), "SELECT status, count(*) AS file_count FROM tracker GROUP BY status")


def incremental_counts() -> str:
    c = _run_ctes()
    c["lo"] = LATEST_ORDERS
    c["lc"] = LATEST_CUSTOMERS
    return with_(c, """
SELECT (SELECT count(*) FROM lc) AS customer_count, (SELECT count(*) FROM lo) AS order_count,
       (SELECT CAST(sum(total_amount) AS DECIMAL(38,2)) FROM lo) AS order_total""")


def order_totals_listing() -> str:
    c = _run_ctes()
    c["lo"] = LATEST_ORDERS
    return with_(c, "SELECT order_id, quantity, unit_price, total_amount FROM lo ORDER BY order_id")


def stream_ingest() -> str:
    return tracker_history()


def full_refresh() -> str:
    from .oracle_sql import model_ctes
    return with_(model_ctes(), """
SELECT f.order_id, d.customer_key, f.customer_id, d.customer_name, d.city, f.order_date,
       f.quantity, f.unit_price, f.total_amount
FROM fact f JOIN dim d ON f.customer_id = d.customer_id""")


ORACLES = {f.__name__: f for f in (stream_ingest, full_refresh, upsert_compacted, date_violations,
    required_inputs, list_inputs, scan_by_name, scan_customers, scan_quoted, row_numbers, file_contract,
    file_violations, file_verdicts, file_plan, incremental_run, incremental_continue, upsert_continue, run_summary, upsert_latest,
    upsert_customers, tracker_history, files_per_status, incremental_counts,
    order_totals_listing)}
