"""DuckDB SQL for the correctness oracle.

Each query in ``__spark_entry__.queries()`` has an independent SQL twin
here, run by DuckDB over the same Parquet tables.  The raw-data bindings
are spelled out again in SQL (see ``sources.bindings``) so that the two
engines derive their inputs separately.
"""

from __future__ import annotations

from .functions.clean import PY_WHITESPACE_CLASS_RE2 as WS

NL = "chr(10)"
TAB = "chr(9)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def initcap(x: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(lower(" + x + "), "
            "'[A-Za-z0-9]+|[^A-Za-z0-9]+'), lambda t: CASE WHEN regexp_matches(t, '^[A-Za-z0-9]') "
            "THEN upper(t[1]) || t[2:] ELSE t END), '')")


def clean_text(x: str) -> str:
    return initcap(f"regexp_replace(trim({x}, ' '), '[[:space:]]+', ' ', 'g')")


INT_RE = "[+-]?[0-9]+(_[0-9]+)*"
_DIG = "[0-9]+(_[0-9]+)*"
DEC_RE = f"[+-]?({_DIG}(\\.({_DIG})?)?|\\.{_DIG})([eE][+-]?{_DIG})?"
STRICT_DATE_RE = "[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}"
LENIENT_DATE_RE = "([0-9]{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"


def parse_int(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN regexp_full_match({s}, '{INT_RE}') THEN TRY_CAST(replace({s}, '_', '') AS INTEGER) END)"


def parse_dec(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN regexp_full_match({s}, '{DEC_RE}') "
            f"THEN TRY_CAST(replace({s}, '_', '') AS DECIMAL(27,17)) END)")


def date_strict(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN regexp_full_match({s}, '{STRICT_DATE_RE}') "
            f"THEN CAST(try_strptime({s}, '%Y-%m-%d') AS DATE) END)")


def date_lenient(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN regexp_full_match({s}, '{LENIENT_DATE_RE}') AND substr({s}, 1, 4) <> '0000' "
            f"THEN CAST(try_strptime(replace({s}, ' ', ''), '%Y-%m-%d') AS DATE) END)")


def date_loose(x: str) -> str:
    return f"coalesce({date_strict(x)}, {date_lenient(x)})"


def with_(ctes: dict[str, str], final: str) -> str:
    body = ",\n".join(f"{k} AS (\n{v}\n)" for k, v in ctes.items())
    return f"WITH {body}\n{final}"


# ---------------------------------------------------------------- bindings

def raw_customers_sql(messy: bool = False) -> str:
    k = "c_custkey"
    seg = "lower(c_mktsegment)"
    nat = "lower(n_name)"
    ks = f"CAST({k} AS VARCHAR)"
    cid = f"'C' || {ks}"
    name = f"{seg} || '  ' || replace(lower(c_name), '#', ' ')"
    city = "n_name"
    email = f"' Customer.' || {ks} || '@Example.com '"
    created = f"CAST(DATE '2026-01-01' + CAST({k} % 365 AS INTEGER) AS VARCHAR)"
    if messy:
        cid = (f"CASE WHEN {k} % 97 = 5 THEN '  ' || {cid} || ' ' "
               f"WHEN {k} % 97 = 7 THEN {TAB} || {cid} "
               f"WHEN {k} % 97 = 9 THEN chr(160) || {cid} || chr(31) ELSE {cid} END")
        name = (f"CASE WHEN {k} % 35 = 5 THEN NULL WHEN {k} % 35 = 6 THEN '   ' "
                f"WHEN {k} % 997 = 3 THEN repeat('household ', 16) "
                f"WHEN {k} % 7 = 0 THEN '  ' || {seg} || '   ' || {nat} || '  ' "
                f"WHEN {k} % 7 = 1 THEN upper({seg}) || {TAB} || {TAB} || 'o''' || {nat} "
                f"WHEN {k} % 7 = 2 THEN {seg} || '-' || upper({nat}) || ' ' || {ks} || 'th' "
                f"WHEN {k} % 7 = 3 THEN {TAB} || {seg} || ' mc' || {nat} "
                f"WHEN {k} % 7 = 4 THEN {seg} || {NL} || {nat} "
                f"ELSE {name} END")
        city = (f"CASE WHEN {k} % 3 = 0 THEN replace({nat}, '_', '  ') "
                f"WHEN {k} % 3 = 1 THEN ' ' || upper(n_name) || ' ' ELSE n_name END")
        email = (f"CASE WHEN {k} % 11 = 0 THEN NULL WHEN {k} % 11 = 1 THEN 'bad@' "
                 f"WHEN {k} % 11 = 2 THEN 'a@b.c' "
                 f"WHEN {k} % 11 = 3 THEN 'customer.' || {ks} || '@example.com' || {NL} "
                 f"WHEN {k} % 11 = 4 THEN 'customer.' || {ks} || '@example.com.' "
                 f"ELSE {email} END")
        created = (f"CASE WHEN {k} % 13 = 0 THEN NULL WHEN {k} % 13 = 1 THEN '2026-02-30' "
                   f"WHEN {k} % 13 = 2 THEN '2026-9-1' WHEN {k} % 13 = 3 THEN '10/9/2026' "
                   f"ELSE {created} END")
    base = (f"SELECT {cid} AS customer_id, {name} AS customer_name, {city} AS city, "
            f"{email} AS email, {created} AS created_date, {k} AS _key "
            f"FROM customer JOIN nation ON c_nationkey = n_nationkey")
    cols = "customer_id, customer_name, city, email, created_date"
    if messy:
        return (f"SELECT {cols} FROM ({base}) UNION ALL "
                f"SELECT {cols} FROM ({base}) WHERE _key % 89 = 0")
    return f"SELECT {cols} FROM ({base})"


def raw_orders_sql(messy: bool = False) -> str:
    k = "o_orderkey"
    oid = f"'O' || CAST({k} AS VARCHAR)"
    cid = "'C' || CAST(o_custkey AS VARCHAR)"
    odate = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
    qty = f"CAST({k} % 5 + 1 AS VARCHAR)"
    base_price = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)"
    price = f"CASE WHEN {k} % 17 = 3 THEN {base_price} || '5' ELSE {base_price} END"
    if messy:
        oid = (f"CASE WHEN {k} % 701 = 0 THEN ' ' || {oid} "
               f"WHEN {k} % 1009 = 0 THEN {oid} || repeat('-x', 30) ELSE {oid} END")
        cid = (f"CASE WHEN {k} % 211 = 0 THEN 'C' || CAST(o_custkey + 1000000000 AS VARCHAR) "
               f"WHEN {k} % 701 = 1 THEN ' ' || {cid} ELSE {cid} END")
        odate = (f"CASE WHEN {k} % 313 = 0 THEN NULL WHEN {k} % 317 = 0 THEN '2026-13-01' "
                 f"ELSE {odate} END")
        qty = (f"CASE WHEN {k} % 607 = 0 THEN '0' WHEN {k} % 809 = 0 THEN '99999999999' "
               f"WHEN {k} % 1019 = 0 THEN '2000000000' ELSE {qty} END")
        price = (f"CASE WHEN {k} % 389 = 0 THEN '-' || {base_price} "
                 f"WHEN {k} % 919 = 0 THEN 'abc' WHEN {k} % 1013 = 0 THEN '12345678901.5' "
                 f"ELSE {price} END")
    base = (f"SELECT {oid} AS order_id, {cid} AS customer_id, {odate} AS order_date, "
            f"{qty} AS quantity, {price} AS unit_price, {k} AS _key FROM orders")
    cols = "order_id, customer_id, order_date, quantity, unit_price"
    if messy:
        return (f"SELECT {cols} FROM ({base}) UNION ALL "
                f"SELECT {cols} FROM ({base}) WHERE _key % 503 = 0")
    return f"SELECT {cols} FROM ({base})"


def stg_customers_sql(raw: str) -> str:
    return (f"SELECT customer_id, customer_name, city, email, "
            f"{date_loose('created_date')} AS created_date FROM {raw}")


def stg_orders_sql(raw: str, keep_raw: bool = False) -> str:
    extra = ", quantity AS quantity_text, unit_price AS unit_price_text" if keep_raw else ""
    return (f"SELECT order_id, customer_id, {date_loose('order_date')} AS order_date, "
            f"{parse_int('quantity')} AS quantity, "
            f"TRY_CAST({parse_dec('unit_price')} AS DECIMAL(12,2)) AS unit_price{extra} FROM {raw}")


def tr_customers_sql(stg: str) -> str:
    return (f"SELECT trim(customer_id, ' ') AS customer_id, {clean_text('customer_name')} AS customer_name, "
            f"{clean_text('city')} AS city, lower(trim(email, ' ')) AS email, created_date FROM {stg}")


def tr_orders_sql(stg: str, keep_raw: bool = False) -> str:
    extra = ", quantity_text, unit_price_text" if keep_raw else ""
    return (f"SELECT order_id, customer_id, order_date, quantity, unit_price, "
            f"TRY_CAST(quantity * unit_price AS DECIMAL(14,2)) AS total_amount{extra} FROM {stg}")


def dim_sql(tr: str) -> str:
    return (f"SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST) AS BIGINT) AS customer_key, "
            f"customer_id, customer_name, city, email, created_date FROM {tr}")


def model_ctes(messy: bool = False, keep_raw: bool = False) -> dict[str, str]:
    """raw -> staging -> transformed -> dim/fact, as CTEs."""
    return {
        "raw_c": raw_customers_sql(messy),
        "raw_o": raw_orders_sql(messy),
        "stg_c": stg_customers_sql("raw_c"),
        "stg_o": stg_orders_sql("raw_o", keep_raw),
        "tr_c": tr_customers_sql("stg_c"),
        "tr_o": tr_orders_sql("stg_o", keep_raw),
        "dim": dim_sql("tr_c"),
        "fact": "SELECT order_id, customer_id, order_date, quantity, unit_price, total_amount FROM tr_o",
    }


# ---------------------------------------------------------------- queries

def monthly_sales() -> str:
    return with_(model_ctes(), """
SELECT strftime(order_date, '%Y-%m') AS sales_month, count(*) AS total_orders,
       CAST(sum(total_amount) AS DECIMAL(38,2)) AS total_sales
FROM fact GROUP BY 1""")


def sales_by_city() -> str:
    return with_(model_ctes(), """
SELECT d.city, count(f.order_id) AS total_orders, CAST(sum(f.total_amount) AS DECIMAL(38,2)) AS total_sales
FROM fact f JOIN dim d ON f.customer_id = d.customer_id GROUP BY d.city""")


def sales_by_customer() -> str:
    return with_(model_ctes(), """
SELECT d.customer_id, d.customer_name, count(f.order_id) AS total_orders,
       CAST(sum(f.total_amount) AS DECIMAL(38,2)) AS total_sales
FROM fact f JOIN dim d ON f.customer_id = d.customer_id GROUP BY d.customer_id, d.customer_name""")


EMAIL_RE = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$"


def messy_model() -> dict[str, str]:
    return model_ctes(messy=True)


def clean_customers() -> str:
    return with_(messy_model(), "SELECT customer_id, customer_name, city, email FROM tr_c")


def strip_fields() -> str:
    cols = ["customer_id", "customer_name", "city", "email", "created_date"]
    sel = ", ".join(f"{strip(c)} AS {c}" for c in cols)
    blank = " OR ".join(f"({c} IS NULL OR {strip(c)} = '')" for c in cols)
    return with_({"raw_c": raw_customers_sql(True)},
                 f"SELECT {sel}, CAST(({blank}) AS INTEGER) AS has_blank FROM raw_c")


def invalid_emails() -> str:
    return with_(messy_model(), f"""
SELECT customer_id, email FROM tr_c
WHERE email IS NULL OR NOT regexp_matches(email, '{EMAIL_RE}')""")


def order_totals_refresh() -> str:
    return with_(messy_model(), "SELECT order_id, quantity, unit_price, total_amount FROM tr_o")


def order_totals_incremental() -> str:
    q, p = parse_int("quantity"), parse_dec("unit_price")
    # half-even on the exact product, as a whole number of 1e-17 (no float, no earlier rounding)
    return with_({
        "raw_o": raw_orders_sql(False),
        "probe": """
SELECT order_id, quantity, CASE CAST(substr(order_id, 2) AS BIGINT) % 29
    WHEN 7 THEN '0.01499999999999999' WHEN 11 THEN '0.00500000000001'
    WHEN 13 THEN unit_price || '500000000000001' WHEN 17 THEN unit_price || '500000000'
    ELSE unit_price END AS unit_price FROM raw_o""",
        "typed": f"SELECT order_id, {q} AS quantity, {p} AS price FROM probe",
        "whole": """
SELECT *, CAST(quantity AS HUGEINT) * CAST(replace(CAST(price AS VARCHAR), '.', '') AS HUGEINT) AS units FROM typed""",
        "cut": "SELECT *, units // 1000000000000000 AS cents, abs(units % 1000000000000000) AS rest FROM whole"}, """
SELECT order_id, quantity, TRY_CAST(price AS DECIMAL(12,2)) AS unit_price,
       TRY_CAST(CAST(cents + CASE WHEN rest > 500000000000000 OR (rest = 500000000000000 AND cents % 2 <> 0)
                             THEN sign(units) ELSE 0 END AS DECIMAL(20,0)) / 100 AS DECIMAL(14,2)) AS total_amount
FROM cut""")


# The parser probe texts, by order key mod 12 (as in the catalog).
NUMBER_TEXTS_SQL = ["' 4 '", "'+4'", "'4.0'", "'1_000'", "'1e3'", "'NaN'", "'.5'", "'-3'",
                    "'12abc'", "chr(9) || '7' || chr(160)", "'99999999999'"]


def parse_numbers() -> str:
    cases = " ".join(f"WHEN o_orderkey % 12 = {i} THEN {t}" for i, t in enumerate(NUMBER_TEXTS_SQL))
    text = (f"CASE {cases} ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || '5' END")
    t = "number_text"
    return with_({"n": f"SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id, {text} AS number_text FROM orders"},
                 f"""
SELECT order_id, number_text, {parse_int(t)} AS int_value,
       CAST(regexp_full_match({strip(t)}, '{INT_RE}') AS INTEGER) AS is_int,
       {parse_dec(t)} AS decimal_value,
       CAST(regexp_full_match({strip(t)}, '{DEC_RE}') AS INTEGER) AS is_decimal,
       CAST(regexp_full_match(lower({strip(t)}), '[+-]?(inf|infinity|s?nan[0-9]*)') AS INTEGER) AS is_non_finite
FROM n""")


def _date_texts() -> str:
    d = "CAST(o_orderdate AS DATE)"
    iso = f"CAST({d} AS VARCHAR)"
    y, m, day = (f"CAST(year({d}) AS VARCHAR)", f"CAST(month({d}) AS VARCHAR)",
                 f"CAST(day({d}) AS VARCHAR)")
    k = "o_orderkey % 10"
    return (f"SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id, CASE "
            f"WHEN {k} = 0 THEN {iso} WHEN {k} = 1 THEN {y} || '-' || {m} || '-' || {day} "
            f"WHEN {k} = 2 THEN '2026-02-30' WHEN {k} = 3 THEN strftime({d}, '%d/%m/%Y') "
            f"WHEN {k} = 4 THEN ' ' || {iso} || chr(9) WHEN {k} = 5 THEN '0999-01-01' "
            f"WHEN {k} = 6 THEN {iso} || 'T00:00' "
            f"WHEN {k} = 7 THEN {y} || '-' || lpad({m}, 2, '0') || '- ' || {day} "
            f"WHEN {k} = 8 THEN '' END AS date_text FROM orders")


def parse_dates_strict() -> str:
    p = date_strict("date_text")
    return with_({"t": _date_texts()},
                 f"SELECT order_id, date_text, {p} AS parsed_date, CAST({p} IS NOT NULL AS INTEGER) AS is_valid FROM t")


def parse_dates_lenient() -> str:
    p = date_lenient("date_text")
    return with_({"t": _date_texts()},
                 f"SELECT order_id, date_text, {p} AS parsed_date, CAST({p} IS NOT NULL AS INTEGER) AS is_valid FROM t")


def dim_customer() -> str:
    return with_(messy_model(), "SELECT * FROM dim")


def surrogate_key_listing() -> str:
    return with_(messy_model(), """
SELECT customer_key AS surrogate_key, customer_id AS source_business_key, customer_name, city, email
FROM dim""")


def surrogate_key_audit() -> str:
    return with_(messy_model(), """
SELECT count(*) AS total_customers, count(customer_key) AS customers_with_surrogate_keys,
       count(DISTINCT customer_key) AS unique_surrogate_keys FROM dim""")


def fact_order() -> str:
    return with_(messy_model(), "SELECT * FROM fact")


def table_counts() -> str:
    return with_(messy_model(), """
SELECT 'stg_customers' AS table_name, count(*) AS row_count FROM stg_c
UNION ALL SELECT 'stg_orders', count(*) FROM stg_o
UNION ALL SELECT 'dim_customer', count(*) FROM dim
UNION ALL SELECT 'fact_order', count(*) FROM fact""")


def describe_tables() -> str:
    # The declared column types of the two target tables.
    rows = [("dim_customer", "customer_key", "bigint"), ("dim_customer", "customer_id", "string"),
            ("dim_customer", "customer_name", "string"), ("dim_customer", "city", "string"),
            ("dim_customer", "email", "string"), ("dim_customer", "created_date", "date"),
            ("fact_order", "order_id", "string"), ("fact_order", "customer_id", "string"),
            ("fact_order", "order_date", "date"), ("fact_order", "quantity", "int"),
            ("fact_order", "unit_price", "decimal(12,2)"), ("fact_order", "total_amount", "decimal(14,2)")]
    source = {"dim_customer": "tr_c", "fact_order": "tr_o"}
    return with_(messy_model(), " UNION ALL ".join(
        f"SELECT '{a}' AS table_name, '{b}' AS col_name, '{c}' AS data_type, "
        f"count({'*' if b == 'customer_key' else b}) AS filled FROM {source[a]}" for a, b, c in rows))


def preview_customers() -> str:
    return with_(messy_model(), """
SELECT customer_id, customer_name, city, email FROM dim
ORDER BY customer_id NULLS FIRST, customer_id NULLS FIRST, customer_name NULLS FIRST,
         city NULLS FIRST, email NULLS FIRST LIMIT 10""")


def preview_orders() -> str:
    return with_(messy_model(), """
SELECT order_id, customer_id, quantity, unit_price, total_amount FROM tr_o
ORDER BY order_id NULLS FIRST, order_id NULLS FIRST, customer_id NULLS FIRST, quantity NULLS FIRST,
         unit_price NULLS FIRST, total_amount NULLS FIRST LIMIT 10""")


def candidate_ctes() -> dict[str, str]:
    c = model_ctes(messy=True, keep_raw=True)
    c["cust"] = "SELECT * FROM dim"
    c["ord"] = ("SELECT order_id, customer_id, order_date, quantity, unit_price, "
                "CASE WHEN TRY_CAST(substr(trim(order_id, ' '), 2) AS BIGINT) % 401 = 0 "
                "THEN TRY_CAST(total_amount + 0.01 AS DECIMAL(14,2)) ELSE total_amount END AS total_amount, "
                "quantity_text, unit_price_text FROM tr_o")
    return c


def _blank(c):
    return f"({c} IS NULL OR trim({c}, ' ') = '')"


def dq_rules_sql() -> list[tuple[int, str, str, str, str]]:
    """(seq, id, name, violations SQL, message template)."""
    cnt = "SELECT count(*) FROM"
    return [
        (1, "D1", "customer table not empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM cust",
         "Customer target table contains no records."),
        (2, "D2", "order table not empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM ord",
         "Order target table contains no records."),
        (3, "D3", "customer mandatory fields",
         f"{cnt} cust WHERE {_blank('customer_id')} OR {_blank('customer_name')} OR {_blank('city')} "
         f"OR {_blank('email')} OR created_date IS NULL",
         "%d customer records have missing mandatory values."),
        (4, "D4", "order mandatory fields",
         f"{cnt} ord WHERE {_blank('order_id')} OR {_blank('customer_id')} OR order_date IS NULL "
         f"OR quantity IS NULL OR unit_price IS NULL OR total_amount IS NULL",
         "%d order records have missing mandatory values."),
        (5, "D5", "duplicate customer ids",
         f"{cnt} (SELECT customer_id FROM cust GROUP BY customer_id HAVING count(*) > 1)",
         "Found %d duplicate customer IDs."),
        (6, "D6", "duplicate order ids",
         f"{cnt} (SELECT order_id FROM ord GROUP BY order_id HAVING count(*) > 1)",
         "Found %d duplicate order IDs."),
        (7, "D7", "quantity > 0", f"{cnt} ord WHERE quantity <= 0", "Found %d orders with quantity <= 0."),
        (8, "D8", "unit price >= 0", f"{cnt} ord WHERE unit_price < 0",
         "Found %d orders with negative unit price."),
        (9, "D9", "customer date present", f"{cnt} cust WHERE created_date IS NULL",
         "Found %d customers with missing created_date."),
        (10, "D10", "order date present", f"{cnt} ord WHERE order_date IS NULL",
         "Found %d orders with missing order_date."),
        (11, "D11", "orders reference customers",
         f"{cnt} ord o LEFT JOIN cust c ON trim(o.customer_id, ' ') = trim(c.customer_id, ' ') WHERE c.customer_id IS NULL",
         "Found %d orders referencing missing customers."),
        (12, "D12", "total = quantity x price", f"{cnt} ord WHERE total_amount <> quantity * unit_price",
         "Found %d incorrect total_amount values."),
        (13, "D13", "e-mail format",
         f"{cnt} cust WHERE email IS NULL OR NOT regexp_matches(email, '{EMAIL_RE}')",
         "Found %d customers with invalid email format."),
        (14, "D17a", "customer text within VARCHAR limits",
         f"{cnt} cust WHERE strlen(customer_id) > 50 OR strlen(customer_name) > 150 "
         f"OR strlen(city) > 100 OR strlen(email) > 200",
         "Found %d customers with text longer than its column."),
        (15, "D17b", "order text within VARCHAR limits",
         f"{cnt} ord WHERE strlen(order_id) > 50 OR strlen(customer_id) > 50",
         "Found %d orders with text longer than its column."),
        (16, "D17c", "quantity within INT",
         f"{cnt} ord WHERE regexp_full_match({strip('quantity_text')}, '{INT_RE}') AND quantity IS NULL",
         "Found %d orders with quantity outside the INT range."),
        (17, "D17d", "unit price within DECIMAL(12,2)",
         f"{cnt} ord WHERE regexp_full_match({strip('unit_price_text')}, '{DEC_RE}') AND unit_price IS NULL",
         "Found %d orders with unit_price outside DECIMAL(12,2)."),
        (18, "D17e", "total within DECIMAL(14,2)",
         f"{cnt} ord WHERE quantity IS NOT NULL AND unit_price IS NOT NULL AND total_amount IS NULL",
         "Found %d orders with total_amount outside DECIMAL(14,2)."),
    ]


def _report_select() -> str:
    parts = []
    for seq, rid, name, vsql, msg in dq_rules_sql():
        v = f"CAST(({vsql}) AS BIGINT)"
        m = f"'{msg}'" if "%d" not in msg else f"printf('{msg}', {v})"
        parts.append(f"SELECT {seq} AS rule_seq, '{rid}' AS rule_id, '{name}' AS rule_name, "
                     f"{v} AS violations, CASE WHEN {v} > 0 THEN {m} END AS message")
    return "\nUNION ALL ".join(parts)


def dq_report() -> str:
    return with_(candidate_ctes(), _report_select())


def dq_verdict() -> str:
    c = candidate_ctes()
    c["report"] = _report_select()
    return with_(c, """
SELECT CAST(count(*) FILTER (WHERE violations > 0) = 0 AS INTEGER) AS passed,
       count(*) FILTER (WHERE violations > 0) AS failed_rules,
       CASE WHEN count(message) > 0 THEN 'Task 1 validation failed:' || chr(10) || '- '
            || string_agg(message, chr(10) || '- ' ORDER BY rule_seq) END AS error_message
FROM report""")


def orphan_orders() -> str:
    return with_(candidate_ctes(), """
SELECT o.order_id, o.customer_id FROM ord o
LEFT JOIN (SELECT DISTINCT trim(customer_id, ' ') AS k FROM cust) c ON trim(o.customer_id, ' ') = c.k
WHERE c.k IS NULL""")


def duplicate_keys() -> str:
    return with_(candidate_ctes(), """
SELECT 'customers' AS table_name, customer_id AS key_value, count(*) AS copies
FROM cust GROUP BY customer_id HAVING count(*) > 1
UNION ALL
SELECT 'orders', order_id, count(*) FROM ord GROUP BY order_id HAVING count(*) > 1""")


ORACLES = {
    "monthly_sales": monthly_sales,
    "sales_by_city": sales_by_city,
    "sales_by_customer": sales_by_customer,
    "clean_customers": clean_customers,
    "strip_fields": strip_fields,
    "invalid_emails": invalid_emails,
    "order_totals_refresh": order_totals_refresh,
    "order_totals_incremental": order_totals_incremental,
    "parse_numbers": parse_numbers,
    "parse_dates_strict": parse_dates_strict,
    "parse_dates_lenient": parse_dates_lenient,
    "dim_customer": dim_customer,
    "surrogate_key_listing": surrogate_key_listing,
    "surrogate_key_audit": surrogate_key_audit,
    "fact_order": fact_order,
    "table_counts": table_counts,
    "describe_tables": describe_tables,
    "preview_customers": preview_customers,
    "preview_orders": preview_orders,
    "dq_report": dq_report,
    "dq_verdict": dq_verdict,
    "orphan_orders": orphan_orders,
    "duplicate_keys": duplicate_keys,
}


def all_sql() -> dict[str, str]:
    from .oracle_files import ORACLES as FILE_ORACLES
    return {k: f() for k, f in {**ORACLES, **FILE_ORACLES}.items()}
