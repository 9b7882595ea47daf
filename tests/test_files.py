"""File layer: listing, by-name scan, record numbers, contract, per-file verdicts.

Expected values come from Python's csv module run over the same files
(the source project reads its files with ``csv.DictReader``).
"""
import csv
import io
import os

import pytest
from pyspark.sql import functions as F

from ordermart.operators.file_rules import file_verdicts
from ordermart.schemas import ORDER_COLUMNS
from ordermart.sources.files import Landing, file_contract, project_by_name, scan_records

FILES = {
    "raw/orders/a.csv": "order_id,customer_id,order_date,quantity,unit_price\nO1,C1,2026-09-01,1,10.00\n"
                        "O2,\"C,2\",2026-09-02,2,20.50\n\nO3,C3,2026-09-03,3,1e1\n",
    "raw/orders/b.CSV": "unit_price,quantity,order_date,customer_id,order_id,extra\r\n5,1,2026-01-01,C9,O9,x\r\n"
                        "\"6\",2,2026-01-02,\"C\"\"q\",O10,y\r\n",
    "raw/orders/c.csv": "order_id,customer_id,order_date,quantity\nO5,C5,2026-09-01,1\n",
    "raw/orders/d.csv": "order_id,customer_id,order_date,quantity,unit_price\n",
    "raw/orders/e.csv": "",
    "raw/orders/f.csv": "order_id,customer_id,order_date,quantity,unit_price\nO7,C7,2026-09-01,1,1\n   \n"
                        "O8,C8,10/9/2026,1,1\nO9,,2026-09-01,0,1\n",
    "raw/orders/g.csv": "order_id,customer_id,order_date,quantity,unit_price\nO1,C1,2026-09-01,0,1\n"
                        "O2,C2,2026-09-01,1,-1\nO3,C3,2026-09-01,1,NaN\n",
    "raw/orders/notes.txt": "not a csv",
    "raw/orders/sub/h.csv": "order_id,customer_id,order_date,quantity,unit_price\nO11,C1,2026-09-01,2,3.5\n",
}


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    for key, text in FILES.items():
        p = root / key
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(text.encode())
    return Landing(spark, str(root))


def python_rows(text):
    rows = list(csv.DictReader(io.StringIO(text, newline="")))
    return [(i, r) for i, r in enumerate(rows, start=2)]


def test_listing_is_recursive_and_case_insensitive(landing):
    names = sorted(r.file_name for r in landing.list_csv("raw/orders").collect())
    assert names == sorted(k for k in FILES if k.lower().endswith(".csv"))
    assert landing.list_csv("raw/nothing").count() == 0


def test_scan_matches_dictreader(spark, landing):
    ls = landing.list_csv("raw/orders")
    scan = scan_records(spark, [r.path for r in ls.collect()])
    got = {(landing_key, r.row_number): tuple(r[c] for c in ORDER_COLUMNS)
           for r in project_by_name(scan, ORDER_COLUMNS).withColumn("k", landing.key(F.col("path"))).collect()
           for landing_key in [r.k]}
    expected = {}
    for key, text in FILES.items():
        if not key.lower().endswith(".csv"):
            continue
        for n, row in python_rows(text):
            expected[(key, n)] = tuple(row.get(c) or None for c in ORDER_COLUMNS)
    norm = {k: tuple(v or None for v in vals) for k, vals in got.items()}
    assert norm == expected


def test_record_numbers_across_splits(spark, tmp_path):
    lines = ["order_id,customer_id,order_date,quantity,unit_price"]
    lines += [f"O{i},C{i % 7},2026-09-01,{i % 5 + 1},{i}.25" for i in range(4000)]
    p = tmp_path / "big" / "big.csv"
    p.parent.mkdir()
    p.write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        scan = scan_records(spark, [str(p)])
        assert scan.splits.count() > 5
        rows = project_by_name(scan, ORDER_COLUMNS).select("row_number", "order_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.row_number, r.order_id) for r in rows) == [(i + 2, f"O{i}") for i in range(4000)]


def test_contract_and_verdicts(spark, landing):
    ls = landing.list_csv("raw/orders")
    scan = scan_records(spark, [r.path for r in ls.collect()])
    rows = project_by_name(scan, ORDER_COLUMNS).withColumn("file_name", landing.key(F.col("path")))
    contract = file_contract(ls, scan, ORDER_COLUMNS)
    got = {r.file_name: (r.status, r.error_message) for r in file_verdicts(contract, rows, "orders").collect()}
    assert got["raw/orders/a.csv"] == ("OK", None)
    assert got["raw/orders/b.CSV"] == ("OK", None)
    assert got["raw/orders/sub/h.csv"] == ("OK", None)
    assert got["raw/orders/c.csv"] == ("FAILED", "raw/orders/c.csv is missing required columns: ['unit_price']")
    assert got["raw/orders/d.csv"] == ("FAILED", "raw/orders/d.csv contains no data rows.")
    assert got["raw/orders/e.csv"] == ("FAILED", "raw/orders/e.csv contains no data rows.")
    # the whitespace-only line is record 3 (csv yields it); its empty fields come first
    assert got["raw/orders/f.csv"] == ("FAILED", "raw/orders/f.csv, row 3: order_id is missing.")
    # phase order: quantity at row 2 before the price at row 3
    assert got["raw/orders/g.csv"] == ("FAILED", "raw/orders/g.csv, row 2: quantity must be greater than 0.")


def test_multiline_quoted_fields_match_dictreader(spark, tmp_path):
    text = ('order_id,customer_id,order_date,quantity,unit_price\n'
            'O1,"C,1\nsecond line",2026-09-01,1,1\n\n'
            'O2,"a ""q""\n\nb",2026-09-02,2,2\n'
            'O3,C3,2026-09-03,3,3\n')
    p = tmp_path / "ml" / "m.csv"
    p.parent.mkdir()
    p.write_text(text)
    scan = scan_records(spark, [str(p)])
    got = sorted((r.row_number, tuple(r[c] for c in ORDER_COLUMNS))
                 for r in project_by_name(scan, ORDER_COLUMNS).collect())
    exp = sorted((n, tuple(row[c] for c in ORDER_COLUMNS)) for n, row in python_rows(text))
    assert got == exp


def test_required_inputs_report_the_customer_file_first(spark, tmp_path):
    from ordermart.sources.files import MissingInput, check_required
    (tmp_path / "raw").mkdir()
    landing = Landing(spark, str(tmp_path))
    with pytest.raises(MissingInput, match="raw/customers/customers.csv"):
        check_required(landing, ["raw/customers/customers.csv", "raw/orders/orders.csv"])
    (tmp_path / "raw" / "customers").mkdir()
    (tmp_path / "raw" / "customers" / "customers.csv").write_text("customer_id\n")
    with pytest.raises(MissingInput, match="raw/orders/orders.csv"):
        check_required(landing, ["raw/customers/customers.csv", "raw/orders/orders.csv"])
    (tmp_path / "raw" / "orders").mkdir()
    (tmp_path / "raw" / "orders" / "orders.csv").write_text("order_id\n")
    check_required(landing, ["raw/customers/customers.csv", "raw/orders/orders.csv"])


HEAD = "order_id,customer_id,order_date,quantity,unit_price\n"
QUOTED = {
    "after closing.csv": HEAD + 'O1,"Ann"Lee,2026-09-01,1,1\nO2,"a""b" "c",2026-09-01,1,1\n',
    "stray%41 + q.csv": HEAD + 'O1,Ann 5" Lee,2026-09-01,1,1\nO2,x,2026-09-01,1,1\n',
    "long[1].csv": HEAD + 'O1,"' + 'y""z,' * 25_000 + '",2026-09-01,1,1\nO2,' + "w" * 100_000 + ",2026-09-01,1,1\n",
    "newline.csv": HEAD + 'O1,"two\nlines, ""q""\n\nend",2026-09-01,1,1\n\nO2,x,2026-09-01,1,1\n',
    "unclosed.csv": HEAD + 'O1,a,2026-09-01,1,1\nO2,"open,2026-09-01,1,1\nO3,x,2026-09-01,1,1\n',
    "looks open.csv": HEAD + 'O1,"a,"b,2026-09-01,1\nO2,x,2026-09-01,1,1\n',
}


def test_quoting_and_names_match_dictreader(spark, tmp_path):
    folder = tmp_path / "raw" / "orders"
    folder.mkdir(parents=True)
    for name, text in QUOTED.items():
        (folder / name).write_text(text)
    landing = Landing(spark, str(tmp_path))
    ls = landing.list_csv("raw/orders")
    assert {r.file_name for r in ls.collect()} == {f"raw/orders/{n}" for n in QUOTED}
    scan = scan_records(spark, [r.path for r in ls.collect()])
    rows = project_by_name(scan, ORDER_COLUMNS).withColumn("k", landing.key(F.col("path"))).collect()
    got = {(r.k.rsplit("/", 1)[1], r.row_number): tuple(r[c] or None for c in ORDER_COLUMNS) for r in rows}
    want = {(name, n): tuple(row.get(c) or None for c in ORDER_COLUMNS)
            for name, text in QUOTED.items() for n, row in python_rows(text)}
    assert got == want
    counts = {r.file_name.rsplit("/", 1)[1]: r.data_rows for r in file_contract(ls, scan, ORDER_COLUMNS).collect()}
    assert counts == {name: len(python_rows(text)) for name, text in QUOTED.items()}


def test_other_splits_never_lose_rows(spark, tmp_path):
    p = tmp_path / "big.csv"
    p.write_text(HEAD + "".join(f"O{i},C,2026-09-01,1,1\n" for i in range(200_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        rows = project_by_name(scan_records(spark, [str(p)]), ORDER_COLUMNS)
        assert rows.where("cast(substr(order_id, 2) as bigint) + 2 = row_number").count() == 200_000
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
        try:
            again = project_by_name(scan_records(spark, [str(p)]), ORDER_COLUMNS)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "700k")
            assert again.where("cast(substr(order_id, 2) as bigint) + 2 = row_number").count() == 200_000
        except Exception as e:
            assert "cut into other splits" in str(e)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_all_date_errors_are_kept(spark):
    from ordermart.operators.file_rules import DateErrors, raise_on_date_errors
    bad = spark.range(1500).selectExpr("'f.csv' AS file_name", "id AS row_number", "concat('row ', id) AS message")
    with pytest.raises(DateErrors) as e:
        raise_on_date_errors(bad)
    assert e.value.total == 1500 and spark.read.parquet(e.value.path).count() == 1500
    raise_on_date_errors(bad.where("false"))
