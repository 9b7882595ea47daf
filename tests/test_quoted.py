"""Quoted line feeds: line states against Python's csv module, and files cut into many splits."""
import csv
import io
import re

import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermart.schemas import ORDER_COLUMNS
from ordermart.sources import quoted
from ordermart.sources.files import file_contract, project_by_name, scan_records, Landing

LINE = st.text(alphabet='a," ', max_size=14)


def _lines_read(lines):
    """How many lines the csv module takes for the first record."""
    taken = 0

    def feed():
        nonlocal taken
        for line in lines:
            taken += 1
            yield line + "\n"

    next(csv.reader(feed()))
    return taken


@settings(max_examples=600, deadline=None)
@given(LINE)
@example('a,"b,"c,d')
@example('a,"b""')
def test_line_states_equal_the_csv_module(line):
    opens = re.compile(quoted.LINE_OPENS.replace(r"\z", r"\Z"))
    stays = re.compile(quoted.LINE_STAYS.replace(r"\z", r"\Z"))
    assert bool(opens.match(line)) == (_lines_read([line, '"']) == 2)
    assert bool(stays.match(line)) == (_lines_read(['x,"', line, '"']) == 3)


def _scan(spark, paths, size, columns):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        scan = scan_records(spark, paths)
        rows = {}
        for r in project_by_name(scan, columns).collect():
            key = (r.path.rsplit("/", 1)[1], r.row_number)
            assert key not in rows
            rows[key] = tuple(r[c] for c in columns)
        return scan, rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _expected(files, columns):
    return {(name, n): tuple(row.get(c) for c in columns)
            for name, text in files.items() for n, row in enumerate(csv.DictReader(io.StringIO(text, newline="")), start=2)}


@pytest.mark.parametrize("size", ["250", "1m"])
def test_random_files_in_small_splits(spark, tmp_path, size):
    import random
    r = random.Random(7)
    files = {}
    for i in range(5):
        def field():
            text = "".join(r.choice('ab,"\n x') for _ in range(r.randint(0, r.choice([3, 12, 200]))))
            return '"' + text.replace('"', '""') + '"' + r.choice(["", "", 'z"']) if r.random() < 0.6 else re.sub('[,\n"]', "", text) + "k"
        body = "".join(f"{field()},{field()}\n" + r.choice(["", "", "\n"]) for _ in range(r.randint(5, 25)))
        files[f"f{i}.csv"] = r.choice(["a,b\n", "b,a\n", '"a",b,c\n', '"x\ny",a,b\n']) + body
    files["open.csv"] = 'a,b\n1,2\n3,"never closed\n' + "text, and more\n" * 30
    files["plain.csv"] = "a,b\n" + "1,2\n" * 50
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    _, rows = _scan(spark, [str(tmp_path / n) for n in files], size, ["a", "b"])
    got = {k: tuple(x if x is not None else "" for x in v) for k, v in rows.items()}
    want = {k: tuple(x if x is not None else "" for x in v) for k, v in _expected(files, ["a", "b"]).items()}
    assert got == want


def test_a_file_of_three_splits_uses_three_tasks(spark, tmp_path):
    text = "a,b\n" + "".join(f'{i},"line {i}\n\nnext, ""{i}"""\n' for i in range(30_000))
    path = tmp_path / "big.csv"
    path.write_text(text)
    size = len(text) // 3 + 64 * 1024
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        scan = scan_records(spark, [str(path)])
        assert scan.splits.count() == 3
        got = scan.records.where("record_number > 1")
        want = [(i + 2, [str(i), f'line {i}\n\nnext, "{i}"']) for i in range(30_000)]
        assert sorted((r.record_number, r.fields) for r in got.collect()) == want
        files = {p for p in scan.records.inputFiles() if "quoted-records" in p}
        sizes = [spark.read.parquet(p).count() for p in files]
        assert len(sizes) == 3 and min(sizes) > 5_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_blank_first_line_is_a_header_without_names(spark, tmp_path):
    head = ",".join(ORDER_COLUMNS) + "\n"
    files = {"blank.csv": "\n" + head + "O1,C1,2026-09-01,1,1\n", "only.csv": "\n\n\n", "crlf.csv": "\r\n" + head,
             "good.csv": head + "\n\nO1,C1,2026-09-01,1,1\n", "quoted.csv": "\n" + head + '"O\n1",C1,2026-09-01,1,1\n'}
    for name, text in files.items():
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / name).write_bytes(text.encode())
    landing = Landing(spark, str(tmp_path))
    ls = landing.list_csv("raw")
    scan, rows = _scan(spark, [r.path for r in ls.collect()], "1m", ORDER_COLUMNS)
    missing = " is missing required columns: " + str(sorted(ORDER_COLUMNS))
    got = {r.file_name: (r.data_rows, r.contract_error) for r in file_contract(ls, scan, ORDER_COLUMNS).collect()}
    assert got == {"raw/blank.csv": (2, "raw/blank.csv" + missing), "raw/only.csv": (0, "raw/only.csv contains no data rows."),
                   "raw/crlf.csv": (1, "raw/crlf.csv" + missing), "raw/good.csv": (1, None),
                   "raw/quoted.csv": (2, "raw/quoted.csv" + missing)}
    assert {k: v for k, v in rows.items() if k[0] == "good.csv"} == {("good.csv", 2): ("O1", "C1", "2026-09-01", "1", "1")}
    assert {n for f, n in rows if f == "blank.csv"} == {2, 3} and {n for f, n in rows if f == "quoted.csv"} == {2, 3}
