"""Pipelines end to end on small file fixtures: the source project's own
scenarios (bad date batch, the same file corrected, a second batch added,
changed content under a finished name) plus full refresh and streaming."""
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import Window, functions as F

from ordermart.operators.keys import add_row_number
from ordermart.operators.quality import ValidationError
from ordermart.plans.full_refresh import run_full_refresh
from ordermart.plans.incremental import (IncrementalConfig, IngestionError, IngestionStore,
                                         run_incremental)
from ordermart.plans.warehouse import Warehouse
from ordermart.sources.files import Landing, MissingInput
from ordermart.streaming.ingest import run_stream_once

C_HDR = "customer_id,customer_name,city,email,created_date\n"
O_HDR = "order_id,customer_id,order_date,quantity,unit_price\n"


def put(root, key, text):
    p = root / key
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)


def tracker(store):
    return {r.file_name: (r.status, r.record_count, r.error_message)
            for r in store.tracker_latest().collect()}


def test_incremental_scenario(spark, tmp_path):
    root = tmp_path / "landing"
    put(root, "raw/customers/customers_01.csv",
        C_HDR + "IC001,Ann Lee,Nagpur,ann@example.com,10/9/2026\nIC002,Bo Chen,Pune,bo@example.com,10/9/2026\n")
    put(root, "raw/orders/orders_01.csv",
        O_HDR + "IO001,IC001,10/9/2026,4,300\nIO002,IC002,10/9/2026,2,500\n")
    landing = Landing(spark, str(root))
    store = IngestionStore(spark, str(tmp_path / "wh"))

    # 1. bad dates: the first customer file fails at row 2, the run stops
    with pytest.raises(IngestionError, match="row 2: invalid created_date '10/9/2026'"):
        run_incremental(spark, landing, store)
    t = tracker(store)
    assert t["raw/customers/customers_01.csv"][0] == "FAILED"
    assert "raw/orders/orders_01.csv" not in t
    assert store.visible("customers").count() == 0

    # 2. same names, corrected content: retried and loaded
    put(root, "raw/customers/customers_01.csv",
        C_HDR + "IC001,Ann Lee,Nagpur,ANN@example.com ,2026-10-09\nIC002,Bo Chen,Pune,bo@example.com,2026-10-09\n")
    put(root, "raw/orders/orders_01.csv",
        O_HDR + "IO001,IC001,2026-10-09,4,300\nIO002,IC002,2026-10-09,3,0.125\n")
    res = run_incremental(spark, landing, store)
    assert {r.file_name: r.status for r in res.run_log.collect()} == {
        "raw/customers/customers_01.csv": "SUCCESS", "raw/orders/orders_01.csv": "SUCCESS"}
    t = tracker(store)
    assert t["raw/customers/customers_01.csv"] == ("SUCCESS", 2, None)
    emails = {r.customer_id: r.email for r in store.visible("customers").collect()}
    assert emails["IC001"] == "ann@example.com"
    totals = {r.order_id: (r.unit_price, r.total_amount) for r in store.visible("orders").collect()}
    half_even = (Decimal(3) * Decimal("0.125")).quantize(Decimal("0.01"), ROUND_HALF_EVEN)
    assert totals["IO002"] == (Decimal("0.13"), half_even)

    # 3. a second batch beside processed files: only the new ones run; a
    #    repeated customer id replaces the earlier row (upsert)
    put(root, "raw/customers/customers_02.csv",
        C_HDR + "IC003,Cy Das,Delhi,cy@example.com,2026-10-10\nIC001,Ann Lee-Roy,Kochi,ann@example.com,2026-10-10\n")
    put(root, "raw/orders/orders_02.csv", O_HDR + "IO003,IC003,2026-10-10,1,175.5\n")
    res = run_incremental(spark, landing, store)
    status = {r.file_name: r.status for r in res.run_log.collect()}
    assert status["raw/customers/customers_01.csv"] == "SKIPPED"
    assert status["raw/customers/customers_02.csv"] == "SUCCESS"
    cust = {r.customer_id: r.city for r in store.visible("customers").collect()}
    assert cust == {"IC001": "Kochi", "IC002": "Pune", "IC003": "Delhi"}
    assert store.visible("orders").count() == 3

    # 4. changed content under a finished name is not read again
    put(root, "raw/orders/orders_01.csv", O_HDR + "IO001,IC001,2026-10-09,9,999\n")
    res = run_incremental(spark, landing, store)
    assert {r.status for r in res.run_log.collect()} == {"SKIPPED"}
    assert {r.order_id: r.quantity for r in store.visible("orders").collect()}["IO001"] == 4

    # 5. continue mode: a bad file does not stop the good one after it
    put(root, "raw/orders/orders_03.csv", O_HDR + "IO004,IC001,2026-10-11,0,1\n")
    put(root, "raw/orders/orders_04.csv", O_HDR + "IO005,IC002,2026-10-11,1,1\n")
    res = run_incremental(spark, landing, store, IncrementalConfig(on_error="continue"))
    status = {r.file_name: (r.status, r.error_message) for r in res.run_log.collect()}
    assert status["raw/orders/orders_03.csv"] == (
        "FAILED", "raw/orders/orders_03.csv, row 2: quantity must be greater than 0.")
    assert status["raw/orders/orders_04.csv"][0] == "SUCCESS"
    assert store.visible("orders").count() == 4


def test_no_files_at_all(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(MissingInput):
        run_incremental(spark, Landing(spark, str(tmp_path / "empty")),
                        IngestionStore(spark, str(tmp_path / "wh")))


def test_stream_stops_then_resumes(spark, tmp_path):
    root = tmp_path / "landing"
    put(root, "raw/customers/customers_01.csv", C_HDR + "S1,A B,X,a@b.co,2026-13-01\n")
    put(root, "raw/orders/orders_01.csv", O_HDR + "SO1,S1,2026-10-01,1,2\n")
    landing = Landing(spark, str(root))
    store = IngestionStore(spark, str(tmp_path / "wh"))
    ckpt = str(tmp_path / "stream-ckpt")
    err = run_stream_once(spark, landing, store, ckpt)
    assert err and "invalid created_date '2026-13-01'" in err
    assert tracker(store)["raw/customers/customers_01.csv"][0] == "FAILED"
    # corrected under the same name: the uncommitted batch is replayed
    put(root, "raw/customers/customers_01.csv", C_HDR + "S1,A B,X,a@b.co,2026-12-01\n")
    assert run_stream_once(spark, landing, store, ckpt) is None
    t = tracker(store)
    assert t["raw/customers/customers_01.csv"] == ("SUCCESS", 1, None)
    assert t["raw/orders/orders_01.csv"] == ("SUCCESS", 1, None)
    # a new file later: only it is processed
    put(root, "raw/orders/orders_02.csv", O_HDR + "SO2,S1,2026-10-02,2,3\n")
    assert run_stream_once(spark, landing, store, ckpt) is None
    assert store.visible("orders").count() == 2


def _write_inputs(root, customers, orders):
    put(root, "in/customers/customers.csv", C_HDR + "".join(customers))
    put(root, "in/orders/orders.csv", O_HDR + "".join(orders))


def test_full_refresh_publishes_clean_data(spark, tmp_path):
    _write_inputs(tmp_path, ["C2, bob  ross ,PUNE,Bob@X.com,2026-09-02\n", "C1,ann lee,delhi,ann@x.com,2026-09-01\n"],
                  ["O1,C1,2026-09-01,2,10.005\n", "O2,C2,2026-09-05,1,5\n"])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    res = run_full_refresh(spark, Landing(spark, str(tmp_path)), wh, "in/customers", "in/orders")
    dim = {r.customer_id: (r.customer_key, r.customer_name, r.city, r.email) for r in res.dim.collect()}
    assert dim == {"C1": (1, "Ann Lee", "Delhi", "ann@x.com"), "C2": (2, "Bob Ross", "Pune", "bob@x.com")}
    fact = {r.order_id: r.total_amount for r in res.fact.collect()}
    assert fact == {"O1": Decimal("20.02"), "O2": Decimal("5.00")}


def test_full_refresh_reports_every_failure_and_publishes_nothing(spark, tmp_path):
    _write_inputs(tmp_path, ["C1,ann,delhi,bad@,2026-09-01\n", "C1,ann,delhi,a@x.com,2026-09-01\n"],
                  ["O1,C9,2026-09-01,0,-1\n", "O1,C1,,1,1\n"])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(ValidationError) as e:
        run_full_refresh(spark, Landing(spark, str(tmp_path)), wh, "in/customers", "in/orders")
    msg = str(e.value)
    assert msg.startswith("Task 1 validation failed:\n- ")
    for part in ["1 order records have missing mandatory values.", "Found 1 duplicate customer IDs.",
                 "Found 1 duplicate order IDs.", "Found 1 orders with quantity <= 0.",
                 "Found 1 orders with negative unit price.", "Found 1 orders with missing order_date.",
                 "Found 1 orders referencing missing customers.",
                 "Found 1 customers with invalid email format."]:
        assert part in msg
    assert not (tmp_path / "wh" / "dim_customer").exists()
    assert not (tmp_path / "wh" / "fact_order").exists()


def test_full_refresh_missing_input(spark, tmp_path):
    put(tmp_path, "in/orders/orders.csv", O_HDR + "O1,C1,2026-09-01,1,1\n")
    with pytest.raises(MissingInput, match="in/customers"):
        run_full_refresh(spark, Landing(spark, str(tmp_path)), Warehouse(spark, str(tmp_path / "wh")),
                         "in/customers", "in/orders")


def test_surrogate_key_with_a_hot_id(spark):
    # a third of all rows share one id: keys stay dense and ordered
    rows = [(f"K{i % 50:03d}" if i % 3 else "K000", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "customer_id string, v int").repartition(7)
    keyed = add_row_number(df, "customer_id", "customer_key", num_partitions=6).collect()
    keys = sorted(r.customer_key for r in keyed)
    assert keys == list(range(1, 3001))
    by_key = sorted(keyed, key=lambda r: r.customer_key)
    ids = [r.customer_id for r in by_key]
    assert ids == sorted(ids)
    ref = (df.withColumn("rn", F.row_number().over(Window.orderBy("customer_id")))
           .groupBy("customer_id").agg(F.min("rn").alias("lo"), F.max("rn").alias("hi")).collect())
    spans = {r.customer_id: (r.lo, r.hi) for r in ref}
    for r in keyed:
        lo, hi = spans[r.customer_id]
        assert lo <= r.customer_key <= hi


def test_compaction_keeps_the_latest_view(spark, tmp_path):
    root = tmp_path / "landing"
    put(root, "raw/orders/orders_01.csv", O_HDR + "A1,C1,2026-10-01,1,2\nA2,C1,2026-10-01,2,2\n")
    landing = Landing(spark, str(root))
    store = IngestionStore(spark, str(tmp_path / "wh"))
    run_incremental(spark, landing, store)
    before = sorted(map(tuple, store.visible("orders").collect()))
    b = store.compact("orders")
    assert store.latest_snapshot("orders") == b
    assert sorted(map(tuple, store.visible("orders").collect())) == before
    # a later batch still overrides the snapshot
    put(root, "raw/orders/orders_02.csv", O_HDR + "A2,C1,2026-10-02,7,3\nA3,C2,2026-10-02,1,1\n")
    run_incremental(spark, landing, store)
    got = {r.order_id: r.quantity for r in store.visible("orders").collect()}
    assert got == {"A1": 1, "A2": 7, "A3": 1}


def test_full_refresh_date_check_collects_all_errors(spark, tmp_path):
    _write_inputs(tmp_path, ["C1,a b,x,a@x.com,2026-9-1\n", "C2,a b,x,b@x.com,10/9/2026\n"],
                  ["O1,C1,,1,1\n", "O2,C2,2026-02-30,1,1\n"])
    with pytest.raises(ValueError) as e:
        run_full_refresh(spark, Landing(spark, str(tmp_path)), Warehouse(spark, str(tmp_path / "wh")),
                         "in/customers", "in/orders", check_dates=True)
    assert str(e.value) == ("Date validation failed:\n"
                            "in/customers/customers.csv, row 3: Invalid created_date '10/9/2026'. Expected YYYY-MM-DD.\n"
                            "in/orders/orders.csv, row 2: order_date is missing.\n"
                            "in/orders/orders.csv, row 3: Invalid order_date '2026-02-30'. Expected YYYY-MM-DD.")


def test_compacted_reads_open_the_snapshot_and_later_batches_only(spark, tmp_path):
    store = IngestionStore(spark, str(tmp_path / "wh"))

    def batch(n):
        files = spark.createDataFrame([(f"f{n}.csv", "SUCCESS", 1, None), ("hot.csv", "FAILED" if n % 2 else "SUCCESS", n, "e")],
                                      "file_name string, status string, record_count long, error_message string")
        store.record_events(files, n, 2)
        rows = spark.createDataFrame([(f"O{n}", f"C{n}", 1, n), ("HOT", f"C{n}", 2, 1)],
                                     "order_id string, customer_id string, file_ordinal long, row_number long")
        store.orders.append(rows.selectExpr("*", "cast(null as date) order_date", f"{n} quantity", "1.00 unit_price",
                                            "1.00 total_amount", f"'f{n}.csv' file_name"), n)

    def state():
        return (sorted(map(str, store.visible("orders").collect())),
                sorted((r.file_name, r.status, r.record_count) for r in store.tracker_latest().collect()))

    for n in range(1, 9):
        batch(n)
    before = state()
    assert len(before[0]) == 9 and ("hot.csv", "SUCCESS", 8) in before[1]
    for kind in ("orders", "tracker"):
        store.compact(kind)
    assert state() == before
    batch(9)
    for kind, log in (("orders", "inc_orders"), ("tracker", "ingestion_tracker")):
        opened = store.visible(kind).inputFiles()
        read = {p for p in opened if f"/{log}/" in p}
        plan = store.visible(kind)._jdf.queryExecution().executedPlan().toString()
        assert f"snapshots/{kind}/batch=8" in " ".join(opened) and read
        assert "SortAggregate" not in plan and "batch_id" in plan and "PartitionFilters: [isnotnull(batch_id" in plan
    orders, files = state()
    assert len(orders) == 10 and ("hot.csv", "FAILED", 9) in files


def test_stop_mode_reads_nothing_past_a_failure(spark, tmp_path, monkeypatch):
    from ordermart.plans import incremental
    root = tmp_path / "landing"
    put(root, "raw/customers/customers_01.csv", C_HDR + "C1,Ann,X,a@b.co,2026-10-01\n")
    put(root, "raw/orders/orders_01.csv", O_HDR + "O1,C1,2026-10-01,1,2\n")
    put(root, "raw/orders/orders_02.csv", "order_id,quantity\nO2,1\n")
    put(root, "raw/orders/orders_03.csv", O_HDR + "O3,C1,2026-10-01,1,2\n")
    put(root, "raw/orders/orders_04.csv", O_HDR + "O4,C1,2026-10-01,1,2\n")
    landing = Landing(spark, str(root))
    scans = []
    real = incremental.scan_records

    def scan_spy(session, paths):
        scans.append([p.rsplit("/", 1)[1] for p in paths])
        return real(session, paths)

    monkeypatch.setattr(incremental, "scan_records", scan_spy)
    for wave in (1 << 40, 200, 1):
        scans.clear()
        store = IngestionStore(spark, str(tmp_path / f"wh{wave}"))
        res = run_incremental(spark, landing, store, IncrementalConfig(wave_bytes=wave), raise_on_error=False)
        assert res.error == "raw/orders/orders_02.csv is missing required columns: ['customer_id', 'order_date', 'unit_price']"
        assert {r.file_name[-13:]: r.status for r in res.plan.where("kind = 'orders'").collect()} == {
            "orders_01.csv": "SUCCESS", "orders_02.csv": "FAILED", "orders_03.csv": "UNTOUCHED", "orders_04.csv": "UNTOUCHED"}
        assert {r.order_id for r in store.visible("orders").collect()} == {"O1"}
        opened = {f for s in scans for f in s}
        if wave == 1:       # a wave per file: files after the failing one are never opened
            assert opened == {"customers_01.csv", "orders_01.csv", "orders_02.csv"}
        if wave > 1 << 30:  # one wave: its rows are parsed from a scan that ends before the bad header
            assert scans[-1] == ["customers_01.csv", "orders_01.csv"]
    # continue mode reads on, whatever the waves
    store = IngestionStore(spark, str(tmp_path / "wh-continue"))
    res = run_incremental(spark, landing, store, IncrementalConfig(on_error="continue", wave_bytes=100))
    assert {r.order_id for r in store.visible("orders").collect()} == {"O1", "O3", "O4"} and res.error is None


def test_a_crash_before_the_last_events_shows_nothing(spark, tmp_path, monkeypatch):
    root = tmp_path / "landing"
    put(root, "raw/orders/orders_01.csv", O_HDR + "A1,C1,2026-10-01,1,2\n")
    landing = Landing(spark, str(root))
    store = IngestionStore(spark, str(tmp_path / "wh"))
    run_incremental(spark, landing, store)
    put(root, "raw/orders/orders_02.csv", O_HDR + "A1,C1,2026-10-01,9,2\nA2,C1,2026-10-01,1,2\n")
    real = IngestionStore.record_events

    def crash(self, events, batch_id, event_seq):
        if event_seq == 2:
            raise RuntimeError("executor lost")
        real(self, events, batch_id, event_seq)

    monkeypatch.setattr(IngestionStore, "record_events", crash)
    with pytest.raises(RuntimeError, match="executor lost"):
        run_incremental(spark, landing, store)
    monkeypatch.undo()
    seen = lambda: {r.order_id: r.quantity for r in store.visible("orders").collect()}
    assert store.open_batches("orders") == [2] and store.next_batch() == 3 and seen() == {"A1": 1}
    run_incremental(spark, landing, store)      # the same file again, in a new batch
    assert seen() == {"A1": 9, "A2": 1}
    assert store.vacuum() == [2] and store.open_batches("orders") == [] and seen() == {"A1": 9, "A2": 1}


def test_snapshot_is_merged_without_moving_it(spark, tmp_path, monkeypatch):
    from ordermart.plans import incremental
    monkeypatch.setattr(incremental, "SNAPSHOT_BUCKET_BYTES", 500)
    store = IngestionStore(spark, str(tmp_path / "wh"))

    def batch(n, ids):
        files = spark.createDataFrame([(f"f{n}.csv", "SUCCESS", 1, None)],
                                      "file_name string, status string, record_count long, error_message string")
        rows = spark.createDataFrame([(f"O{i}", f"C{n}", 1, k) for k, i in enumerate(ids)],
                                     "order_id string, customer_id string, file_ordinal long, row_number long")
        store.orders.append(rows.selectExpr("*", "cast(null as date) order_date", f"{n} quantity", "1.00 unit_price",
                                            "1.00 total_amount", f"'f{n}.csv' file_name"), n)
        store.record_events(files, n, 2)

    def rows():
        return sorted((r.order_id, r.quantity) for r in store.visible("orders").collect())

    batch(1, range(300))
    batch(2, range(0, 300, 3))
    store.compact("orders")
    batch(3, range(0, 300, 7))
    want = sorted((f"O{i}", 3 if i % 7 == 0 else 2 if i % 3 == 0 else 1) for i in range(300))
    assert rows() == want and store._snapshot("orders")[1] > 1
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = store.visible("orders")
        view.collect()
        plan = view._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        scan = next(i for i, line in enumerate(plan.splitlines()) if "snapshot_" in line and "Scan" in line)
        above = []
        depth = len(plan.splitlines()[scan]) - len(plan.splitlines()[scan].lstrip(" :+-"))
        for line in reversed(plan.splitlines()[:scan]):     # the operators over the snapshot, up to the join
            d = len(line) - len(line.lstrip(" :+-"))
            if d < depth:
                depth = d
                above.append(line.strip(" :+-"))
            if "SortMergeJoin" in line or "HashJoin" in line:
                break
        assert above[-1].startswith(("SortMergeJoin", "ShuffledHashJoin")) and not any("Exchange" in x for x in above)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # a new session has no table of it: the folder's name tells its buckets
    name = store._bucketed("orders", *store._snapshot("orders"))[1]
    spark.sql(f"DROP TABLE {name}")
    assert rows() == want
    store.compact("orders")
    assert rows() == want and store.latest_snapshot("orders") == 3
