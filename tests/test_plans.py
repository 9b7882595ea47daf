"""Physical-plan properties that matter at scale (checked on sf0.001 plans)."""
import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as entry
from ordermart.operators.file_rules import file_verdicts
from ordermart.plans import catalog

from .conftest import SF_SMALL


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_reports_prune_columns_and_aggregate_before_the_join(spark):
    plan = plan_text(entry.queries()["sales_by_city"](spark, SF_SMALL))
    assert "SortAggregate" not in plan
    # orders: only key, customer and price are read (no dates, status, priority)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan
    # per-customer partial + final aggregate sit below the join with the dimension
    tree = plan.split("\n\n")[0]
    join_at = tree.index("HashJoin")
    assert tree.count("HashAggregate", join_at) >= 2


def test_monthly_sales_aggregates_map_side(spark):
    plan = plan_text(entry.queries()["monthly_sales"](spark, SF_SMALL))
    tree = plan.split("\n\n")[0]
    assert tree.count("HashAggregate") >= 2 and "SortAggregate" not in tree
    assert "o_orderstatus" not in plan and "o_orderpriority" not in plan


def test_file_verdicts_use_hash_aggregates_and_broadcasts(spark):
    landing = catalog._landing(spark, SF_SMALL)
    _, _, rows, contract = catalog._scan(spark, landing, "orders")
    plan = plan_text(file_verdicts(contract, rows, "orders"))
    assert "SortAggregate" not in plan
    # the per-file summaries and headers are broadcast, records are never shuffled for them
    assert "BroadcastHashJoin" in plan


def test_quality_counts_in_one_pass_per_table(spark):
    plan = plan_text(entry.queries()["dq_report"](spark, SF_SMALL))
    assert "SortAggregate" not in plan
    # duplicate-id counting reads only the key column of orders
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_surrogate_key_has_no_unpartitioned_window_over_rows(spark):
    df = entry.queries()["dim_customer"](spark, SF_SMALL)
    plan = plan_text(df)
    # rows come from the checkpoint; the only window runs over per-partition counts
    assert "Window" not in plan or "_part" in plan
    assert df.select(F.min("customer_key"), F.max("customer_key"), F.count("*")).first() == (
        1, df.count(), df.count())
