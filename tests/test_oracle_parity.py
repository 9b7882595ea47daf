"""Every registered query against its DuckDB oracle on sf0.001."""
import pytest

import __spark_entry__ as entry
from ordermart.compare import compare

from .conftest import SF_SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], ORACLES.get(name), duck)
    if name in ORACLES:
        assert res["columns_match"], res
        assert res["values_match"], res
    else:
        assert res["spark_rows"] >= 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sales_month", "total_orders", "total_sales"]
