"""The registered queries: names, SQL and results against DuckDB at the smallest scale."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

SMALL = "/root/testdata/sf0.001"
SAMPLE = ["src1_load_recalls", "cat8_categorize", "rnk1_top_manufacturers", "tmp7_spike_detection", "cor4_chi_square",
          "dq5_daily_anomalies", "ded1_ordered_fold", "ing3_merge_firms", "src7_alert_list", "rpt2_insights", "rpt3_sections"]


def test_registry():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 80
    without = {name for name in set(queries) - set(sql) if not name.startswith("op") and name != "pipeline"}
    assert without == {"rpt4_lines"}


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    problem, rows = compare(spark, connect(SMALL), entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert problem is None and rows > 0
