"""Plan shape: one scan per source, no Python UDFs in batch queries,
pruned columns, WindowGroupLimit for top-1 dedup, partition pruning."""

import pytest

from conftest import SF001
from lakeward.catalog import QUERIES
from lakeward.catalog.common import dedup

BATCH = [n for n in QUERIES if not n.startswith("stream_")]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["partner_daily", "silver_events", "user_day", "quality_completeness",
                                  "partner_hourly", "sessionize"])
def test_no_python_udf(spark, name):
    assert "PythonUDF" not in _plan(QUERIES[name](spark, SF001))
    assert "BatchEvalPython" not in _plan(QUERIES[name](spark, SF001))


def test_flagship_reads_each_table_once_with_pruned_columns(spark):
    df = QUERIES["partner_daily"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert "value" not in plan.split("ReadSchema")[1].split("\n")[0] if "ReadSchema" in plan else True


def test_dedup_uses_window_group_limit(spark):
    plan = _plan(dedup(spark, SF001))
    assert "WindowGroupLimit" in plan


def test_backfill_prunes_bronze_partitions(spark):
    df = QUERIES["backfill"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_checks_are_one_aggregate(spark):
    df = QUERIES["quality_completeness"](spark, SF001)
    plan = _plan(df)
    # one final aggregation over the candidate, then unpivot
    assert plan.count("HashAggregate(keys=[]") <= 2


def test_dashboard_reads_stored_gold_by_partition(spark):
    """One scan of the stored table, no source scan; the date range is a partition filter and only the columns shown are read."""
    plan = _plan(QUERIES["dashboard_filter"](spark, SF001))
    assert plan.count("FileScan parquet") == 1 and "PartitionFilters: [isnotnull(metric_date" in plan
    for name in ("dashboard_table", "dashboard_kpis", "minutes_by_day", "completions_by_partner", "dau_pivot", "dashboard_bounds", "dau_trend", "partner_rank"):
        plan = _plan(QUERIES[name](spark, SF001))
        assert plan.count("FileScan parquet") == 1 and "event_id" not in plan, name
    assert "top_event_types" not in plan
