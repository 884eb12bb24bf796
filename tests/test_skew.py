"""Hot keys: one user with a third of all rows is split over many tasks."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import plain_sessions
from lakeward.operators import sessions


def _skewed(spark, n=30000):
    # user 'hot' owns a third of the rows, spread over 3 days; 500 other users share the rest
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 500).cast("string")))
         .alias("user_id"),
        (F.lit(datetime(2024, 1, 1)).cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") * 7 % 259200).cast("decimal(18,6)")))
        .alias("event_timestamp"),
        F.col("id").cast("string").alias("event_id"))
    return base


def test_hot_user_is_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = _skewed(spark)
        out = sessions.sessionize(df)
        per_task = (out.where("user_id = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect())
        hot_rows = sum(r["count"] for r in per_task)
        assert hot_rows == 10000
        assert len(per_task) >= 4                          # not one task
        assert max(r["count"] for r in per_task) < hot_rows / 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_skewed_sessions_equal_single_window(spark):
    df = _skewed(spark, 6000)
    a = sessions.sessionize(df).select("event_id", "derived_session_id")
    want = plain_sessions([tuple(r) for r in df.select("user_id", "event_timestamp", "event_id").collect()])
    assert {r["event_id"]: r["derived_session_id"] for r in a.collect()} == want


def test_chunked_session_windows_equal_builtin(spark):
    df = _skewed(spark, 6000)
    a = sessions.session_windows(df)
    b = sessions.session_windows_builtin(df)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "MergingSessions" not in plan          # no per-user merge of raw events
