"""Stored sketches: distinct users and ingest lag kept per day, so that any span is answered from small rows.

Sketches merge, so a week or a month is the merge of its days and raw events are not read again.  A HyperLogLog
sketch does not count a user twice however often an event is folded in: a repeated batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.sinks import writes

LOG_BUCKETS = 12                    # 4,096 buckets: a standard error of 1.04 / sqrt(4096), 1.6 %
USERS_DDL = "partner_id string, users binary, metric_date date"
LAG_DDL = "day date, rows bigint, within_sla bigint, lag binary, contract string, run_id string"
LAG = "unix_timestamp(ingest_timestamp) - unix_timestamp(event_timestamp)"


def user_sketches(events: DataFrame, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """One sketch of the users of every (partner, day); partial aggregation, NULL users count nowhere."""
    return events.groupBy("partner_id", F.to_date("event_timestamp").alias("metric_date")).agg(
        F.hll_sketch_agg("user_id", log_buckets).alias("users"))


def fold_users(spark: SparkSession, path: str, events: DataFrame) -> str:
    """Fold events into the stored sketches, partitioned by day; only the days of the events are rewritten."""
    fresh = user_sketches(events).select("partner_id", "users", "metric_date")
    if not writes.exists(spark, path):
        return writes.write_table(fresh, path, ["metric_date"])
    held = f"{path.rstrip('/')}__updates_fold"
    fresh.write.mode("overwrite").parquet(held)
    fresh = spark.read.schema(USERS_DDL).parquet(held)
    days = writes._partitions_of(fresh, ["metric_date"])
    stored = writes._in_partitions(spark.read.schema(USERS_DDL).parquet(path), ["metric_date"], days)
    both = stored.unionByName(fresh).groupBy("partner_id", "metric_date").agg(F.hll_union_agg("users").alias("users"))
    writes.replace_partitions(spark, both.select("partner_id", "users", "metric_date"), path, ["metric_date"], days)
    writes.discard(spark, held)
    return path


def users_by(sketches: DataFrame, period) -> DataFrame:
    """Users per partner and ``period`` (a column over ``metric_date``), from the sketches of its days."""
    return sketches.groupBy("partner_id", period.alias("period_start")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users_approx"))


def lag_by_day(rows: DataFrame, sla_minutes: float | None) -> DataFrame:
    """Q6/Q7: per event day the rows, those inside the SLA and a quantile sketch of the ingest lag in seconds."""
    lag = F.expr(LAG)
    inside = F.count_if(lag <= sla_minutes * 60) if sla_minutes is not None else F.lit(None)
    return rows.groupBy(F.to_date("event_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), inside.cast("bigint").alias("within_sla"), F.kll_sketch_agg_bigint(lag).alias("lag"))


def lag_quantile(days: DataFrame, share: float, *by) -> DataFrame:
    """A quantile of the lag over any span of stored days, from their merged sketches."""
    return days.groupBy(*by).agg(F.sum("rows").cast("bigint").alias("rows"), F.sum("within_sla").cast("bigint").alias("within_sla"),
                                 F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint("lag"), F.lit(share)).alias("lag_s"))
