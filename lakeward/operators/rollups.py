"""Partner rollups and the dashboard's aggregations, all as DataFrame plans.

Several ``count_distinct`` in one ``agg`` are planned by Catalyst as one
Expand + two-level aggregate: the first shuffle is keyed by (group, distinct
value), so a partner holding a third of all rows is spread over many tasks,
and the second shuffle only carries per-task partial counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.functions.expressions import REFERENCE_VOCAB, Vocabulary

DISPLAY_COLUMNS = ["partner_id", "metric_date", "dau", "total_sessions", "total_engagement_min",
                   "exercise_completions", "new_signups"]


def _minutes(vocab: Vocabulary) -> Column:
    m = F.sum(F.when(vocab.is_end(), vocab.duration() / F.lit(60.0)).otherwise(F.lit(0.0)))
    return F.coalesce(m, F.lit(0.0))


def _completions(vocab: Vocabulary) -> Column:
    return F.sum(F.when(vocab.is_completion(), F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def engagement_aggs(vocab: Vocabulary, extended: bool = True, top_k: int = 5) -> list[Column]:
    aggs = [F.count_distinct("user_id").alias("dau"),
            F.count_distinct("session_id").alias("total_sessions"),
            _minutes(vocab).alias("total_engagement_min"),
            _completions(vocab).alias("exercise_completions")]
    if extended:
        # ``collect_list(DISTINCT ..)`` is rewritten with the other distinct
        # aggregates: the type becomes one more Expand group, the partial
        # aggregates stay hash-based, and only the final, partner-day-sized
        # level builds the (small) set.
        aggs += [F.count_distinct(F.when(vocab.is_first(), F.col("user_id"))).alias("new_signups"),
                 F.slice(F.sort_array(F.expr("collect_list(DISTINCT event_type)")), 1, top_k)
                  .alias("top_event_types")]
    return aggs


def partner_daily(silver: DataFrame, vocab: Vocabulary = REFERENCE_VOCAB, as_of=None,
                  extended: bool = True, top_k: int = 5) -> DataFrame:
    """One row per (partner_id, metric_date).  ``top_event_types`` is
    the alphabetical first ``top_k`` of the distinct types (the contract's
    definition), not the most frequent ones (see ``top_types_by_count``)."""
    out = (silver.groupBy("partner_id", F.to_date("event_timestamp").alias("metric_date"))
                 .agg(*engagement_aggs(vocab, extended, top_k)))
    if as_of is not None:
        out = out.withColumn("last_refreshed_at", F.lit(as_of).cast("timestamp"))
    return out


def partner_hourly(silver: DataFrame, vocab: Vocabulary = REFERENCE_VOCAB) -> DataFrame:
    """Hourly grain."""
    return (silver.groupBy("partner_id", F.date_trunc("hour", "event_timestamp").alias("metric_hour"))
                  .agg(F.count(F.lit(1)).alias("events"), *engagement_aggs(vocab, extended=False)))


def partner_weekly(silver: DataFrame, vocab: Vocabulary = REFERENCE_VOCAB) -> DataFrame:
    """Weekly outcomes.  ``date_trunc('week')`` returns a timestamp; the
    contract wants a date, so it is cast.  The average is over end events only
    (``avg(..) FILTER (WHERE ..)``): NULL when a week has none."""
    end_min = F.when(vocab.is_end(), vocab.duration() / F.lit(60.0))
    return (silver.groupBy("partner_id",
                           F.date_trunc("week", "event_timestamp").cast("date").alias("week_start"))
                  .agg(F.avg(end_min).alias("avg_session_min"),
                       F.count_distinct(F.when(F.expr(vocab.intensity_high), F.col("user_id")))
                        .alias("high_intensity_users"),
                       F.count_distinct(F.when(F.expr(vocab.drop_off), F.col("user_id")))
                        .alias("drop_off_risk_users")))


def partner_subtotals(silver: DataFrame) -> DataFrame:
    """Partner-day rows plus per-partner and overall totals."""
    return (silver.withColumn("metric_date", F.to_date("event_timestamp"))
                  .rollup("partner_id", "metric_date")
                  .agg(F.grouping_id("partner_id", "metric_date").alias("level"),
                       F.count(F.lit(1)).alias("events"),
                       F.count_distinct("user_id").alias("users")))


def approx_dau(silver: DataFrame, rsd: float = 0.01) -> DataFrame:
    """HyperLogLog++ distinct users per partner-day (streams, long windows), the exact number beside it.

    Users are made distinct first: beside a ``count_distinct`` every (partner, day, user) would carry a sketch of its own
    (13 KB at 1 %) up to the second aggregation.  A sketch takes a value once or often alike."""
    day = F.to_date("event_timestamp").alias("metric_date")
    return (silver.select("partner_id", day, "user_id").distinct().groupBy("partner_id", "metric_date")
                  .agg(F.approx_count_distinct("user_id", rsd).alias("dau_approx"),
                       F.count("user_id").alias("dau")))


# -- dashboard (reads the gold rollup) -------------------------------------------

def dashboard_filter(gold: DataFrame, partners: list[str], start: str, end: str) -> DataFrame:
    """Partner in set AND date between (pushed to the partition filter on
    ``metric_date`` when gold is read from its partitioned layout)."""
    return gold.where(F.col("partner_id").isin(*partners)
                      & F.col("metric_date").between(F.lit(start).cast("date"),
                                                     F.lit(end).cast("date")))


def dashboard_table(gold: DataFrame) -> DataFrame:
    """T8 + L1: display columns, newest day first then partner."""
    return gold.select(*DISPLAY_COLUMNS).orderBy(F.col("metric_date").desc(), F.col("partner_id").asc())


def dashboard_kpis(gold: DataFrame) -> DataFrame:
    """One row of headline numbers."""
    return gold.agg(F.avg("dau").alias("avg_dau"),
                    F.sum("total_sessions").alias("total_sessions"),
                    F.sum("total_engagement_min").alias("engagement_minutes"),
                    F.sum("exercise_completions").alias("exercise_completions"))


def minutes_by_day(gold: DataFrame) -> DataFrame:
    """G9 + L3."""
    return (gold.groupBy("metric_date").agg(F.sum("total_engagement_min").alias("total_engagement_min"))
                .orderBy("metric_date"))


def completions_by_partner(gold: DataFrame) -> DataFrame:
    """G9 + L2."""
    return (gold.groupBy("partner_id").agg(F.sum("exercise_completions").alias("exercise_completions"))
                .orderBy(F.col("exercise_completions").desc(), F.col("partner_id")))


def dau_pivot(gold: DataFrame, partners: list[str]) -> DataFrame:
    """Date x partner matrix of DAU.  The value list is explicit, so the
    pivot needs no extra job to discover it."""
    return gold.groupBy("metric_date").pivot("partner_id", partners).agg(F.sum("dau")).orderBy("metric_date")


def dashboard_bounds(gold: DataFrame) -> DataFrame:
    """Date range and partner list of the gold table."""
    return gold.agg(F.min("metric_date").alias("min_date"), F.max("metric_date").alias("max_date"),
                    F.count_distinct("partner_id").alias("partners"),
                    F.array_join(F.sort_array(F.collect_set("partner_id")), ",").alias("partner_list"))


# -- window extras --------------------------------------------------------------------

def dau_trend(gold: DataFrame, days: int = 7) -> DataFrame:
    """Trailing ``days``-day mean of DAU (calendar range frame) and
    day-over-day change per partner.  The window is partitioned by partner
    over a table that has one row per partner-day, so it stays small."""
    by_day = Window.partitionBy("partner_id").orderBy(F.unix_date("metric_date"))
    rolling = by_day.rangeBetween(-(days - 1), 0)
    return gold.select("partner_id", "metric_date", "dau",
                       F.avg("dau").over(rolling).alias("dau_avg_7d"),
                       (F.col("dau") - F.lag("dau").over(by_day)).alias("dau_change"))


def partner_rank(gold: DataFrame) -> DataFrame:
    """Partners ranked per day by DAU."""
    w = Window.partitionBy("metric_date").orderBy(F.col("dau").desc())
    return gold.select("metric_date", "partner_id", "dau",
                       F.rank().over(w).alias("dau_rank"),
                       F.dense_rank().over(w).alias("dau_dense_rank"))


def top_types_by_count(silver: DataFrame, k: int = 3) -> DataFrame:
    """The k most frequent event types per partner (ties by name)."""
    counts = silver.groupBy("partner_id", "event_type").agg(F.count(F.lit(1)).alias("events"))
    w = Window.partitionBy("partner_id").orderBy(F.col("events").desc(), F.col("event_type"))
    return (counts.withColumn("type_rank", F.row_number().over(w))
                  .where(F.col("type_rank") <= k))


def retention_curve(silver: DataFrame) -> DataFrame:
    """Users active n days after their first day, by cohort week.

    The first day per user is a grouped aggregate joined back (a shuffle on
    user), not a window over all of a user's rows, so a heavy user never needs
    its whole history in one task's memory."""
    active = (silver.where(F.col("user_id").isNotNull())
                    .select("user_id", F.to_date("event_timestamp").alias("d")).distinct())
    first = active.groupBy("user_id").agg(F.min("d").alias("first_day"))
    return (active.join(first, "user_id")
                  .select(F.date_trunc("week", "first_day").cast("date").alias("cohort_week"),
                          F.datediff("d", "first_day").alias("day_n"), "user_id")
                  .groupBy("cohort_week", "day_n").agg(F.count_distinct("user_id").alias("users")))


def volume_anomalies(events: DataFrame, ts: str = "event_timestamp", window_days: int = 7,
                     drop_pct: float = 50.0) -> DataFrame:
    """Q6: daily volume against the mean of the previous ``window_days`` days;
    flagged when it drops by more than ``drop_pct`` percent."""
    daily = events.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("events"))
    w = Window.orderBy(F.unix_date("day")).rangeBetween(-window_days, -1)
    return (daily.withColumn("prev_avg", F.avg("events").over(w))
                 .withColumn("anomaly", F.coalesce(F.col("events") < F.col("prev_avg") * (1 - drop_pct / 100.0),
                                                   F.lit(False))))


def volume_vs_expected(events: DataFrame, expected_per_minute: float, alert_below_pct: float,
                       ts: str = "event_timestamp") -> DataFrame:
    """Q6, contract form: the day's mean rate per minute against the expected
    rate; an alert when it falls below ``alert_below_pct`` percent of it."""
    daily = events.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("events"))
    rate = F.col("events") / F.lit(1440.0)
    return daily.select("day", "events", rate.alias("events_per_minute"),
                        (rate < F.lit(expected_per_minute * alert_below_pct / 100.0)).alias("alert"))


def freshness(events: DataFrame, sla_minutes: float) -> DataFrame:
    """Q7: per day, exact p95 of ingest lag (seconds) and share inside the SLA."""
    lag = (F.unix_timestamp("ingest_timestamp") - F.unix_timestamp("event_timestamp")).alias("lag_s")
    return (events.select(F.to_date("event_timestamp").alias("day"), lag)
                  .groupBy("day")
                  .agg(F.count(F.lit(1)).alias("events"),
                       F.percentile("lag_s", 0.95).alias("p95_lag_s"),
                       F.avg(F.when(F.col("lag_s") <= sla_minutes * 60, 1.0).otherwise(0.0))
                        .alias("within_sla")))
