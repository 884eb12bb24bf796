"""Catalog part 3: rollups at other grains, dashboard aggregations, window
extras, set operations and the scalar-function tour."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeward import products
from lakeward.catalog.common import (VOCAB, dedup, gold_table, oracle, present, query, raw,
                                     silver, silver_table)
from lakeward.model import load_product
from lakeward.operators import rollups, sets, sketches, steps
from lakeward.plans.runner import run_product
from lakeward.session import workspace
from lakeward.sources import fixture

DBL = ["total_engagement_min"]


@query("partner_hourly", oracle("""
select partner_id, epoch_us(date_trunc('hour', event_timestamp)) as metric_hour, count(*) as events,
       count(distinct user_id) as dau, count(distinct session_id) as total_sessions,
       round(coalesce(sum(case when event_type = 'purchase' then duration_seconds / 60.0 else 0 end), 0), 6) as total_engagement_min,
       cast(sum(case when event_type = 'click' then 1 else 0 end) as bigint) as exercise_completions
from silver group by 1, 2
"""))
def partner_hourly(spark, sf):
    """Partner-hour rollup."""
    return present(rollups.partner_hourly(silver(spark, sf), VOCAB), ts_cols=["metric_hour"], dbl_cols=DBL)


@query("partner_weekly", oracle("""
select partner_id, cast(date_trunc('week', event_timestamp) as date) as week_start,
       round(avg(duration_seconds / 60.0) filter (where event_type = 'purchase'), 6) as avg_session_min,
       count(distinct case when event_type = 'error' then user_id end) as high_intensity_users,
       count(distinct case when event_type = 'view' then user_id end) as drop_off_risk_users
from silver group by 1, 2
"""))
def partner_weekly(spark, sf):
    """Weekly outcomes with a filtered average and two conditional distincts."""
    return present(rollups.partner_weekly(silver(spark, sf), VOCAB), dbl_cols=["avg_session_min"])


@query("partner_subtotals", oracle("""
select partner_id, cast(event_timestamp as date) as metric_date,
       cast(grouping(partner_id, cast(event_timestamp as date)) as int) as level,
       count(*) as events, count(distinct user_id) as users
from silver group by rollup(partner_id, cast(event_timestamp as date))
"""))
def partner_subtotals(spark, sf):
    """Partner-day cells, partner totals and the grand total (ROLLUP)."""
    return rollups.partner_subtotals(silver(spark, sf)).withColumn("level", F.col("level").cast("int"))


@query("approx_dau", oracle("""
select partner_id, cast(event_timestamp as date) as metric_date, count(distinct user_id) as dau, true as within_bound
from silver group by 1, 2
"""))
def approx_dau(spark, sf):
    """Exact DAU and whether the HyperLogLog++ value lies within five
    standard errors (1 % each) of it, or one user."""
    both = rollups.approx_dau(silver(spark, sf))
    near = F.abs(F.col("dau_approx") - F.col("dau")) <= F.greatest(F.lit(1), 0.05 * F.col("dau"))
    return both.select("partner_id", "metric_date", "dau", near.alias("within_bound"))


@query("sketch_dau_range", oracle("""
select 'week' as span, partner_id, cast(date_trunc('week', event_timestamp) as date) as period_start, count(distinct user_id) as users, true as within_bound
from silver group by all
union all select 'month', partner_id, cast(date_trunc('month', event_timestamp) as date), count(distinct user_id), true from silver group by all
union all select 'mid-January', partner_id, date '2024-01-10', count(distinct user_id), true from silver
where cast(event_timestamp as date) between date '2024-01-10' and date '2024-01-20' group by all
"""))
def sketch_dau_range(spark, sf):
    """Users per week, month and any range of days from stored per-day sketches, folded in two loads of which the
    second comes twice; exact users beside them and whether the estimate is within five standard errors (8.1 %), or one user."""
    path = f"{workspace(spark, 'sketch_dau_range')}/users"
    s = silver_table(spark, sf)
    odd = F.crc32("event_id") % 2 == 1
    for load in (~odd, odd, odd):
        sketches.fold_users(spark, path, s.where(load))
    stored = spark.read.schema(sketches.USERS_DDL).parquet(path)
    out = None
    day, made = F.to_date("event_timestamp"), F.col("metric_date")
    mid = lambda d: d.between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-20").cast("date"))
    for span, start, keep in (("week", lambda d: F.date_trunc("week", d).cast("date"), None), ("month", lambda d: F.trunc(d, "month"), None),
                              ("mid-January", lambda d: F.lit("2024-01-10").cast("date"), mid)):
        approx = sketches.users_by(stored.where(keep(made)) if keep else stored, start(made))
        exact = (s.where(keep(day)) if keep else s).groupBy("partner_id", start(day).alias("period_start")).agg(F.count_distinct("user_id").alias("users"))
        near = F.abs(F.col("users_approx") - F.col("users")) <= F.greatest(F.lit(1.0), 0.081 * F.col("users"))
        one = exact.join(approx, ["partner_id", "period_start"]).select(F.lit(span).alias("span"), "partner_id", "period_start", "users",
                                                                       near.alias("within_bound"))
        out = one if out is None else out.unionByName(one)
    return out


@query("lag_over_runs", oracle("").rstrip() + """,
days as (select cast(event_timestamp as date) as day, epoch(ingest_timestamp) - epoch(event_timestamp) as lag from silver)
select cast(date_trunc('week', day) as date) as week, count(*) as rows, count(*) filter (where lag <= 120) as within_sla, true as near_p95
from days group by 1
""")
def lag_over_runs(spark, sf):
    """Q6/Q7: the engagement product in three runs; rows, rows inside the SLA and p95 of the lag per week from the metrics the
    runs kept, and whether that p95 lies between the exact 93rd and 97th percentiles."""
    root = workspace(spark, "lag_over_runs")
    spec = {**products.ENGAGEMENT_EVENTS, "quality": {**products.ENGAGEMENT_EVENTS["quality"], "on_failure": "warn"}}
    refs = {"silver.partners": fixture.partners(spark, sf)}
    events, third = raw(spark, sf), F.crc32("event_id") % 3
    for i in range(3):
        run_product(spark, load_product(spec), events.where(third == i), root, fixture.SALT, "ingest_timestamp", refs=refs, run_id=f"run-{i}")
    kept = spark.read.schema(sketches.LAG_DDL).parquet(f"{root}/_metrics")
    got = sketches.lag_quantile(kept, 0.95, F.date_trunc("week", "day").cast("date").alias("week"))
    stored = spark.read.parquet(f"{root}/silver/engagement_events").select(
        F.date_trunc("week", "event_timestamp").cast("date").alias("week"), F.expr(sketches.LAG).alias("lag"))
    exact = stored.groupBy("week").agg(F.percentile("lag", 0.93).alias("low"), F.percentile("lag", 0.97).alias("high"))
    return got.join(exact, "week").select("week", "rows", "within_sla", F.col("lag_s").between(F.floor("low"), F.ceil("high")).alias("near_p95"))


# -- dashboard --------------------------------------------------------------------------

GOLD_BASIC = """partner_id, metric_date, dau, total_sessions, round(total_engagement_min, 6) as total_engagement_min,
       exercise_completions, new_signups"""


@query("dashboard_filter", oracle(f"""
select {GOLD_BASIC} from gold
where partner_id in ('AUTOMOBILE', 'BUILDING', 'MACHINERY') and metric_date between date '2024-01-05' and date '2024-01-20'
"""))
def dashboard_filter(spark, sf):
    """Partner set and date range."""
    g = rollups.dashboard_filter(gold_table(spark, sf), ["AUTOMOBILE", "BUILDING", "MACHINERY"],
                                 "2024-01-05", "2024-01-20")
    return present(g.select(*rollups.DISPLAY_COLUMNS), dbl_cols=DBL)


@query("dashboard_table", oracle(f"select {GOLD_BASIC} from gold order by metric_date desc, partner_id"))
def dashboard_table(spark, sf):
    """Display columns, newest first."""
    return present(rollups.dashboard_table(gold_table(spark, sf)), dbl_cols=DBL)


@query("dashboard_kpis", oracle("""
select round(avg(dau), 6) as avg_dau, cast(sum(total_sessions) as bigint) as total_sessions,
       round(sum(total_engagement_min), 6) as engagement_minutes, cast(sum(exercise_completions) as bigint) as exercise_completions
from gold
"""))
def dashboard_kpis(spark, sf):
    """Headline numbers."""
    return present(rollups.dashboard_kpis(gold_table(spark, sf)), dbl_cols=["avg_dau", "engagement_minutes"])


@query("minutes_by_day", oracle("""
select metric_date, round(sum(total_engagement_min), 6) as total_engagement_min from gold group by 1 order by 1
"""))
def minutes_by_day(spark, sf):
    """Engagement minutes per day."""
    return present(rollups.minutes_by_day(gold_table(spark, sf)), dbl_cols=DBL)


@query("completions_by_partner", oracle("""
select partner_id, cast(sum(exercise_completions) as bigint) as exercise_completions from gold group by 1 order by 2 desc, 1
"""))
def completions_by_partner(spark, sf):
    """Completions per partner, largest first."""
    return rollups.completions_by_partner(gold_table(spark, sf))


@query("dau_pivot", oracle("""
select * from (pivot (select metric_date, partner_id, dau from gold) on partner_id using cast(sum(dau) as bigint) group by metric_date) order by metric_date
"""))
def dau_pivot(spark, sf):
    """Date x partner DAU matrix."""
    gold = gold_table(spark, sf)
    # the columns are the partners there are (one name each), so none is left out
    partners = [r[0] for r in gold.select("partner_id").distinct().orderBy("partner_id").collect()]
    return rollups.dau_pivot(gold, partners)


@query("dashboard_bounds", oracle("""
select min(metric_date) as min_date, max(metric_date) as max_date, count(distinct partner_id) as partners,
       array_to_string(list_sort(list_distinct(list(partner_id))), ',') as partner_list
from gold
"""))
def dashboard_bounds(spark, sf):
    """Date range and partner list."""
    return rollups.dashboard_bounds(gold_table(spark, sf))


@query("dau_trend", oracle("""
select partner_id, metric_date, dau,
       round(avg(dau) over (partition by partner_id order by metric_date range between interval 6 days preceding and current row), 6) as dau_avg_7d,
       dau - lag(dau) over (partition by partner_id order by metric_date) as dau_change
from gold
"""))
def dau_trend(spark, sf):
    """Trailing 7-day mean and day-over-day change of DAU."""
    return present(rollups.dau_trend(gold_table(spark, sf)), dbl_cols=["dau_avg_7d"])


@query("partner_rank", oracle("""
select metric_date, partner_id, dau, cast(rank() over (partition by metric_date order by dau desc) as int) as dau_rank,
       cast(dense_rank() over (partition by metric_date order by dau desc) as int) as dau_dense_rank
from gold
"""))
def partner_rank(spark, sf):
    """Partner rank per day by DAU."""
    return rollups.partner_rank(gold_table(spark, sf))


@query("top_types_by_count", oracle("""
select partner_id, event_type, events, cast(type_rank as int) as type_rank from (
  select partner_id, event_type, count(*) as events,
         row_number() over (partition by partner_id order by count(*) desc, event_type) as type_rank
  from silver group by 1, 2) x where type_rank <= 3
"""))
def top_types_by_count(spark, sf):
    """Three most frequent event types per partner."""
    return rollups.top_types_by_count(silver(spark, sf), 3)


@query("retention_curve", oracle("").rstrip() + """,
active as (select distinct user_id, cast(event_timestamp as date) as d from silver where user_id is not null),
firsts as (select user_id, min(d) as first_day from active group by 1)
select cast(date_trunc('week', f.first_day) as date) as cohort_week, cast(datediff('day', f.first_day, a.d) as int) as day_n,
       count(distinct a.user_id) as users
from active a join firsts f using (user_id) group by 1, 2
""")
def retention_curve(spark, sf):
    """Retention by signup-week cohort and day offset (reads its input
    twice, so it is fed the stored silver table)."""
    return rollups.retention_curve(silver_table(spark, sf))


@query("latest_events", oracle("""
select event_id, partner_id, event_type, epoch_us(event_timestamp) as event_timestamp from silver
order by event_timestamp desc, event_id limit 20
"""))
def latest_events(spark, sf):
    """L4: the newest 20 events for display (total order: time, then id).
    The limit is the feature here: a top-k report."""
    s = silver(spark, sf).orderBy(F.col("event_timestamp").desc(), F.col("event_id")).limit(20)
    return present(s.select("event_id", "partner_id", "event_type", "event_timestamp"), ts_cols=["event_timestamp"])


@query("profile_table", oracle("""
select count(*) as rows, count(distinct event_id) as distinct_events, count(distinct user_id) as distinct_users,
       cast(sum(case when user_id is null then 1 else 0 end) as bigint) as null_users,
       epoch_us(min(event_timestamp)) as min_ts, epoch_us(max(event_timestamp)) as max_ts,
       count(distinct partner_id) as partners
from silver
"""))
def profile_table(spark, sf):
    """One-pass profile of the silver table (count, distincts, range)."""
    s = silver(spark, sf)
    p = s.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("distinct_events"),
              F.count_distinct("user_id").alias("distinct_users"),
              F.sum(F.col("user_id").isNull().cast("bigint")).alias("null_users"),
              F.min("event_timestamp").alias("min_ts"), F.max("event_timestamp").alias("max_ts"),
              F.count_distinct("partner_id").alias("partners"))
    return present(p, ts_cols=["min_ts", "max_ts"])


# -- set operations ---------------------------------------------------------------------

@query("distinct_users", oracle("select distinct user_id from silver"))
def distinct_users(spark, sf):
    """Distinct pseudonyms (NULL is one value)."""
    return silver(spark, sf).select("user_id").distinct()


@query("common_users", oracle("""
select user_id from silver where cast(event_timestamp as date) = date '2024-01-01' and user_id is not null
intersect
select user_id from silver where cast(event_timestamp as date) = date '2024-01-02' and user_id is not null
"""))
def common_users(spark, sf):
    """Users active on both of two days (INTERSECT)."""
    s = silver(spark, sf).where(F.col("user_id").isNotNull()).withColumn("d", F.to_date("event_timestamp"))
    return sets.present_in_all(s, "user_id", "d", [F.lit("2024-01-01").cast("date"),
                                                   F.lit("2024-01-02").cast("date")])


LEGACY_SQL = """
legacy as (
  select * from (select *, row_number() over (partition by event_id order by ingest_timestamp asc) as rn2 from raw) x
  where rn2 = 1 and event_timestamp >= ingest_timestamp - interval '7' day
),
fresh as (select * from dedup where event_timestamp >= ingest_timestamp - interval '7' day)
"""


def _legacy_silver(spark, sf):
    """The legacy pipeline kept the first delivery of a duplicated event."""
    raw = fixture.raw_events(spark, sf).withColumn("__neg", -F.unix_micros("ingest_timestamp"))
    first = steps.dedup_latest(raw, ["event_id"], "__neg").drop("__neg")
    kept, _ = steps.split_by(first, fixture.late_predicate(), "late")
    return kept


def _fresh_silver(spark, sf):
    kept, _ = steps.split_by(dedup(spark, sf), fixture.late_predicate(), "late")
    return kept


@query("parity_except", oracle("").rstrip() + "," + LEGACY_SQL + """
select 'legacy_only' as side, event_id, epoch_us(ingest_timestamp) as ingest_timestamp from
  (select event_id, ingest_timestamp from legacy except all select event_id, ingest_timestamp from fresh) a
union all
select 'new_only', event_id, epoch_us(ingest_timestamp) from
  (select event_id, ingest_timestamp from fresh except all select event_id, ingest_timestamp from legacy) b
""")
def parity_except(spark, sf):
    """Rows only in the legacy table and rows only in the new one (EXCEPT ALL both ways)."""
    cols = ["event_id", "ingest_timestamp"]
    d = sets.difference_both_ways(_legacy_silver(spark, sf).select(*cols), _fresh_silver(spark, sf).select(*cols),
                                  "legacy_only", "new_only")
    return present(d.select("side", *cols), ts_cols=["ingest_timestamp"])


@query("union_versions", oracle("""
select 'v1' as version, event_id, null::double as clinical_intensity, duration_seconds as duration_v1, null::int as duration_v2 from silver
union all
select 'v2', event_id, null::double, null::double,
       case when event_type = 'purchase' then try_cast(cast(cast(duration_seconds as bigint) as varchar) as int) end
from silver
"""))
def union_versions(spark, sf):
    """v1 and v2 events side by side during the double-write window
    (``unionByName(allowMissingColumns=True)``); both versions read the stored
    silver table, so the dedup runs once."""
    from lakeward.plans import evolution

    s = silver_table(spark, sf)
    v1 = s.select(F.lit("v1").alias("version"), "event_id", F.col("duration_seconds").alias("duration_v1"))
    v2 = evolution.to_v2(s).select(F.lit("v2").alias("version"), "event_id", "clinical_intensity",
                                   F.col("event_properties.duration_seconds").alias("duration_v2"))
    return sets.union_versions(v1, v2).select("version", "event_id", "clinical_intensity", "duration_v1", "duration_v2")


@query("scalar_tour", oracle("""
select event_id,
       cast(event_timestamp as date) as d,
       cast(floor(epoch(event_timestamp)) as bigint) as unix_s,
       cast(date_trunc('week', event_timestamp) as date) as week_start,
       epoch_us(event_timestamp - interval '7' day) as minus_7d,
       coalesce(duration_seconds, 0.0) / 60.0 as minutes,
       case when event_type in ('purchase', 'click') then 'core' when event_type = 'error' then 'error' end as kind,
       event_type not in ('error') as not_error,
       json_extract_string(json_object('k', event_type), '$.k') as prop_k,
       array_to_string(list_slice(list_sort(list_distinct([event_type, partner_id, event_type])), 1, 2), ',') as sorted_slice,
       len(list_distinct([event_type, partner_id])) as n_distinct,
       sha256('x' || event_id) as hashed
from silver
"""))
def scalar_tour(spark, sf):
    """2.9: the scalar functions the products use, in one projection."""
    j = silver(spark, sf).withColumn(
        "bag", F.from_json(F.to_json(F.struct(F.col("event_type").alias("k"))), "map<string,string>"))
    arr = F.array("event_type", "partner_id", "event_type")
    return j.select(
        "event_id",
        F.to_date("event_timestamp").alias("d"),
        F.unix_timestamp("event_timestamp").alias("unix_s"),
        F.date_trunc("week", "event_timestamp").cast("date").alias("week_start"),
        F.unix_micros(F.col("event_timestamp") - F.expr("interval 7 days")).alias("minus_7d"),
        (F.coalesce("duration_seconds", F.lit(0.0)) / 60.0).alias("minutes"),
        F.when(F.col("event_type").isin("purchase", "click"), "core")
         .when(F.col("event_type") == "error", "error").alias("kind"),
        (~F.col("event_type").isin("error")).alias("not_error"),
        F.col("bag")["k"].alias("prop_k"),
        F.array_join(F.slice(F.sort_array(F.array_distinct(arr)), 1, 2), ",").alias("sorted_slice"),
        F.size(F.array_distinct(F.array("event_type", "partner_id"))).cast("bigint").alias("n_distinct"),
        F.sha2(F.concat(F.lit("x"), F.col("event_id")), 256).alias("hashed"),
    )
