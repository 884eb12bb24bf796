"""Catalog part 2: quality checks, reference joins, sessions and journeys."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeward import products
from lakeward.catalog.common import VOCAB, dedup, gold_daily, oracle, present, query, raw, silver, silver_table
from lakeward.operators import checks, joins, journey, rollups, sessions
from lakeward.sources import fixture


def _report(df):
    return df.select("rule", "column", "actual", "threshold", "passed")


# -- quality checks -------------------------------------------------------------------

@query("quality_completeness", oracle("""
select 'completeness' as rule, 'event_id' as "column", round(avg(case when event_id is not null then 1.0 else 0.0 end), 6) as actual,
       cast(1.0 as double) as threshold, avg(case when event_id is not null then 1.0 else 0.0 end) >= 1.0 as passed from silver
union all
select 'completeness', 'user_id', round(avg(case when user_id is not null then 1.0 else 0.0 end), 6), cast(0.999 as double),
       avg(case when user_id is not null then 1.0 else 0.0 end) >= 0.999 from silver
"""))
def quality_completeness(spark, sf):
    """Q1: not-null shares against thresholds, one aggregate."""
    return _report(checks.evaluate(silver(spark, sf), [checks.completeness("event_id", 1.0),
                                                       checks.completeness("user_id", 0.999)]))


@query("quality_uniqueness", oracle("""
select 'raw' as table_name, round(count(distinct event_id) / count(*), 6) as actual, cast(1.0 as double) as threshold,
       count(distinct event_id) / count(*) >= 1.0 as passed from raw
union all
select 'silver', round(count(distinct event_id) / count(*), 6), cast(1.0 as double), count(distinct event_id) / count(*) >= 1.0 from silver
"""))
def quality_uniqueness(spark, sf):
    """Q2: distinct/total of event_id; fails on raw (re-deliveries), passes on silver."""
    rule = [checks.uniqueness(["event_id"], 1.0)]
    a = checks.evaluate(raw(spark, sf), rule).withColumn("table_name", F.lit("raw"))
    b = checks.evaluate(silver(spark, sf), rule).withColumn("table_name", F.lit("silver"))
    return a.unionByName(b).select("table_name", "actual", "threshold", "passed")


@query("schema_violations", oracle("""
select 'allowed_values' as rule, 'event_type' as "column",
       cast(sum(case when event_type is not null and event_type not in ('signup','purchase','error','view','click') then 1 else 0 end) as double) as actual
from silver
union all select 'not_null', 'event_timestamp', cast(sum(case when event_timestamp is null then 1 else 0 end) as double) from silver
union all select 'not_null', 'ingest_timestamp', cast(sum(case when ingest_timestamp is null then 1 else 0 end) as double) from silver
union all select 'not_null', 'partner_id', cast(sum(case when partner_id is null then 1 else 0 end) as double) from silver
union all select 'not_null', 'event_type', cast(sum(case when event_type is null then 1 else 0 end) as double) from silver
union all
select 'allowed_values', 'is_first_session',
       cast(sum(case when is_first_session is not null and is_first_session not in ('true','false') then 1 else 0 end) as double)
from silver
"""))
def schema_violations(spark, sf):
    """Q3: contract schema rules in one pass (user_id's NULLs are governed by
    its completeness threshold instead of NOT NULL)."""
    p = products.product("engagement_events")
    s = silver(spark, sf)
    return checks.evaluate(s, checks.schema_rules(s, p)).select("rule", "column", "actual")


@query("ref_check", oracle("""
select count(*) as rows, cast(sum(case when p.partner_id is not null then 1 else 0 end) as bigint) as matched,
       round(avg(case when p.partner_id is not null then 1.0 else 0.0 end), 6) as share
from silver s left join partners p on s.partner_id = p.partner_id
"""))
def ref_check(spark, sf):
    """Share of silver rows whose partner is a known partner."""
    return joins.reference_check(silver(spark, sf), fixture.partners(spark, sf), "partner_id")


@query("ghost_rows", oracle("""
select event_id, partner_id from silver s where not exists (select 1 from partners p where p.partner_id = s.partner_id)
"""))
def ghost_rows(spark, sf):
    """Rows of unknown partners (left anti join)."""
    return joins.unmatched_rows(silver(spark, sf), fixture.partners(spark, sf), "partner_id").select("event_id", "partner_id")


@query("known_rows", oracle("""
select event_id, partner_id from silver s where exists (select 1 from partners p where p.partner_id = s.partner_id)
"""))
def known_rows(spark, sf):
    """Rows of known partners (left semi join)."""
    return joins.matched_rows(silver(spark, sf), fixture.partners(spark, sf), "partner_id").select("event_id", "partner_id")


@query("business_rules", oracle("""
select 'dau_cannot_exceed_total_sessions' as rule, cast(sum(case when dau > total_sessions then 1 else 0 end) as double) as actual,
       cast(0.0 as double) as threshold, sum(case when dau > total_sessions then 1 else 0 end) = 0 as passed from gold
union all
select 'engagement_minutes_reasonable', cast(sum(case when total_engagement_min > dau * 24 * 60 then 1 else 0 end) as double),
       cast(0.0 as double), sum(case when total_engagement_min > dau * 24 * 60 then 1 else 0 end) = 0 from gold
"""))
def business_rules(spark, sf):
    """Q5: the dashboard contract's rules over the candidate rollup."""
    p = products.product("partner_dashboard")
    rules = [checks.violation_count(b["name"], b["violation"], b["expected"]) for b in p.quality.business_rules]
    return checks.evaluate(gold_daily(spark, sf), rules).select("rule", "actual", "threshold", "passed")


@query("pii_check", oracle("""
select 'pseudonym_format' as rule, 'user_id' as "column",
       round(avg(case when user_id is not null then (case when regexp_matches(user_id, '^[0-9a-f]{64}$') then 1.0 else 0.0 end) end), 6) as actual,
       cast(1.0 as double) as threshold,
       avg(case when user_id is not null then (case when regexp_matches(user_id, '^[0-9a-f]{64}$') then 1.0 else 0.0 end) end) >= 1.0 as passed
from silver
"""))
def pii_check(spark, sf):
    """Q9: every PII column of the contract holds pseudonyms only."""
    p = products.product("engagement_events")
    return _report(checks.evaluate(silver(spark, sf), [checks.pseudonym_format(c) for c in p.pii_columns()]))


@query("volume_anomalies", oracle("""
select day, events, round(prev_avg, 6) as prev_avg, coalesce(events < prev_avg * 0.5, false) as anomaly from (
  select day, events, avg(events) over (order by day range between interval 7 days preceding and interval 1 day preceding) as prev_avg
  from (select cast(event_timestamp as date) as day, count(*) as events from silver group by 1) d) x
"""))
def volume_anomalies(spark, sf):
    """Q6: daily volume against the previous 7 days' mean."""
    v = rollups.volume_anomalies(silver(spark, sf))
    return present(v, dbl_cols=["prev_avg"])


@query("volume_expected", oracle("""
select cast(event_timestamp as date) as day, count(*) as events, round(count(*) / 1440.0, 6) as events_per_minute,
       count(*) / 1440.0 < 8000 * 50 / 100.0 as alert
from silver group by 1
"""))
def volume_expected(spark, sf):
    """Q6 (contract): expected 8000 events/minute, alert below 50 %."""
    vol = products.product("engagement_events").quality.volume
    v = rollups.volume_vs_expected(silver(spark, sf), vol["expected_events_per_minute"], vol["alert_if_below_pct"])
    return present(v, dbl_cols=["events_per_minute"])


@query("freshness", oracle("""
select day, count(*) as events, round(quantile_cont(lag_s, 0.95), 6) as p95_lag_s,
       round(avg(case when lag_s <= 120 then 1.0 else 0.0 end), 6) as within_sla
from (select cast(event_timestamp as date) as day,
             cast(floor(epoch(ingest_timestamp)) as bigint) - cast(floor(epoch(event_timestamp)) as bigint) as lag_s
      from dedup) x group by day
"""))
def freshness(spark, sf):
    """Q7: exact p95 ingest lag and share inside the 2-minute SLA, per day."""
    f = rollups.freshness(dedup(spark, sf), sla_minutes=2)
    return present(f, dbl_cols=["p95_lag_s", "within_sla"])


# -- sessions ---------------------------------------------------------------------------

def _sessionized(spark, sf):
    return sessions.sessionize(silver_table(spark, sf).where(F.col("user_id").isNotNull()))


@query("session_gaps", oracle("""
select event_id, gap as gap_seconds, case when gap > 1800 then 1 else 0 end as new_session_flag from sessions
"""))
def session_gaps(spark, sf):
    """Previous timestamp per user and the whole-second gap flag."""
    return _sessionized(spark, sf).select("event_id", "gap_seconds", "new_session_flag")


@query("sessionize", oracle("""
select user_id, event_id, cast(sid as bigint) as derived_session_id from sessions
"""))
def sessionize(spark, sf):
    """Running session number per user (chunked, skew-safe plan)."""
    return _sessionized(spark, sf).select("user_id", "event_id", "derived_session_id")


SESSION_SUMMARY_SQL = """
select user_id, cast(sid as bigint) as derived_session_id, epoch_us(min(event_timestamp)) as session_start,
       epoch_us(max(event_timestamp)) as session_end, count(*) as events,
       cast(floor(epoch(max(event_timestamp))) as bigint) - cast(floor(epoch(min(event_timestamp))) as bigint) as duration_s
from sessions group by 1, 2
"""


@query("session_summary", oracle(SESSION_SUMMARY_SQL))
def session_summary(spark, sf):
    """Start, end, events and duration of every derived session."""
    return present(sessions.session_summary(_sessionized(spark, sf)), ts_cols=["session_start", "session_end"])


@query("session_window_batch", oracle("""
select user_id, epoch_us(min(event_timestamp)) as session_start,
       epoch_us(max(event_timestamp) + interval 30 minute) as session_end, count(*) as events
from (select *, sum(case when gap_us > 1800000000 then 1 else 0 end) over (partition by user_id order by event_timestamp) as ws
      from (select *, epoch_us(event_timestamp) - epoch_us(lag(event_timestamp) over (partition by user_id order by event_timestamp)) as gap_us
            from silver where user_id is not null) a) b
group by user_id, ws
"""))
def session_window_batch(spark, sf):
    """Spark's session_window over the same events (microsecond gaps)."""
    s = sessions.session_windows(silver_table(spark, sf).where(F.col("user_id").isNotNull()))
    return present(s, ts_cols=["session_start", "session_end"])


@query("events_in_session", oracle("""
select e.event_id, e.user_id, cast(p.sid as bigint) as derived_session_id
from silver e join (select user_id, sid, min(event_timestamp) as s_start, max(event_timestamp) as s_end
                    from sessions group by 1, 2) p on e.user_id = p.user_id and e.event_timestamp between p.s_start and p.s_end
"""))
def events_in_session(spark, sf):
    """Interval join of events to session spans (bucketed range join)."""
    spans = sessions.session_summary(_sessionized(spark, sf)).select(
        "user_id", "derived_session_id", "session_start", "session_end")
    ev = silver_table(spark, sf).where(F.col("user_id").isNotNull()).select("event_id", "user_id", "event_timestamp")
    j = joins.interval_join(ev, spans, "user_id", "event_timestamp", "session_start", "session_end")
    return j.select("event_id", "user_id", "derived_session_id")


# -- journeys -----------------------------------------------------------------------------

EVENTS_TEXT_SQL = ("string_agg(s.event_type || '@' || cast(epoch_us(s.event_timestamp) as varchar) || '@' || s.session_id, ','"
                   " order by s.event_timestamp, s.event_type, s.session_id)")

USER_DAY_SQL = f"""
select s.user_id as pseudonymized_user_id, s.partner_id, cast(s.event_timestamp as date) as journey_date,
       {EVENTS_TEXT_SQL} as events,
       cast(count(distinct s.sid) as int) as session_count,
       round(coalesce(sum(case when s.event_type = 'purchase' then s.duration_seconds / 60.0 else 0 end), 0), 6) as total_engagement_min
from sessions s group by 1, 2, 3
"""

STAGE_SQL = """case when session_count = 0 then 'churned' when session_count >= 5 then 'habitual'
            when session_count >= 3 then 'engaged' when total_engagement_min < 2 then 'lapsing' else 'exploring' end"""

SIGNUP_SQL = """
signup as (select user_id, coalesce(min(case when is_first_session = 'true' then cast(event_timestamp as date) end),
                                    min(cast(event_timestamp as date))) as signup_date
           from silver where user_id is not null group by 1),
ud as (""" + USER_DAY_SQL + """),
uj as (select ud.*, cast(datediff('day', su.signup_date, ud.journey_date) as int) as days_since_signup,
              """ + STAGE_SQL + """ as derived_stage
       from ud left join signup su on su.user_id = ud.pseudonymized_user_id),
ujt as (select *, concat_ws(',', case when days_since_signup <= 7 then 'new_user' end,
                                 case when session_count >= 5 then 'high_engagement' end,
                                 case when derived_stage = 'lapsing' then 'retention_risk' end) as cohort_tags from uj)
"""


def _events_text(df):
    return df.withColumn("events", F.array_join(F.transform(
        "events", lambda e: F.concat_ws("@", e["event_type"], F.unix_micros(e["ts"]).cast("string"),
                                        e["session_id"])), ","))


def _journey(spark, sf):
    return journey.user_journey(silver_table(spark, sf), VOCAB)


@query("user_day", oracle(USER_DAY_SQL))
def user_day(spark, sf):
    """User-day rows with sorted event structs, sessions, minutes."""
    u = journey.user_day(silver_table(spark, sf), VOCAB)
    return present(_events_text(u), dbl_cols=["total_engagement_min"])


@query("journey_events", oracle("""
select user_id as pseudonymized_user_id, partner_id, cast(event_timestamp as date) as journey_date, event_type,
       epoch_us(event_timestamp) as ts, session_id, cast(sid as bigint) as derived_session_id from sessions
"""))
def journey_events(spark, sf):
    """U1 normalized: one row per sessionized event with its user-day key,
    the scalable companion of the per-user-day ``events`` array."""
    return present(journey.journey_events(silver_table(spark, sf)), ts_cols=["ts"])


@query("journey_stage", oracle(f"""
select pseudonymized_user_id, partner_id, journey_date, session_count, total_engagement_min, {STAGE_SQL} as derived_stage
from ({USER_DAY_SQL}) ud
"""))
def journey_stage(spark, sf):
    """Resilience stage per user-day."""
    u = journey.derive_stage(journey.user_day(silver_table(spark, sf), VOCAB))
    return present(u.select("pseudonymized_user_id", "partner_id", "journey_date", "session_count",
                            "total_engagement_min", "derived_stage"), dbl_cols=["total_engagement_min"])


def _cte_plus(body: str) -> str:
    """Oracle prelude plus the journey CTEs (signup, ud, uj, ujt)."""
    return oracle("").rstrip() + ",\n" + SIGNUP_SQL.strip() + "\n" + body


@query("days_since_signup", _cte_plus("""
select pseudonymized_user_id, partner_id, journey_date, days_since_signup from uj
"""))
def days_since_signup(spark, sf):
    """U4: days from the user's signup (or first seen) day to the journey day."""
    s = silver_table(spark, sf)
    u = journey.days_since_signup(journey.user_day(s, VOCAB), s, VOCAB)
    return u.select("pseudonymized_user_id", "partner_id", "journey_date", "days_since_signup")


@query("cohort_tags", _cte_plus("""
select pseudonymized_user_id, partner_id, journey_date, cohort_tags from ujt
"""))
def cohort_tags(spark, sf):
    """Cohort tags of the contract's expression step."""
    j = _journey(spark, sf)
    return j.select("pseudonymized_user_id", "partner_id", "journey_date",
                    F.array_join("cohort_tags", ",").alias("cohort_tags"))


@query("user_journey", _cte_plus("""
select pseudonymized_user_id, partner_id, journey_date, days_since_signup, events, session_count,
       total_engagement_min, derived_stage, cohort_tags from ujt
"""))
def user_journey(spark, sf):
    """The complete journey product."""
    j = _events_text(_journey(spark, sf))
    return present(j, dbl_cols=["total_engagement_min"], arr_cols=["cohort_tags"])


@query("stage_counts", oracle(f"""
select {STAGE_SQL} as derived_stage, count(*) as user_days from ({USER_DAY_SQL}) ud group by 1
"""))
def stage_counts(spark, sf):
    """U2 summary: user-days per stage."""
    u = journey.derive_stage(journey.user_day(silver_table(spark, sf), VOCAB))
    return u.groupBy("derived_stage").agg(F.count(F.lit(1)).alias("user_days"))


@query("inactive_days", oracle("""
select a.user_id, cast(g.day as date) as day, 0 as session_count, 'churned' as derived_stage
from (select user_id, min(cast(event_timestamp as date)) as f, max(cast(event_timestamp as date)) as l
      from silver where user_id is not null group by 1) a,
     lateral (select unnest(generate_series(a.f, a.l, interval 1 day)) as day) g
where not exists (select 1 from silver s where s.user_id = a.user_id and cast(s.event_timestamp as date) = cast(g.day as date))
"""))
def inactive_days(spark, sf):
    """User-days without activity inside each user's active span."""
    return journey.inactive_days(silver_table(spark, sf))


@query("rule_stage", oracle(f"""
select cast(count(*) filter (where derived_stage not in ('onboarding','exploring','engaged','habitual','lapsing','churned')) as bigint)
       as violations from (select {STAGE_SQL} as derived_stage from ({USER_DAY_SQL}) ud) x
"""))
def rule_stage(spark, sf):
    """Q10: stage value inside the allowed list."""
    return journey.journey_rules(journey.derive_stage(journey.user_day(silver_table(spark, sf), VOCAB))) \
        .select(F.col("stage_must_be_valid").alias("violations"))


@query("rule_sessions", oracle("""
select cast(count(*) as bigint) as violations from (
  select s.user_id, s.partner_id, cast(s.event_timestamp as date) as d, count(distinct s.sid) as n, count(distinct s.session_id) as c
  from sessions s group by 1, 2, 3) x where n != c
"""))
def rule_sessions(spark, sf):
    """Q10: derived sessions vs client session ids (false by design: alert)."""
    return journey.journey_rules(journey.derive_stage(journey.user_day(silver_table(spark, sf), VOCAB))) \
        .select(F.col("session_count_matches_events").alias("violations"))
