"""Catalog part 1: the engagement product itself (land, dedup, late split,
pseudonymize) and the partner-day rollup."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeward.catalog.common import VOCAB, dedup, gold_daily, oracle, present, query, raw, silver
from lakeward.functions.expressions import epoch_micros, pseudonym
from lakeward.operators import rollups, steps
from lakeward.sources import fixture

GOLD_SQL = oracle("""
select partner_id, metric_date, dau, total_sessions, round(total_engagement_min, 6) as total_engagement_min,
       exercise_completions, new_signups, array_to_string(top_event_types, ',') as top_event_types
from gold
""")


@query("partner_daily", GOLD_SQL)
def partner_daily(spark, sf):
    """G1 (flagship): partner-day rollup of the silver events."""
    return present(gold_daily(spark, sf), dbl_cols=["total_engagement_min"], arr_cols=["top_event_types"])


@query("partner_daily_basic", oracle("""
select partner_id, metric_date, dau, total_sessions, round(total_engagement_min, 6) as total_engagement_min,
       exercise_completions
from gold
"""))
def partner_daily_basic(spark, sf):
    """The demo query's subset of the rollup."""
    g = rollups.partner_daily(silver(spark, sf), VOCAB, extended=False)
    return present(g, dbl_cols=["total_engagement_min"])


@query("top_event_types", oracle("""
select partner_id, metric_date, array_to_string(top_event_types, ',') as top_event_types from gold
"""))
def top_event_types(spark, sf):
    """Alphabetical first five distinct event types per partner-day."""
    g = (silver(spark, sf).groupBy("partner_id", F.to_date("event_timestamp").alias("metric_date"))
         .agg(F.slice(F.sort_array(F.collect_set("event_type")), 1, 5).alias("top_event_types")))
    return present(g, arr_cols=["top_event_types"])


SILVER_COLS = """event_id, epoch_us(event_timestamp) as event_timestamp, epoch_us(ingest_timestamp) as ingest_timestamp,
       user_id, partner_id, event_type, session_id, duration_seconds, is_first_session"""


@query("silver_events", oracle(f"select {SILVER_COLS} from silver"))
def silver_events(spark, sf):
    """The step walker's output, the silver engagement product."""
    return present(silver(spark, sf), ts_cols=["event_timestamp", "ingest_timestamp"])


@query("land_events", oracle("""
select event_id, epoch_us(event_timestamp) as event_timestamp, epoch_us(ingest_timestamp) as ingest_timestamp,
       user_id, partner_id, event_type, copy, cast(ingest_timestamp as date) as ingest_date
from raw
"""))
def land_events(spark, sf):
    """Every delivery landed as JSON lines and read back with the contract
    schema + ``_corrupt_record``; well-formed rows get their ingest_date."""
    from lakeward.session import workspace
    from lakeward.sources import landing

    path = landing.write_landing(raw(spark, sf), f"{workspace(spark, 'land_events')}/landing")
    r, _ = landing.read_json_events(spark, path)
    return present(r.select("event_id", "event_timestamp", "ingest_timestamp", "user_id", "partner_id",
                            "event_type", "copy", "ingest_date"),
                   ts_cols=["event_timestamp", "ingest_timestamp"])


@query("dedup_latest", oracle("""
select event_id, epoch_us(ingest_timestamp) as ingest_timestamp, copy from dedup
"""))
def dedup_latest(spark, sf):
    """Latest delivery per event_id."""
    return present(dedup(spark, sf).select("event_id", "ingest_timestamp", "copy"), ts_cols=["ingest_timestamp"])


@query("filter_late", oracle("""
select event_id, epoch_us(event_timestamp) as event_timestamp, copy
from dedup where event_timestamp >= ingest_timestamp - interval '7' day
"""))
def filter_late(spark, sf):
    """Rows inside the 7-day lateness bound (as-of = ingest time)."""
    kept, _ = steps.split_by(dedup(spark, sf), fixture.late_predicate(), "late_event_handling")
    return present(kept.select("event_id", "event_timestamp", "copy"), ts_cols=["event_timestamp"])


@query("quarantine_late", oracle("""
select event_id, sha256('salt' || user_id) as user_id, partner_id,
       case when (event_timestamp >= ingest_timestamp - interval '7' day) is null
            then 'late_event_handling:null' else 'late_event_handling' end as reject_reason,
       cast(floor(epoch(ingest_timestamp) - epoch(event_timestamp)) as bigint) // 86400 as lag_days
from late
"""))
def quarantine_late(spark, sf):
    """The complement of the late filter, pseudonymized, with reason."""
    _, rej = steps.split_by(dedup(spark, sf), fixture.late_predicate(), "late_event_handling")
    rej = steps.pseudonymize(rej, "user_id", fixture.SALT)
    lag = F.floor((F.unix_micros("ingest_timestamp") - F.unix_micros("event_timestamp")) / 1e6).cast("bigint")
    return rej.select("event_id", "user_id", "partner_id",
                      F.col(steps.REJECT_REASON).alias("reject_reason"),
                      F.floor(lag / 86400).cast("bigint").alias("lag_days"))


@query("pseudonymize", oracle("""
select distinct user_id as raw_user_id, sha256('salt' || user_id) as user_id from dedup
"""))
def pseudonymize(spark, sf):
    """Raw id -> salted SHA-256 pseudonym (NULL stays NULL)."""
    d = dedup(spark, sf).select(F.col("user_id").alias("raw_user_id")).distinct()
    return d.select("raw_user_id", pseudonym("raw_user_id", fixture.SALT).alias("user_id"))


@query("raw_to_silver_counts", oracle("""
select (select count(*) from raw) as raw_rows, (select count(*) from dedup) as dedup_rows,
       (select count(*) from late) as late_rows, (select count(*) from silver) as silver_rows
"""))
def raw_to_silver_counts(spark, sf):
    """P2-style accounting: rows in, deduplicated, quarantined, out (one pass:
    per-key copies and the latest copy's lateness, then a global sum)."""
    late = ~F.coalesce(F.expr(fixture.late_predicate()), F.lit(False))
    per_key = (raw(spark, sf).groupBy("event_id")
               .agg(F.count(F.lit(1)).alias("copies"),
                    F.max_by(late, F.unix_micros("ingest_timestamp") * 2 + (F.col("copy") == 0).cast("long"))
                     .alias("late")))
    return per_key.agg(F.sum("copies").alias("raw_rows"), F.count(F.lit(1)).alias("dedup_rows"),
                       F.sum(F.col("late").cast("bigint")).alias("late_rows"),
                       F.sum((~F.col("late")).cast("bigint")).alias("silver_rows"))
