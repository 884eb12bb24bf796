"""Catalog part 5: streaming queries.  Each one lands the fixture's raw
deliveries (derived by Spark from the driver tables) as JSON files in a fresh
workspace folder, runs the stream with ``availableNow`` to completion and
returns the sink read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeward import products
from lakeward.catalog.common import CTE, ORACLE, VOCAB, oracle, present, query, raw, silver
from lakeward.catalog.core import GOLD_SQL
from lakeward.model import load_product
from lakeward.plans import erasure
from lakeward.session import workspace
from lakeward.sinks import changes, writes
from lakeward.sources import fixture
from lakeward.streaming import double_write as double_write_job
from lakeward.streaming import jobs, stage_state


def _landing(spark, sf, name):
    root = workspace(spark, name)
    jobs.write_landing(raw(spark, sf), f"{root}/landing")
    return root


@query("stream_land", oracle("""
select event_id, copy, cast(ingest_timestamp as date) as ingest_date from raw
"""))
def stream_land(spark, sf):
    """Streaming landing; well-formed rows to bronze, malformed to quarantine."""
    root = _landing(spark, sf, "stream_land")
    out = jobs.land(spark, f"{root}/landing", root, f"{root}/_ckpt/land")
    return spark.read.parquet(out["bronze"]).select("event_id", "copy", "ingest_date")


@query("stream_replayed", oracle("""
select 'bronze' as sink, count(*) as rows, count(distinct event_id || '/' || copy) as deliveries from raw
union all select 'late', count(*), count(distinct event_id || '/' || copy) from raw
where not coalesce(event_timestamp >= ingest_timestamp - interval '7' day, false)
"""))
def stream_replayed(spark, sf):
    """Two loads landed, then all of it read again under a new checkpoint, then a third load under that one:
    the ledger lets every delivery through once."""
    root = workspace(spark, "stream_replayed")
    day = F.dayofmonth("ingest_timestamp") % 3
    for load, ckpt in ((0, "a"), (1, "a"), (None, "b"), (2, "b")):
        if load is not None:
            jobs.write_landing(raw(spark, sf).where(day == load), f"{root}/landing")
        bronze = jobs.land(spark, f"{root}/landing", root, f"{root}/_ckpt/land-{ckpt}", fixture.SALT)["bronze"]
        late = jobs.quarantine_late(spark, f"{root}/landing", root, f"{root}/_ckpt/late-{ckpt}", salt=fixture.SALT)
    count = lambda sink, path: spark.read.parquet(path).agg(
        F.lit(sink).alias("sink"), F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.concat_ws("/", "event_id", "copy")).alias("deliveries"))
    return count("bronze", bronze).unionByName(count("late", late))


@query("stream_late", oracle("""
select event_id, copy, 'late_event_handling' as reject_reason from raw
where not coalesce(event_timestamp >= ingest_timestamp - interval '7' day, false)
"""))
def stream_late(spark, sf):
    """Late deliveries split off before the watermark (every copy)."""
    root = _landing(spark, sf, "stream_late")
    path = jobs.quarantine_late(spark, f"{root}/landing", root, f"{root}/_ckpt/late")
    return spark.read.parquet(path).select("event_id", "copy", F.col("__reject_reason").alias("reject_reason"))


@query("stream_dedup", oracle("").rstrip() + """,
first_arrival as (
  select * from (select *, row_number() over (partition by event_id order by ingest_timestamp asc) as rn2 from raw
                 where event_timestamp >= ingest_timestamp - interval '7' day) x where rn2 = 1
)
select event_id, epoch_us(ingest_timestamp) as ingest_timestamp, sha256('salt' || user_id) as user_id from first_arrival
""")
def stream_dedup(spark, sf):
    """R2: dropDuplicatesWithinWatermark on event_id (first arrival survives)."""
    root = _landing(spark, sf, "stream_dedup")
    path = jobs.dedup_to_table(spark, f"{root}/landing", root, f"{root}/_ckpt/dedup", fixture.SALT)
    return present(spark.read.parquet(path).select("event_id", "ingest_timestamp", "user_id"),
                   ts_cols=["ingest_timestamp"])


@query("stream_rollup", GOLD_SQL)
def stream_rollup(spark, sf):
    """Exact partner-day rollup maintained by recomputing touched keys."""
    root = _landing(spark, sf, "stream_rollup")
    out = jobs.exact_rollup(spark, f"{root}/landing", root, f"{root}/_ckpt/rollup", fixture.SALT, VOCAB)
    g = spark.read.schema(jobs.GOLD_DDL).parquet(out["gold"])
    return present(g.select("partner_id", "metric_date", "dau", "total_sessions", "total_engagement_min",
                            "exercise_completions", "new_signups", "top_event_types"),
                   dbl_cols=["total_engagement_min"], arr_cols=["top_event_types"])


@query("stream_serving", oracle("""
select metric_date, partner_id, dau, total_sessions, round(total_engagement_min, 6) as total_engagement_min from gold
"""))
def stream_serving(spark, sf):
    """K8: the serving extract kept by ``foreachBatch`` next to the streaming gold."""
    root = _landing(spark, sf, "stream_serving")
    out = jobs.exact_rollup(spark, f"{root}/landing", root, f"{root}/_ckpt/serving", fixture.SALT, VOCAB, serving=True)
    g = spark.read.schema(jobs.GOLD_DDL).parquet(out["serving"])
    return present(g.select("metric_date", "partner_id", "dau", "total_sessions", "total_engagement_min"),
                   dbl_cols=["total_engagement_min"])


WINDOWS_SQL = """
select partner_id, epoch_us(ws) as window_start, epoch_us(ws + interval 1 hour) as window_end, count(*) as deliveries
from (select partner_id, time_bucket(interval '{slide}', event_timestamp) - k * interval '{slide}' as ws, event_timestamp
      from raw, range(0, {steps}) r(k) where event_timestamp >= ingest_timestamp - interval '7' day) x
where event_timestamp >= ws and event_timestamp < ws + interval 1 hour
  and ws + interval 1 hour <= (select date_trunc('milliseconds', max(event_timestamp)) - interval 7 day from raw
                               where event_timestamp >= ingest_timestamp - interval '7' day)
group by 1, 2, 3
"""


@query("stream_hourly", oracle(WINDOWS_SQL.format(slide="1 hour", steps=1)))
def stream_hourly(spark, sf):
    """Tumbling 1-hour windows per partner, append mode (final windows only)."""
    root = _landing(spark, sf, "stream_hourly")
    path = jobs.windowed_counts(spark, f"{root}/landing", root, f"{root}/_ckpt/hourly", fixture.SALT)
    return present(spark.read.parquet(path).select("partner_id", "window_start", "window_end", "deliveries"),
                   ts_cols=["window_start", "window_end"])


@query("stream_sliding", oracle(WINDOWS_SQL.format(slide="15 minutes", steps=4)))
def stream_sliding(spark, sf):
    """Sliding 1-hour windows every 15 minutes, append mode."""
    root = _landing(spark, sf, "stream_sliding")
    path = jobs.windowed_counts(spark, f"{root}/landing", root, f"{root}/_ckpt/sliding", fixture.SALT,
                                slide="15 minutes")
    return present(spark.read.parquet(path).select("partner_id", "window_start", "window_end", "deliveries"),
                   ts_cols=["window_start", "window_end"])


@query("sliding_batch", oracle("""
select partner_id, epoch_us(ws) as window_start, epoch_us(ws + interval 1 hour) as window_end, count(*) as deliveries
from (select partner_id, time_bucket(interval '15 minutes', event_timestamp) - k * interval '15 minutes' as ws, event_timestamp
      from raw, range(0, 4) r(k) where event_timestamp >= ingest_timestamp - interval '7' day) x
where event_timestamp >= ws and event_timestamp < ws + interval 1 hour
group by 1, 2, 3
"""))
def sliding_batch(spark, sf):
    """R5 batch twin: the same sliding windows over all on-time deliveries."""
    r = raw(spark, sf)
    ok = r.where(F.coalesce(F.expr(fixture.late_predicate()), F.lit(False)))
    w = ok.groupBy("partner_id", F.window("event_timestamp", "1 hour", "15 minutes").alias("w")) \
          .agg(F.count(F.lit(1)).alias("deliveries"))
    return present(w.select("partner_id", F.col("w.start").alias("window_start"),
                            F.col("w.end").alias("window_end"), "deliveries"),
                   ts_cols=["window_start", "window_end"])


@query("stream_sessions", oracle("""
select * from (
  select user_id, epoch_us(min(event_timestamp)) as session_start,
         epoch_us(max(event_timestamp) + interval 30 minute) as session_end, count(*) as events
  from (select *, sum(case when gap_us > 1800000000 then 1 else 0 end) over (partition by user_id order by event_timestamp) as ws
        from (select *, epoch_us(event_timestamp) - epoch_us(lag(event_timestamp) over (partition by user_id order by event_timestamp)) as gap_us
              from silver where user_id is not null) a) b
  group by user_id, ws) s
where session_end <= (select epoch_us(date_trunc('milliseconds', max(event_timestamp)) - interval 7 day) from raw
                      where event_timestamp >= ingest_timestamp - interval '7' day)
"""))
def stream_sessions(spark, sf):
    """Streaming session windows per user (open sessions not emitted)."""
    root = _landing(spark, sf, "stream_sessions")
    path = jobs.session_windows(spark, f"{root}/landing", root, f"{root}/_ckpt/sessions", fixture.SALT)
    return present(spark.read.parquet(path), ts_cols=["session_start", "session_end"])


@query("stream_stage", oracle("").rstrip() + """,
ok as (
  select distinct event_id, event_timestamp, cast(event_timestamp as date) as journey_date, event_type, duration_seconds,
         sha256('salt' || user_id) as user_id
  from raw where user_id is not null and event_timestamp >= ingest_timestamp - interval '7' day
),
gaps as (
  select *, cast(floor(epoch(event_timestamp)) as bigint)
            - cast(floor(epoch(lag(event_timestamp) over (partition by user_id, journey_date order by event_timestamp))) as bigint) as gap
  from ok
),
days as (
  select user_id, journey_date, cast(1 + sum(case when gap > 1800 then 1 else 0 end) as int) as session_count,
         coalesce(sum(case when event_type = 'purchase' then duration_seconds end), 0) / 60.0 as minutes
  from gaps group by 1, 2
)
select user_id, journey_date, session_count, round(minutes, 6) as total_engagement_min,
       case when session_count >= 5 then 'habitual' when session_count >= 3 then 'engaged'
            when minutes < 2 then 'lapsing' else 'exploring' end as derived_stage
from days
""")
def stream_stage(spark, sf):
    """The latest stage per user-day after three loads in order of arrival."""
    root = workspace(spark, "stream_stage")
    rows = raw(spark, sf)
    seen = F.col("ingest_timestamp")
    first, second = (F.lit(d).cast("timestamp") for d in ("2024-01-11", "2024-01-21"))
    for load in (seen < first, (seen >= first) & (seen < second), seen >= second):
        jobs.write_landing(rows.where(load), f"{root}/landing")
        path = jobs.running_stage(spark, f"{root}/landing", root, f"{root}/_ckpt/stage", fixture.SALT, VOCAB)
    return present(spark.read.schema(jobs.STAGE_DDL).parquet(path), dbl_cols=["total_engagement_min"])


@query("stream_stage_state", ORACLE["stream_stage"])
def stream_stage_state(spark, sf):
    """R7 with keyed state: the same stages from spans kept per (user, day), three loads in order of arrival."""
    root = workspace(spark, "stream_stage_state")
    rows = raw(spark, sf)
    seen = F.col("ingest_timestamp")
    first, second = (F.lit(d).cast("timestamp") for d in ("2024-01-11", "2024-01-21"))
    for load in (seen < first, (seen >= first) & (seen < second), seen >= second):
        jobs.write_landing(rows.where(load), f"{root}/landing")
        path, _ = stage_state.run(spark, f"{root}/landing", root, f"{root}/_ckpt/stage", fixture.SALT, VOCAB)
    return present(spark.read.schema(jobs.STAGE_DDL).parquet(path), dbl_cols=["total_engagement_min"])


@query("double_write", oracle("""
select 'old' as side, event_type, null as reason, count(*) as rows, true as all_commits_match from raw group by 2
union all
select case when reason is null then 'new' else 'rejected' end, event_type, reason, count(*), true
from (select event_type, case when user_id is null then 'user_id: missing' when event_type = 'error' then 'event_type: value not allowed' end as reason from raw) x
group by 1, 2, 3
"""))
def double_write(spark, sf):
    """Two loads written under the old and the proposed contract at once; rows by side, type and reason, and whether
    the parity rows of all commits agree."""
    root = workspace(spark, "double_write")
    old, new = load_product(products.ENGAGEMENT_EVENTS_V1_BAG), load_product(products.ENGAGEMENT_EVENTS_V2)
    rows = raw(spark, sf)
    cut = F.col("ingest_timestamp") < F.lit("2024-01-15").cast("timestamp")
    for load in (cut, ~cut):
        jobs.write_landing(rows.where(load), f"{root}/landing")
        out = double_write_job.run(spark, f"{root}/landing", root, f"{root}/_ckpt/double", old, new, fixture.SALT)
    sides = [spark.read.schema(f"{p.ddl()}, {double_write_job.REASON} string").parquet(out[side])
             .select(F.lit(side).alias("side"), "event_type", F.col(double_write_job.REASON).alias("reason"))
             for side, p in (("old", old), ("new", new), ("rejected", new))]
    match = spark.read.schema(double_write_job.PARITY_DDL).parquet(out["parity"]).agg(F.bool_and("matches").alias("all_commits_match"))
    counts = sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy("side", "event_type", "reason").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(match, F.lit(True))


@query("stream_volume", oracle("""
select count(*) as rows, count(*) filter (where lag <= 120) as within_sla, max(lag) as max_lag_s
from (select cast(floor(epoch(ingest_timestamp)) as bigint) - cast(floor(epoch(event_timestamp)) as bigint) as lag from raw) x
"""))
def stream_volume(spark, sf):
    """Volume and freshness of the stream, totalled over the stored
    metrics row of each micro-batch; one row."""
    root = _landing(spark, sf, "stream_volume")
    m = jobs.observed_metrics(spark, f"{root}/landing", f"{root}/_ckpt/volume")
    return spark.createDataFrame([(m["rows"], m["within_sla"], m["max_lag_s"])],
                                 "rows bigint, within_sla bigint, max_lag_s bigint")


@query("stream_silver_rollup", GOLD_SQL)
def stream_silver_rollup(spark, sf):
    """Silver appended in two loads; the dashboard rollup follows the
    silver table as a stream (two runs of the same query, one checkpoint)."""
    from lakeward.catalog.common import silver

    root = workspace(spark, "stream_silver_rollup")
    spath = f"{root}/silver"
    s = silver(spark, sf).withColumn("event_date", F.to_date("event_timestamp")).select(
        *[c.split()[0] for c in jobs.SILVER_DDL.split(", ")])
    cut = F.lit("2024-01-16").cast("date")
    s.where(F.col("event_date") < cut).write.mode("append").partitionBy("event_date").parquet(spath)
    ckpt = f"{root}/_ckpt/silver_rollup"
    jobs.rollup_from_silver_stream(spark, spath, root, ckpt, VOCAB)
    s.where(F.col("event_date") >= cut).write.mode("append").partitionBy("event_date").parquet(spath)
    gold = jobs.rollup_from_silver_stream(spark, spath, root, ckpt, VOCAB)
    g = spark.read.schema(jobs.GOLD_DDL).parquet(gold)
    return present(g.select("partner_id", "metric_date", "dau", "total_sessions", "total_engagement_min",
                            "exercise_completions", "new_signups", "top_event_types"),
                   dbl_cols=["total_engagement_min"], arr_cols=["top_event_types"])


CHANGED_GOLD_SQL = CTE.rstrip() + """,
silver2 as (
  select event_id, event_timestamp, user_id, session_id, duration_seconds, is_first_session,
         case when cast(event_id as int) % 31 = 0 then 'moved-partner' else partner_id end as partner_id,
         case when cast(event_id as int) % 37 = 0 then 'click' else event_type end as event_type
  from silver where user_id is distinct from sha256('salt' || '7')
),
""" + CTE[CTE.index("gold as ("):].replace("gold as (", "gold2 as (").replace("from silver ", "from silver2 ") + """
select partner_id, metric_date, dau, total_sessions, round(total_engagement_min, 6) as total_engagement_min, exercise_completions,
       new_signups, array_to_string(top_event_types, ',') as top_event_types from gold2
"""


@query("stream_changes", CHANGED_GOLD_SQL)
def stream_changes(spark, sf):
    """The dashboard follows silver's change log over four loads: the first rows; updates that move events to another partner
    and change event types; the same updates again under the same commit; the erasure of a user."""
    root = workspace(spark, "stream_changes")
    path, log = f"{root}/silver", f"{root}/changes"
    cols = [c.split()[0] for c in jobs.SILVER_DDL.split(", ")]
    rows = silver(spark, sf).withColumn("event_date", F.to_date("event_timestamp")).select(*cols)
    number = F.col("event_id").cast("int")
    edits = rows.where((number % 31 == 0) | (number % 37 == 0)).withColumns({
        "partner_id": F.when(number % 31 == 0, F.lit("moved-partner")).otherwise(F.col("partner_id")),
        "event_type": F.when(number % 37 == 0, F.lit("click")).otherwise(F.col("event_type"))})

    def merge(batch, commit):
        writes.upsert(spark, path, batch, ["event_id"], ["event_date"], schema=jobs.SILVER_DDL, fixed=["event_date"], log=changes.ChangeLog(log, commit))

    def erase(commit):
        keys = erasure.subjects(spark, spark.createDataFrame([("7",)], "id string"), "id", fixture.SALT)
        target = erasure.Target("silver", path, "user_id", ("event_date",), jobs.SILVER_DDL)
        erasure.erase_subjects(spark, [target], keys, f"{root}/audit", "2024-02-01 00:00:00", logs={"silver": changes.ChangeLog(log, commit)})

    for load in (lambda: merge(rows, "load-1"), lambda: merge(edits, "load-2"), lambda: merge(edits, "load-2"), lambda: erase("erase-1")):
        load()
        gold = jobs.rollup_from_changes(spark, log, path, root, f"{root}/_ckpt/changes", VOCAB)
    g = spark.read.schema(jobs.GOLD_DDL).parquet(gold)
    return present(g.select("partner_id", "metric_date", "dau", "total_sessions", "total_engagement_min", "exercise_completions",
                            "new_signups", "top_event_types"), dbl_cols=["total_engagement_min"], arr_cols=["top_event_types"])
