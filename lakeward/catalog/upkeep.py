"""Catalog part 4: sinks, run history, erasure, backfill, parity, contract
evolution.  Query forms that write do so below a fresh folder of the shared
workspace (``spark.checkpoint.dir``) and return the table read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeward import products
from lakeward.catalog.common import ORACLE, VOCAB, dedup, gold_daily, oracle, present, query, raw, silver, silver_table
from lakeward.catalog.reports import GOLD_BASIC, _legacy_silver
from lakeward.model import load_product
from lakeward.operators import journey, joins, rollups, steps
from lakeward.plans import backfill as backfill_plan
from lakeward.plans import erasure, evolution, flow, lineage, parity, retention, typetree
from lakeward.plans.runner import run_product
from lakeward.session import workspace
from lakeward.sinks import changes, writes, zorder
from lakeward.sources import fixture

SILVER_DDL = ("event_id string, event_timestamp timestamp, ingest_timestamp timestamp, user_id string, "
              "event_type string, session_id string, duration_seconds double, is_first_session string, "
              "event_date date, partner_id string")
GOLD_DDL = ("partner_id string, dau bigint, total_sessions bigint, total_engagement_min double, "
            "exercise_completions bigint, new_signups bigint, top_event_types array<string>, metric_date date")
JOURNEY_DDL = ("pseudonymized_user_id string, partner_id string, days_since_signup int, "
               "events array<struct<event_type:string,ts:timestamp,session_id:string>>, session_count int, "
               "total_engagement_min double, derived_stage string, cohort_tags array<string>, journey_date date")
BRONZE_DDL = ("event_id string, event_timestamp timestamp, ingest_timestamp timestamp, user_id string, "
              "partner_id string, event_type string, session_id string, duration_seconds double, "
              "is_first_session string, copy int, ingest_date date")
SILVER_PART = ["event_date", "partner_id"]
ERASE_RAW_ID = "7"


def _write_silver(spark, sf, root):
    s = silver(spark, sf).withColumn("event_date", F.to_date("event_timestamp"))
    path = f"{root}/silver/engagement_events"
    writes.write_table(s, path, SILVER_PART, cluster_by=["user_id", "event_type"])
    return path


def _write_gold(spark, sf, root):
    path = f"{root}/gold/partner_dashboard"
    writes.write_table(gold_daily(spark, sf), path, ["metric_date"], cluster_by=["partner_id"])
    return path


SILVER_ROWS_SQL = """event_id, epoch_us(event_timestamp) as event_timestamp, user_id, partner_id, event_type,
       cast(event_timestamp as date) as event_date"""


@query("partitioned_write", oracle(f"select {SILVER_ROWS_SQL} from silver"))
def partitioned_write(spark, sf):
    """Silver written partitioned by (event_date, partner_id),
    range-laid-out and clustered, read back with its explicit schema."""
    path = _write_silver(spark, sf, workspace(spark, "partitioned_write"))
    back = spark.read.schema(SILVER_DDL).parquet(path)
    return present(back.select("event_id", "event_timestamp", "user_id", "partner_id", "event_type", "event_date"),
                   ts_cols=["event_timestamp"])


@query("dashboard_base", oracle(f"select {GOLD_BASIC} from gold"))
def dashboard_base(spark, sf):
    """The gold table written partitioned by metric_date and loaded back."""
    path = _write_gold(spark, sf, workspace(spark, "dashboard_base"))
    g = spark.read.schema(GOLD_DDL).parquet(path)
    return present(g.select(*rollups.DISPLAY_COLUMNS), dbl_cols=["total_engagement_min"])


@query("serving_extract", oracle("""
select metric_date, partner_id, dau, total_sessions, round(total_engagement_min, 6) as total_engagement_min from gold
"""))
def serving_extract(spark, sf):
    """K8: compacted, sorted per-day extract for the serving store."""
    path = workspace(spark, "serving_extract")
    writes.serving_extract(gold_daily(spark, sf).select("metric_date", "partner_id", "dau", "total_sessions",
                                                        "total_engagement_min"), path)
    back = spark.read.schema("partner_id string, dau bigint, total_sessions bigint, total_engagement_min double, "
                             "metric_date date").parquet(path)
    return present(back, dbl_cols=["total_engagement_min"])


@query("upsert_rollup", oracle(f"select {GOLD_BASIC} from gold"))
def upsert_rollup(spark, sf):
    """Gold built from an early cut of silver, then the recomputed
    last 17 days upserted on (partner_id, metric_date)."""
    path = f"{workspace(spark, 'upsert_rollup')}/gold/partner_dashboard"
    early = silver(spark, sf).where(F.col("event_timestamp") < F.lit("2024-01-18").cast("timestamp"))
    first = rollups.partner_daily(early, VOCAB).where(F.col("metric_date") < F.lit("2024-01-20").cast("date"))
    writes.write_table(first, path, ["metric_date"], cluster_by=["partner_id"])
    updates = gold_daily(spark, sf).where(F.col("metric_date") >= F.lit("2024-01-15").cast("date"))
    writes.upsert(spark, path, updates.select(*spark.read.schema(GOLD_DDL).parquet(path).columns),
                  ["partner_id", "metric_date"], ["metric_date"], schema=GOLD_DDL)
    back = spark.read.schema(GOLD_DDL).parquet(path)
    return present(back.select(*rollups.DISPLAY_COLUMNS), dbl_cols=["total_engagement_min"])


@query("retention_report", oracle("""
select distinct cast(event_timestamp as date) as event_date, 21 as retention_days from silver
where cast(event_timestamp as date) < date '2024-01-31' - interval 21 day
"""))
def retention_report(spark, sf):
    """Silver partitions past a 21-day retention at 2024-01-31."""
    path = _write_silver(spark, sf, workspace(spark, "retention"))
    back = spark.read.schema(SILVER_DDL).parquet(path)
    return writes.expired_partitions(back, "event_date", 21, "2024-01-31")


def _expired_silver(spark, sf, name):
    """Silver after its partitions past 21 days at 2024-01-31 were dropped: (path, audit of the drop)."""
    root = workspace(spark, name)
    path = _write_silver(spark, sf, root)
    return path, retention.drop(spark, path, "event_date", 21, "2024-01-31", "jan", f"{root}/_retention", SILVER_DDL)


@query("retention_drop", oracle(f"""
select {SILVER_ROWS_SQL} from silver where cast(event_timestamp as date) >= date '2024-01-31' - interval 21 day
"""))
def retention_drop(spark, sf):
    """The rows that stay when the expired partitions are dropped."""
    path, _ = _expired_silver(spark, sf, "retention_drop")
    back = spark.read.schema(SILVER_DDL).parquet(path)
    return present(back.select("event_id", "event_timestamp", "user_id", "partner_id", "event_type", "event_date"),
                   ts_cols=["event_timestamp"])


@query("retention_audit", oracle("""
select 'jan' as request, cast(event_timestamp as date) as value, count(*) as rows, 'dropped' as outcome from silver
where cast(event_timestamp as date) < date '2024-01-31' - interval 21 day group by 2
"""))
def retention_audit(spark, sf):
    """The audit of that drop, one row a partition."""
    _, audit = _expired_silver(spark, sf, "retention_audit")
    return audit.select("request", "value", "rows", "outcome")


@query("zorder_layout", oracle("""
select event_id, user_id, partner_id, event_type, true as fewer_files from silver
"""))
def zorder_layout(spark, sf):
    """Silver rewritten in place in Z-order of (user_id, event_type): every row is kept, and a filter on
    the second column, which a linear sort cannot serve, opens fewer files than there are."""
    path = f"{workspace(spark, 'zorder')}/silver"
    cols = ["event_id", "user_id", "partner_id", "event_type"]
    silver(spark, sf).select(*cols).write.parquet(path)
    zorder.optimize(spark, path, ["user_id", "event_type"], "event_id string, user_id string, partner_id string, event_type string", files=32)
    back = spark.read.parquet(path)
    ranges = zorder.file_ranges(back, ["event_type"])
    opened = zorder.files_admitted(ranges, "event_type", back.select("event_type").distinct())
    total = ranges.agg(F.count(F.lit(1)).alias("total"))
    return back.join(opened.join(total, F.lit(True)).select("event_type", (F.col("files") < F.col("total")).alias("fewer_files")), "event_type")


@query("quarantine_report", oracle("""
select 'late_event_handling' as reject_reason, cast(event_timestamp as date) as event_date, count(*) as rows from late group by 2
"""))
def quarantine_report(spark, sf):
    """Quarantine appended for a run, then counted by reason and day."""
    root = workspace(spark, "quarantine")
    _, rej = steps.split_by(dedup(spark, sf), fixture.late_predicate(), "late_event_handling")
    rej = steps.pseudonymize(rej, "user_id", fixture.SALT)
    writes.append_quarantine(rej, root, "engagement_events", "late_event_handling", "run1", "2024-02-01 00:00:00")
    q = spark.read.parquet(root)
    return (q.groupBy(F.col(steps.REJECT_REASON).alias("reject_reason"),
                      F.to_date("event_timestamp").alias("event_date"))
             .agg(F.count(F.lit(1)).alias("rows")))


@query("reprocess_late", oracle("""
select event_id, sha256('salt' || user_id) as user_id, partner_id from late
where event_timestamp >= ingest_timestamp - interval '10' day
"""))
def reprocess_late(spark, sf):
    """Quarantined rows re-run with a relaxed 10-day rule; accepted rows
    are upserted into silver on event_id (and read back)."""
    root = workspace(spark, "reprocess")
    _, rej = steps.split_by(dedup(spark, sf), fixture.late_predicate(), "late_event_handling")
    accepted, _ = steps.split_by(rej.drop(steps.REJECT_REASON), fixture.late_predicate(10), "late_relaxed")
    accepted = steps.pseudonymize(accepted, "user_id", fixture.SALT).select(
        "event_id", "user_id", "partner_id", F.to_date("event_timestamp").alias("event_date"))
    base = silver(spark, sf).select("event_id", "user_id", "partner_id",
                                    F.to_date("event_timestamp").alias("event_date"))
    path = f"{root}/silver"
    writes.write_table(base, path, ["event_date"])
    ddl = "event_id string, user_id string, partner_id string, event_date date"
    writes.upsert(spark, path, accepted, ["event_id"], ["event_date"], schema=ddl)
    back = spark.read.schema(ddl).parquet(path)
    return back.join(accepted.select("event_id"), "event_id", "left_semi").select("event_id", "user_id", "partner_id")


@query("backfill", oracle(f"""
select {SILVER_ROWS_SQL} from silver
where cast(event_timestamp as date) >= date '2024-01-10' and cast(event_timestamp as date) < date '2024-01-15'
"""))
def backfill(spark, sf):
    """V9: replay of 2024-01-10..14 from bronze (pruned ingest_date partitions)."""
    root = workspace(spark, "backfill")
    bronze = f"{root}/bronze/engagement_events"
    writes.write_table(raw(spark, sf).withColumn("ingest_date", F.to_date("ingest_timestamp")), bronze,
                       ["ingest_date"])
    p = products.product("engagement_events")
    out = backfill_plan.backfill(spark, p, bronze, "2024-01-10", "2024-01-15", fixture.SALT, schema=BRONZE_DDL)
    out = out.withColumn("event_date", F.to_date("event_timestamp"))
    return present(out.select("event_id", "event_timestamp", "user_id", "partner_id", "event_type", "event_date"),
                   ts_cols=["event_timestamp"])


FAR_COPY_SQL = """
with_far as (
  select *, 0 as far from raw
  union all
  select event_id, event_timestamp, ingest_timestamp + interval 10 day, user_id, partner_id, 'error' as event_type, session_id,
         duration_seconds, is_first_session, 2 as copy, 1 as far from base where cast(event_id as int) % 53 = 0
  union all
  select event_id, event_timestamp, ingest_timestamp + interval 1 hour, user_id, partner_id, 'view' as event_type, session_id,
         duration_seconds, is_first_session, 3 as copy, 1 as far from base where cast(event_id as int) % 59 = 0
),
survivors as (
  select * from (select *, row_number() over (partition by event_id order by ingest_timestamp desc) as nth from with_far) x where nth = 1
)
"""


def _with_far_copies(spark, sf):
    """The raw deliveries, some of them delivered once more an hour or 10 days (past the lateness bound) later with another type."""
    every = raw(spark, sf)
    first = every.where("copy = 0")
    number = F.col("event_id").cast("int")
    far = first.where(number % 53 == 0).withColumns({"ingest_timestamp": F.expr("ingest_timestamp + interval 10 days"), "event_type": F.lit("error"), "copy": F.lit(2)})
    hour = first.where(number % 59 == 0).withColumns({"ingest_timestamp": F.expr("ingest_timestamp + interval 1 hour"), "event_type": F.lit("view"), "copy": F.lit(3)})
    return every, far.unionByName(hour)


def _with_failure_policy(policy):
    spec = products.ENGAGEMENT_EVENTS
    return load_product({**spec, "quality": {**spec["quality"], "on_failure": policy}})


@query("backfill_write", oracle("").rstrip() + "," + FAR_COPY_SQL + f"""
select {SILVER_ROWS_SQL} from (
  select event_id, event_timestamp, sha256('salt' || user_id) as user_id, partner_id, event_type from survivors
  where event_timestamp >= ingest_timestamp - interval '7' day
    and cast(event_timestamp as date) >= date '2024-01-10' and cast(event_timestamp as date) < date '2024-01-15'
  union all
  select event_id, event_timestamp, user_id, partner_id, event_type from silver
  where not (cast(event_timestamp as date) >= date '2024-01-10' and cast(event_timestamp as date) < date '2024-01-15'))
""")
def backfill_write(spark, sf):
    """V9: 2024-01-10..14 of the written silver table brought to what a full run gives once later copies (an hour and 10 days
    after the first) are in bronze; other days stay as they were.  Done twice under one commit: the second changes nothing."""
    root = workspace(spark, "backfill_write")
    target, bronze = _write_silver(spark, sf, root), f"{root}/bronze/engagement_events"
    first, later = _with_far_copies(spark, sf)
    writes.write_table(first.unionByName(later).withColumn("ingest_date", F.to_date("ingest_timestamp")), bronze, ["ingest_date"])
    p = products.product("engagement_events")
    for _ in range(2):
        backfill_plan.backfill_table(spark, p, bronze, target, "2024-01-10", "2024-01-15", fixture.SALT, schema=BRONZE_DDL,
                                     target_schema=SILVER_DDL, log=changes.ChangeLog(f"{root}/changes", "backfill-1"))
    back = spark.read.schema(SILVER_DDL).parquet(target)
    return present(back.select("event_id", "event_timestamp", "user_id", "partner_id", "event_type", "event_date"), ts_cols=["event_timestamp"])


@query("two_run_silver", oracle("").rstrip() + "," + FAR_COPY_SQL + f"""
select {SILVER_ROWS_SQL} from (
  select event_id, event_timestamp, sha256('salt' || user_id) as user_id, partner_id, event_type from (
    select *, row_number() over (partition by event_id order by ingest_timestamp desc) as n from with_far
    where event_timestamp >= ingest_timestamp - interval '7' day) x where n = 1)
""")
def two_run_silver(spark, sf):
    """K2: silver after two runs that came in the wrong order, the later copies first: the older copies of the second run
    never replace newer rows."""
    root = workspace(spark, "two_run_silver")
    first, later = _with_far_copies(spark, sf)
    p = _with_failure_policy("warn")
    refs = {"silver.partners": fixture.partners(spark, sf)}
    for n, part in enumerate((later.where(fixture.late_predicate()), first.where(fixture.late_predicate()))):
        run_product(spark, p, part, root, fixture.SALT, "ingest_timestamp", refs=refs, run_id=f"run{n}")
    back = spark.read.schema(SILVER_DDL).parquet(f"{root}/silver/engagement_events")
    return present(back.select("event_id", "event_timestamp", "user_id", "partner_id", "event_type", "event_date"), ts_cols=["event_timestamp"])


@query("replayed_run", oracle("""
select 'bronze' as place, (select count(*) from raw) as rows union all select 'silver', (select count(*) from silver)
union all select 'quarantine', (select count(*) from late) union all select 'runs', 1
"""))
def replayed_run(spark, sf):
    """Rows of every place a run writes to after the same run was tried twice."""
    root = workspace(spark, "replayed_run")
    refs = {"silver.partners": fixture.partners(spark, sf)}
    for _ in range(2):
        run_product(spark, _with_failure_policy("warn"), raw(spark, sf), root, fixture.SALT, "ingest_timestamp", refs=refs, run_id="run-1")
    places = {"bronze": f"{root}/bronze/engagement_events", "silver": f"{root}/silver/engagement_events",
              "quarantine": f"{root}/quarantine", "runs": f"{root}/_runs"}
    out = None
    for place, path in places.items():
        one = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(place).alias("place"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("run_history", oracle("""
select 'engagement_events' as contract, '1.2.0' as version, s.status, (select count(*) from raw) as rows_in,
       (select count(*) from silver) as rows_out, (select count(*) from late) as rows_rejected,
       case when exists (select 1 from silver where partner_id not in (select partner_id from partners where partner_id is not null))
            then 'in_reference_table[partner_id]' else '' end as failed_rules
from (values ('blocked'), ('written')) s(status)
"""))
def run_history(spark, sf):
    """The engagement product run end to end through the runner,
    twice: as declared (the ghost partners fail the reference-table rule and
    ``block_silver_write`` blocks the write) and with ``warn``; returns the
    run-history rows without their fresh run ids."""
    root = workspace(spark, "runs")
    refs = {"silver.partners": fixture.partners(spark, sf)}
    declared = products.product("engagement_events")
    run_product(spark, declared, raw(spark, sf), root, fixture.SALT, "ingest_timestamp", refs=refs,
                raise_on_block=False)
    warn_spec = {**products.ENGAGEMENT_EVENTS,
                 "quality": {**products.ENGAGEMENT_EVENTS["quality"], "on_failure": "warn"}}
    run_product(spark, load_product(warn_spec), raw(spark, sf), root, fixture.SALT, "ingest_timestamp", refs=refs)
    runs = spark.read.parquet(f"{root}/_runs")
    return runs.select("contract", "version", "status", "rows_in", "rows_out", "rows_rejected",
                       F.array_join("failed_rules", ",").alias("failed_rules"))


# -- erasure -----------------------------------------------------------------------------

def _erasure_setup(spark, sf, name):
    root = workspace(spark, name)
    spath = _write_silver(spark, sf, root)
    jpath = f"{root}/gold/user_journey"
    writes.write_table(journey.user_journey(spark.read.schema(SILVER_DDL).parquet(spath), VOCAB), jpath,
                       ["journey_date"],
                       cluster_by=["pseudonymized_user_id"])
    targets = [erasure.Target("silver.engagement_events", spath, "user_id", ("event_date", "partner_id"), SILVER_DDL),
               erasure.Target("gold.user_journey", jpath, "pseudonymized_user_id", ("journey_date",), JOURNEY_DDL)]
    keys = erasure.subjects(spark, spark.createDataFrame([(ERASE_RAW_ID,)], "raw_id string"), "raw_id", fixture.SALT)
    return root, targets, keys


ERASE_SUBJECT = f"sha256('salt' || '{ERASE_RAW_ID}')"


@query("erase_subjects", oracle(f"""
select event_id, user_id from silver where user_id is null or user_id <> {ERASE_SUBJECT}
"""))
def erase_subjects(spark, sf):
    """Erase raw user 7 from silver and the journey gold; silver read back.
    NULL users stay (an anti join keeps them)."""
    root, targets, keys = _erasure_setup(spark, sf, "erase")
    erasure.erase_subjects(spark, targets, keys, f"{root}/_audit/erasures", "2024-02-01 00:00:00")
    return spark.read.schema(SILVER_DDL).parquet(targets[0].path).select("event_id", "user_id")


@query("erase_preview", oracle(f"""
select 'silver.engagement_events' as table_name, 'user_id' as "column", count(*) as rows from silver where user_id = {ERASE_SUBJECT}
union all
select 'gold.user_journey', 'pseudonymized_user_id', count(*) from journey where pseudonymized_user_id = {ERASE_SUBJECT}
"""))
def erase_preview(spark, sf):
    """V4: rows an erasure would remove, per table (dry run)."""
    _, targets, keys = _erasure_setup(spark, sf, "erase_preview")
    return erasure.erase_preview(spark, targets, keys)


@query("erase_plan", oracle(f"""
select 'silver.engagement_events' as table_name, 'user_id' as "column",
       'event_date=' || cast(cast(event_timestamp as date) as varchar) || '/partner_id=' || partner_id as partition, count(*) as rows
from silver where user_id = {ERASE_SUBJECT} group by 3
union all
select 'gold.user_journey', 'pseudonymized_user_id', 'journey_date=' || cast(journey_date as varchar), count(*)
from journey where pseudonymized_user_id = {ERASE_SUBJECT} group by 3
"""))
def erase_plan(spark, sf):
    """V3: tables, key columns and partitions touched by the erasure."""
    _, targets, keys = _erasure_setup(spark, sf, "erase_plan")
    return erasure.erase_plan(spark, targets, keys)


@query("erase_rollup", oracle("").rstrip() + f""",
silver_e as (select * from silver where user_id is null or user_id <> {ERASE_SUBJECT})
select partner_id, cast(event_timestamp as date) as metric_date,
       count(distinct user_id) as dau, count(distinct session_id) as total_sessions,
       round(coalesce(sum(case when event_type = 'purchase' then duration_seconds / 60.0 else 0 end), 0), 6) as total_engagement_min,
       cast(sum(case when event_type = 'click' then 1 else 0 end) as bigint) as exercise_completions,
       count(distinct case when is_first_session = 'true' then user_id end) as new_signups
from silver_e group by 1, 2
""")
def erase_rollup(spark, sf):
    """V3 / hard part (g): erasing raw user 7 from silver also recomputes the
    partner-day rows of the gold rollup that the erased rows fed; gold read back."""
    root, targets, keys = _erasure_setup(spark, sf, "erase_rollup")
    silver_t = targets[0]
    gpath = f"{root}/gold/partner_dashboard"
    stored = spark.read.schema(SILVER_DDL).parquet(silver_t.path)
    writes.write_table(rollups.partner_daily(stored, VOCAB), gpath, ["metric_date"], cluster_by=["partner_id"])
    gold_cols = [c.split()[0] for c in GOLD_DDL.split(", ")]
    rollup = erasure.Rollup(gpath, ("partner_id", "metric_date"), ("metric_date",),
                            {"partner_id": "partner_id", "event_date": "metric_date"},
                            lambda rows: rollups.partner_daily(rows, VOCAB).select(*gold_cols), GOLD_DDL)
    erasure.erase_subjects(spark, [silver_t], keys, f"{root}/_audit/erasures", "2024-02-01 00:00:00",
                           rollups={silver_t.table: [rollup]})
    g = spark.read.schema(GOLD_DDL).parquet(gpath)
    return present(g.select(*rollups.DISPLAY_COLUMNS), dbl_cols=["total_engagement_min"])


@query("erase_bronze", oracle(f"""
select event_id, copy, user_id from raw where user_id is null or user_id <> '{ERASE_RAW_ID}'
"""))
def erase_bronze(spark, sf):
    """V3: bronze keeps raw ids; it is erased through the same pseudonym
    (the key is hashed on the fly, the raw id never enters the request)."""
    root, _, keys = _erasure_setup(spark, sf, "erase_bronze")
    bpath = f"{root}/bronze/engagement_events"
    writes.write_table(raw(spark, sf).withColumn("ingest_date", F.to_date("ingest_timestamp")), bpath,
                       ["ingest_date"])
    t = erasure.Target("bronze.engagement_events", bpath, "user_id", ("ingest_date",), BRONZE_DDL, fixture.SALT)
    erasure.erase_subjects(spark, [t], keys, f"{root}/_audit/erasures", "2024-02-01 00:00:00")
    return spark.read.schema(BRONZE_DDL).parquet(bpath).select("event_id", "copy", "user_id")


@query("erasure_audit", oracle(f"""
select {ERASE_SUBJECT} as subject, t.table_name, t.rows_erased, e.executed
from (select 'silver.engagement_events' as table_name, (select count(*) from silver where user_id = {ERASE_SUBJECT}) as rows_erased
      union all
      select 'gold.user_journey', (select count(*) from journey where pseudonymized_user_id = {ERASE_SUBJECT})) t,
     (values (false), (true)) e(executed)
"""))
def erasure_audit(spark, sf):
    """K7/V5: audit rows of a dry run then a real run (pseudonyms only)."""
    root, targets, keys = _erasure_setup(spark, sf, "erase_audit")
    audit = f"{root}/_audit/erasures"
    erasure.erase_subjects(spark, targets, keys, audit, "2024-02-01 00:00:00", dry_run=True)
    erasure.erase_subjects(spark, targets, keys, audit, "2024-02-01 00:00:00")
    return spark.read.parquet(audit).select("subject", "table_name", "rows_erased", "executed")


def _erased_flow(spark, sf, name):
    root = workspace(spark, name)
    refs = {"silver.partners": fixture.partners(spark, sf)}
    flow.run_flow(spark, raw(spark, sf), root, fixture.SALT, "2024-02-01 00:00:00", VOCAB, refs, "warn")
    keys = erasure.subjects(spark, spark.createDataFrame([(i,) for i in ERASE_RAW_IDS], "raw_id string"), "raw_id", fixture.SALT)
    contracts = list(flow.flow_products(VOCAB))
    audit = lineage.erase(spark, root, contracts, keys, fixture.SALT, "2024-02-01 00:00:00", "request-1", refs)
    return root, contracts, audit


ERASE_RAW_IDS = ["7", "11"]
ERASE_LIST = ", ".join(f"'{i}'" for i in ERASE_RAW_IDS)


@query("erase_by_contract", oracle("").rstrip() + f""",
subjects as (select unnest([{ERASE_LIST}]) as id),
hits as (
  select 'bronze.engagement_events' as table_name, 'user_id' as "column", sha256('salt' || user_id) as subject from raw
  union all select 'silver.engagement_events', 'user_id', user_id from silver
  union all select 'quarantine.engagement_events', 'user_id', sha256('salt' || user_id) from late
  union all select 'gold.user_journey', 'pseudonymized_user_id', pseudonymized_user_id from journey)
select subject, table_name, "column", count(*) as rows_erased from hits
where subject in (select sha256('salt' || id) from subjects) group by all
""")
def erase_by_contract(spark, sf):
    """V3: the three products run end to end, then users 7 and 11 are erased from all tables that
    the contracts make them reach; the request's audit."""
    return _erased_flow(spark, sf, "erase_by_contract")[2].select("subject", "table_name", "column", "rows_erased")


@query("erase_by_contract_gold", ORACLE["erase_rollup"].replace(f"user_id <> {ERASE_SUBJECT}",
       f"user_id not in (select sha256('salt' || id) from (select unnest([{ERASE_LIST}]) as id))"))
def erase_by_contract_gold(spark, sf):
    """V3: the same request; the dashboard gold, whose rows fed by the erased events were computed anew."""
    root, contracts, _ = _erased_flow(spark, sf, "erase_by_contract_gold")
    g = spark.read.schema(GOLD_DDL).parquet(f"{root}/gold/partner_dashboard")
    return present(g.select(*rollups.DISPLAY_COLUMNS), dbl_cols=["total_engagement_min"])


# -- parity, re-identification, joins, function/sql steps -----------------------------------

@query("parity_report", oracle("").rstrip() + """,
legacy as (
  select * from (select *, row_number() over (partition by event_id order by ingest_timestamp asc) as rn2 from raw) x
  where rn2 = 1 and event_timestamp >= ingest_timestamp - interval '7' day
),
lg as (select partner_id, cast(event_timestamp as date) as metric_date, count(distinct user_id) as dau,
              count(distinct session_id) as total_sessions from legacy group by 1, 2)
select coalesce(l.partner_id, g.partner_id) as partner_id, coalesce(l.metric_date, g.metric_date) as metric_date,
       l.partner_id is not null as in_legacy, g.partner_id is not null as in_new,
       l.dau as dau_legacy, g.dau as dau_new, l.total_sessions as total_sessions_legacy, g.total_sessions as total_sessions_new,
       (l.dau is not distinct from g.dau) and (l.total_sessions is not distinct from g.total_sessions) as matches
from lg l full outer join gold g on l.partner_id = g.partner_id and l.metric_date = g.metric_date
""")
def parity_report(spark, sf):
    """Legacy rollup (first-delivery dedup, raw ids) vs the new one."""
    legacy = rollups.partner_daily(_legacy_silver(spark, sf), VOCAB, extended=False)
    return parity.parity_report(legacy, gold_daily(spark, sf), ["partner_id", "metric_date"],
                                ["dau", "total_sessions"])


@query("row_delta", oracle("").rstrip() + """,
n as (select (select count(*) from (select event_id, event_timestamp, ingest_timestamp,
                                           row_number() over (partition by event_id order by ingest_timestamp asc) as rn2 from raw) x
              where rn2 = 1 and event_timestamp >= ingest_timestamp - interval '7' day) as legacy_rows,
             (select count(*) from silver) as new_rows)
select legacy_rows, new_rows, round(abs(new_rows - legacy_rows) * 100.0 / legacy_rows, 6) as delta_pct,
       abs(new_rows - legacy_rows) * 100.0 / legacy_rows < 0.1 as within_target
from n
""")
def row_delta(spark, sf):
    """Row counts of the legacy and the new silver against the 0.1 % target."""
    d = parity.row_delta(_legacy_silver(spark, sf), silver(spark, sf))
    return present(d.select(F.col("legacy").alias("legacy_rows"), F.col("new").alias("new_rows"), "delta_pct",
                            (F.col("delta_pct") < 0.1).alias("within_target")), dbl_cols=["delta_pct"])


@query("reidentify", oracle("""
select s.event_id, cast(c.c_custkey as varchar) as raw_user_id
from silver s join customer c on s.user_id = sha256('salt' || cast(c.c_custkey as varchar))
"""))
def reidentify(spark, sf):
    """Controlled re-identification through the id vault (customer keys)."""
    from lakeward.sources.tables import read_table

    vault = read_table(spark, sf, "customer", ["c_custkey"]).select(F.col("c_custkey").cast("string").alias("raw"))
    out = joins.reidentify(silver(spark, sf).select("event_id", "user_id"), vault, "user_id", "raw", fixture.SALT)
    return out.select("event_id", "raw_user_id")


@query("journey_with_rollup", oracle("""
select j.pseudonymized_user_id, j.journey_date, j.partner_id, cast(j.session_count as int) as session_count, g.dau as partner_dau
from journey j join gold g on g.partner_id = j.partner_id and g.metric_date = j.journey_date
"""))
def journey_with_rollup(spark, sf):
    """A join step between two products (journey x partner-day rollup)."""
    s = silver_table(spark, sf)
    j = journey.user_day(s, VOCAB)
    g = rollups.partner_daily(s, VOCAB).select("partner_id", F.col("metric_date").alias("journey_date"),
                                     F.col("dau").alias("partner_dau"))
    out = steps.join_step(j, g, ["partner_id", "journey_date"], "inner", broadcast=True)
    return out.select("pseudonymized_user_id", "journey_date", "partner_id", "session_count", "partner_dau")


@query("function_step", oracle("""
select pseudonymized_user_id, partner_id, journey_date,
       case when session_count = 0 then 'churned' when session_count >= 5 then 'habitual'
            when session_count >= 3 then 'engaged' when total_engagement_min < 2 then 'lapsing' else 'exploring' end as derived_stage
from journey
"""))
def function_step(spark, sf):
    """2.12: an allow-listed DataFrame function applied as a contract step."""
    u = journey.user_day(silver_table(spark, sf), VOCAB)
    return steps.function_step(u, "derive_stage").select("pseudonymized_user_id", "partner_id", "journey_date",
                                                          "derived_stage")


USERS_BY_TYPE = """
WITH once AS (SELECT DISTINCT event_type, user_id, session_id FROM silver.engagement_events)
SELECT event_type, count(session_id) AS user_sessions, count(DISTINCT user_id) AS users FROM once GROUP BY event_type
"""


@query("sql_step_rollup", oracle("""
select event_type, count(distinct (user_id, session_id)) filter (session_id is not null) as user_sessions,
       count(distinct user_id) as users
from silver group by event_type
"""))
def sql_step_rollup(spark, sf):
    """T4: a rollup as a contract SQL step over its input (the declared table name
    replaced as a whole word by the ``{input}`` parameter)."""
    return steps.sql_step(spark, silver(spark, sf), USERS_BY_TYPE, table="silver.engagement_events")


@query("upgrade_v2", oracle("""
select event_id, try_cast(cast(cast(duration_seconds as bigint) as varchar) as int) as duration_seconds,
       event_type as category, try_cast(is_first_session as boolean) as is_first_session,
       null::double as clinical_intensity
from silver
"""))
def upgrade_v2(spark, sf):
    """v1 property bag -> v2 typed struct, new optional column."""
    v2 = evolution.to_v2(silver(spark, sf))
    return v2.select("event_id", "event_properties.duration_seconds", "event_properties.category",
                     "event_properties.is_first_session", "clinical_intensity")


@query("upgrade_impact", oracle("""
select 'event_type' as field, 'allowed_values narrowed' as change,
       cast(sum(case when event_type = 'error' then 1 else 0 end) as bigint) as rows_affected from silver
union all
select 'event_properties', 'type changed', cast(0 as bigint)
"""))
def upgrade_impact(spark, sf):
    """V8: rows already in silver that the proposed v2 contract would reject."""
    old, new = load_product(products.ENGAGEMENT_EVENTS_V1_BAG), load_product(products.ENGAGEMENT_EVENTS_V2)
    return evolution.upgrade_impact(evolution.bag_map(silver(spark, sf)), old, new)


@query("contract_changes", oracle("""
select 'engagement_events' as contract, field, change, class, values_removed, rows_affected from (
  select 'event_type' as field, 'allowed_values narrowed' as change, 'breaking' as class, 'error' as values_removed,
         cast(sum(case when event_type = 'error' then 1 else 0 end) as bigint) as rows_affected from silver
  union all select 'event_properties', 'type changed', 'breaking', '', cast(0 as bigint)
  union all select 'event_properties', 'description changed', 'cosmetic', '', cast(0 as bigint)
  union all select 'clinical_intensity', 'optional field added', 'additive', '', cast(0 as bigint)
) x
"""))
def contract_changes(spark, sf):
    """V6/V7: field changes v1 -> v2 with class, joined to the rows of silver
    each change affects (V8)."""
    old, new = load_product(products.ENGAGEMENT_EVENTS_V1_BAG), load_product(products.ENGAGEMENT_EVENTS_V2)
    ch = evolution.classify_changes(evolution.registry(spark, old), evolution.registry(spark, new))
    impact = evolution.upgrade_impact(evolution.bag_map(silver(spark, sf)), old, new)
    return (ch.join(impact, ["field", "change"], "left")
              .select("contract", "field", "change", "class", "values_removed",
                      F.coalesce("rows_affected", F.lit(0).cast("bigint")).alias("rows_affected")))


#: Two versions of a contract with a nested bag; the types are this query's own.
NESTED_V1 = {**products.ENGAGEMENT_EVENTS, "contract": {**products.ENGAGEMENT_EVENTS["contract"], "version": "1.4.0"}, "schema": [
    {"name": "event_id", "type": "string", "nullable": False},
    {"name": "bag", "type": "struct<seconds:bigint,kind:string,tags:array<string>,sizes:map<string,int>,Amount:decimal(12,2)>", "nullable": True}]}
NESTED_V2 = {**NESTED_V1, "contract": {**NESTED_V1["contract"], "version": "1.5.0"}, "schema": [
    {"name": "event_id", "type": "string", "nullable": False},
    {"name": "bag", "type": "struct<seconds:tinyint,tags:array<int>,sizes:map<string,bigint>,amount:decimal(4,2)>", "nullable": True}]}


def _nested(spark, sf):
    seconds = F.col("duration_seconds")
    bag = F.struct(seconds.cast("bigint").alias("seconds"), F.col("event_type").alias("kind"),
                   F.array(F.lit("1"), F.when(F.col("event_type") == "click", "2").otherwise(F.col("event_type"))).alias("tags"),
                   F.create_map(F.lit("n"), F.length("session_id")).alias("sizes"), seconds.cast("decimal(12,2)").alias("Amount"))
    return silver(spark, sf).select("event_id", bag.alias("bag"))


@query("type_changes", oracle("""
select path, change, class, old_type, new_type, cast(rows_affected as bigint) as rows_affected from (
  select 'bag.seconds' as path, 'type narrowed' as change, 'breaking' as class, 'bigint' as old_type, 'tinyint' as new_type,
         count(*) filter (where duration_seconds > 127) as rows_affected from silver
  union all select 'bag.kind', 'field removed', 'breaking', 'string', null, count(event_type) from silver
  union all select 'bag.tags[]', 'type changed', 'breaking', 'string', 'int', count(*) filter (where event_type <> 'click') from silver
  union all select 'bag.sizes{value}', 'type widened', 'additive', 'int', 'bigint', 0
  union all select 'bag.Amount', 'renamed by case', 'breaking', 'decimal(12,2)', 'decimal(4,2)', count(duration_seconds) from silver
  union all select 'bag.Amount', 'type narrowed', 'breaking', 'decimal(12,2)', 'decimal(4,2)',
         count(*) filter (where duration_seconds >= 100) from silver
) x
"""))
def type_changes(spark, sf):
    """V6/V8: differences inside a nested type by path, with the rows of silver each one hits."""
    return typetree.impact(_nested(spark, sf), load_product(NESTED_V1), load_product(NESTED_V2))


@query("bump_check", oracle("""
select 'engagement_events' as contract, 'major' as required, 'minor' as actual, false as passed, count(*) as rows_affected
from silver where event_type is not null
"""))
def bump_check(spark, sf):
    """V7: the version step those differences call for, the step taken, and the rows the worst of them breaks."""
    old, new = load_product(NESTED_V1), load_product(NESTED_V2)
    return typetree.bump(typetree.impact(_nested(spark, sf), old, new), old, new)


@query("product_flow", oracle(f"select {GOLD_BASIC} from gold"))
def product_flow(spark, sf):
    """The demo flow end to end: raw deliveries -> engagement product (bronze,
    silver, quarantine) -> partner dashboard gold -> user journey gold, every
    product gated and written through the runner; the dashboard gold read
    back.  The fixture's ghost partners fail the reference-table rules, so the
    products run with the ``warn`` policy here (``run_history`` shows the
    declared policy blocking)."""
    root = workspace(spark, "product_flow")
    refs = {"silver.partners": fixture.partners(spark, sf)}
    res = flow.run_flow(spark, raw(spark, sf), root, fixture.SALT, "2024-02-01 00:00:00", VOCAB, refs, "warn")
    g = spark.read.parquet(res.dashboard.outputs["target"])
    return present(g.select(*rollups.DISPLAY_COLUMNS), dbl_cols=["total_engagement_min"])
