"""Shared pieces of the query catalog: the Spark-side product frames and the
DuckDB oracle prelude.  Oracle hygiene: counts cast to bigint, doubles rounded
to 6 places, arrays compared as joined text, timestamps as epoch numbers."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.expressions import epoch_micros, round6
from lakeward.operators import rollups, steps
from lakeward.session import ensure_utc
from lakeward.sinks import writes
from lakeward.sources import fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
GOLD_DDL = ("partner_id string, dau bigint, total_sessions bigint, total_engagement_min double, exercise_completions bigint, "
            "new_signups bigint, top_event_types array<string>, metric_date date")
AS_OF = "2024-02-01 00:00:00"
VOCAB = fixture.FIXTURE_VOCAB


def query(name: str, oracle: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame query and its oracle SQL."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run
    return deco


# -- Spark side ---------------------------------------------------------------------

def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.raw_events(spark, sf)


def dedup(spark: SparkSession, sf: str) -> DataFrame:
    return steps.dedup_latest(raw(spark, sf), ["event_id"], "ingest_timestamp", tie_break=["copy"])


def silver(spark: SparkSession, sf: str) -> DataFrame:
    kept, _ = steps.split_by(dedup(spark, sf), fixture.late_predicate(), "late_event_handling")
    return steps.pseudonymize(kept, "user_id", fixture.SALT).drop("copy")


def silver_table(spark: SparkSession, sf: str) -> DataFrame:
    """Silver written once to the shared workspace and read back: operators
    that read their input more than once (chunked sessionization joins its
    chunk summary back, journeys join signup days) then scan a stored,
    column-pruned table instead of recomputing the dedup shuffle per read.
    This is how the journey product reads silver in production."""
    from lakeward.session import workspace

    path = f"{workspace(spark, 'silver')}/silver"
    silver(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def gold_daily(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.partner_daily(silver(spark, sf), VOCAB)


def _stamp(spark: SparkSession, sf: str) -> tuple:
    """Length and time of the fixture's source files: what a stored table was made from."""
    fs, root = writes._fs(spark, sf)
    files = [fs.getFileStatus(writes._path(spark, f"{sf}/{t}.parquet")) for t in ("events", "customer")]
    return tuple((f.getLen(), f.getModificationTime()) for f in files)


_GOLD: dict[tuple, str] = {}


def gold_table(spark: SparkSession, sf: str) -> DataFrame:
    """The dashboard's gold as its readers find it: stored, partitioned by metric_date, read with its types.

    The dashboard queries read one stored table, which is written when the first of them asks (once an application
    and state of the source files) instead of scanning, joining and deduplicating the events for each."""
    from lakeward.session import workspace

    key = (spark.sparkContext.applicationId, sf, _stamp(spark, sf))
    path = _GOLD.get(key)
    if path is None or not writes.exists(spark, f"{path}/_SUCCESS"):
        path = _GOLD[key] = f"{workspace(spark, 'gold')}/partner_dashboard"
        writes.write_table(gold_daily(spark, sf), path, ["metric_date"], cluster_by=["partner_id"])
    return spark.read.schema(GOLD_DDL).parquet(path)


def present(df: DataFrame, ts_cols=(), dbl_cols=(), arr_cols=()) -> DataFrame:
    """Engine-neutral output: timestamps as epoch micros, doubles rounded."""
    for c in ts_cols:
        df = df.withColumn(c, epoch_micros(c))
    for c in dbl_cols:
        df = df.withColumn(c, round6(c))
    for c in arr_cols:
        df = df.withColumn(c, F.array_join(c, ","))
    return df


# -- DuckDB side ----------------------------------------------------------------------

CTE = """
with base as (
  select cast(e.event_id as varchar) as event_id,
         e.ts as event_timestamp,
         e.ts + (case when e.event_id % 50 = 0 then interval '8' day else interval '1' minute end) as ingest_timestamp,
         case when e.event_id % 1009 = 0 then null else cast(e.user_id as varchar) end as user_id,
         case when e.event_id % 101 = 0 then 'ghost-partner' else c.c_mktsegment end as partner_id,
         e.event_type,
         cast(e.user_id as varchar) || '-' || cast(cast(e.ts as date) as varchar) || '-'
           || cast(cast(floor(extract(hour from e.ts) / 6) as int) as varchar) as session_id,
         case when e.event_type = 'purchase' then try_cast(regexp_extract(e.props, '[0-9]+', 0) as double) end as duration_seconds,
         case when e.event_type = 'signup' then 'true' else 'false' end as is_first_session,
         0 as copy
  from events e join customer c on c.c_custkey = e.user_id
),
raw as (
  select * from base
  union all
  select event_id, event_timestamp, ingest_timestamp + interval '30' second as ingest_timestamp, user_id, partner_id,
         event_type, session_id, duration_seconds, is_first_session, 1 as copy
  from base where cast(event_id as int) % 47 = 0
),
dedup as (
  select * from (select *, row_number() over (partition by event_id order by ingest_timestamp desc) as rn from raw) x
  where rn = 1
),
late as (
  select * from dedup where not coalesce(event_timestamp >= ingest_timestamp - interval '7' day, false)
),
silver as (
  select event_id, event_timestamp, ingest_timestamp, sha256('salt' || user_id) as user_id, partner_id, event_type,
         session_id, duration_seconds, is_first_session
  from dedup where event_timestamp >= ingest_timestamp - interval '7' day
),
partners as (select distinct c_mktsegment as partner_id from customer),
sessions as (
  select *, sum(case when gap > 1800 then 1 else 0 end) over (partition by user_id order by event_timestamp) as sid
  from (select *, coalesce(cast(floor(epoch(event_timestamp)) as bigint)
                           - cast(floor(epoch(lag(event_timestamp) over (partition by user_id order by event_timestamp))) as bigint), 0) as gap
        from silver where user_id is not null) g
),
journey as (
  select user_id as pseudonymized_user_id, partner_id, cast(event_timestamp as date) as journey_date,
         count(distinct sid) as session_count, count(*) as n_events,
         sum(case when event_type = 'purchase' then duration_seconds / 60.0 else 0 end) as total_engagement_min
  from sessions group by 1, 2, 3
),
gold as (
  select partner_id, cast(event_timestamp as date) as metric_date,
         count(distinct user_id) as dau,
         count(distinct session_id) as total_sessions,
         coalesce(sum(case when event_type = 'purchase' then duration_seconds / 60.0 else 0 end), 0) as total_engagement_min,
         cast(sum(case when event_type = 'click' then 1 else 0 end) as bigint) as exercise_completions,
         count(distinct case when is_first_session = 'true' then user_id end) as new_signups,
         list_slice(list_sort(list_distinct(list(event_type))), 1, 5) as top_event_types
  from silver group by 1, 2
)
"""


def oracle(body: str) -> str:
    return CTE + body
