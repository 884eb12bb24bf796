"""Engagement events derived by Spark from the driver's ``events`` and
``customer`` tables, with the dirt of a real feed (see FIXTURES.md part B):
duplicate deliveries, late arrivals, anonymous events and ghost partners.

Every row of ``events`` is used; the modulo rules below only decide which rows
carry which kind of dirt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.expressions import Vocabulary, number_in
from lakeward.sources.tables import read_table

# Fixed values of the fixture (they define the golden numbers in FIXTURES.md).
DUPLICATE_EVERY = 47        # event_id % 47 = 0 is delivered twice, 30 s apart
LATE_EVERY = 50             # event_id % 50 = 0 is ingested 8 days after the event
ANONYMOUS_EVERY = 1009      # event_id % 1009 = 0 has no user
GHOST_EVERY = 101           # event_id % 101 = 0 names an unknown partner
GHOST_PARTNER = "ghost-partner"
SALT = "salt"

# Event semantics of the driver's event types.
FIXTURE_VOCAB = Vocabulary(
    session_end_type="purchase",
    completion_type="click",
    duration_seconds="duration_seconds",
    first_session="is_first_session = 'true'",
    intensity_high="event_type = 'error'",
    drop_off="event_type = 'view'",
)

RAW_COLUMNS = ["event_id", "event_timestamp", "ingest_timestamp", "user_id", "partner_id",
               "event_type", "session_id", "duration_seconds", "is_first_session", "copy"]


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference table of known partners (``silver.partners``)."""
    return (read_table(spark, sf_dir, "customer", ["c_mktsegment"])
            .select(F.col("c_mktsegment").alias("partner_id")).distinct())


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per driver event, in the engagement-event shape."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    ts = F.col("ts").cast("timestamp")
    eid = F.col("event_id")
    joined = e.join(c, e.user_id == c.c_custkey, "inner")
    return joined.select(
        eid.cast("string").alias("event_id"),
        ts.alias("event_timestamp"),
        F.when(eid % LATE_EVERY == 0, ts + F.expr("interval 8 days"))
         .otherwise(ts + F.expr("interval 1 minute")).alias("ingest_timestamp"),
        F.when(eid % ANONYMOUS_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(eid % GHOST_EVERY == 0, F.lit(GHOST_PARTNER))
         .otherwise(F.col("c_mktsegment")).alias("partner_id"),
        F.col("event_type"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date(ts).cast("string"), F.lit("-"),
                 F.floor(F.hour(ts) / 6).cast("int").cast("string")).alias("session_id"),
        F.when(F.col("event_type") == "purchase", number_in("props")).alias("duration_seconds"),
        F.when(F.col("event_type") == "signup", F.lit("true")).otherwise(F.lit("false"))
         .alias("is_first_session"),
        eid.alias("_eid"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base events plus the re-delivered copies, from a single scan and join."""
    b = base_events(spark, sf_dir)
    copies = F.when(F.col("_eid") % DUPLICATE_EVERY == 0, F.array(F.lit(0), F.lit(1))) \
              .otherwise(F.array(F.lit(0)))
    return (b.withColumn("copy", F.explode(copies))
             .withColumn("ingest_timestamp",
                         F.when(F.col("copy") == 1,
                                F.col("ingest_timestamp") + F.expr("interval 30 seconds"))
                          .otherwise(F.col("ingest_timestamp")))
             .select(*RAW_COLUMNS))


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated, on-time, pseudonymized events (the engagement product)."""
    from lakeward.operators.steps import dedup_latest, split_by, pseudonymize

    raw = raw_events(spark, sf_dir)
    d = dedup_latest(raw, ["event_id"], "ingest_timestamp")
    kept, _ = split_by(d, late_predicate(), "late_event_handling")
    return pseudonymize(kept, "user_id", SALT).drop("copy")


def late_predicate(days: int = 7, as_of: str = "ingest_timestamp") -> str:
    """On time = event no older than ``days`` at the as-of instant."""
    return f"event_timestamp >= {as_of} - INTERVAL {int(days)} DAYS"
