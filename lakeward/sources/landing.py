"""Landing zone: raw deliveries as JSON lines, read back with the contract
schema plus ``_corrupt_record`` (no inference, no silent loss)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LANDING_DDL = ("event_id string, event_timestamp string, ingest_timestamp string, user_id string, "
               "partner_id string, event_type string, session_id string, duration_seconds double, "
               "is_first_session string, copy int, _corrupt_record string")
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_landing(raw: DataFrame, path: str, by_day: bool = True) -> str:
    """Land raw deliveries as JSON lines, one file group per ingest day."""
    out = raw.select(*[F.date_format(c, TS_FORMAT).alias(c) if c in ("event_timestamp", "ingest_timestamp")
                       else F.col(c) for c in raw.columns])
    if by_day:
        out = out.repartition(F.substring("ingest_timestamp", 1, 10))
    out.write.mode("append").json(path)
    return path


def parse(df: DataFrame) -> DataFrame:
    """Timestamps parsed with ``try_to_timestamp``: a bad value is a NULL that
    the malformed test catches, not an ANSI cast error that kills the job."""
    return (df.withColumn("event_timestamp", F.try_to_timestamp("event_timestamp", F.lit(TS_FORMAT)))
              .withColumn("ingest_timestamp", F.try_to_timestamp("ingest_timestamp", F.lit(TS_FORMAT))))


def malformed() -> Column:
    return (F.col("_corrupt_record").isNotNull() | F.col("event_id").isNull()
            | F.col("event_timestamp").isNull() | F.col("ingest_timestamp").isNull())


def read_json_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Batch landing read; returns (well-formed rows with ingest_date,
    malformed rows with the raw line and a reason)."""
    df = parse(spark.read.schema(LANDING_DDL).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    tagged = df.withColumn("__bad", malformed())
    good = (tagged.where(~F.col("__bad")).drop("__bad", "_corrupt_record")
                  .withColumn("ingest_date", F.to_date("ingest_timestamp")))
    bad = tagged.where(F.col("__bad")).drop("__bad").withColumn("__reject_reason", F.lit("malformed"))
    return good, bad
