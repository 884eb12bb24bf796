"""Replay a product's steps from bronze for an event-date range."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.model import Product
from lakeward.plans.runner import _shape, apply_steps
from lakeward.sinks import writes


def bronze_window(spark: SparkSession, bronze_path: str, start: str, end: str, lateness_days: int,
                  schema: str | None = None) -> DataFrame:
    """Events with event date in [start, end): only ingest_date partitions that
    can hold them are listed (an event is accepted at most ``lateness_days``
    after it happened, so later partitions cannot contribute)."""
    last_ingest = (date.fromisoformat(end) + timedelta(days=lateness_days + 1)).isoformat()
    r = spark.read
    if schema:
        r = r.schema(schema)
    b = r.parquet(bronze_path)
    return (b.where(F.col("ingest_date").between(F.lit(start).cast("date"), F.lit(last_ingest).cast("date")))
             .where((F.to_date("event_timestamp") >= F.lit(start).cast("date"))
                    & (F.to_date("event_timestamp") < F.lit(end).cast("date"))))


def key_complete(spark: SparkSession, bronze_path: str, keys: list[str], start: str, end: str, schema: str | None = None) -> DataFrame:
    """Every copy of every event with a copy in [start, end), however much later
    it was ingested.  No copy is ingested before its event, so earlier ingest_date partitions are not listed."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    b = r.parquet(bronze_path).where(F.col("ingest_date") >= F.lit(start).cast("date"))
    day = F.to_date("event_timestamp")
    inside = b.where((day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date"))).select(*keys).distinct()
    return b.join(inside, keys, "left_semi")


def backfill(spark: SparkSession, product: Product, bronze_path: str, start: str, end: str, salt: str,
             as_of: str = "ingest_timestamp", lateness_days: int = 7, schema: str | None = None) -> DataFrame:
    """V9: the product's rows for [start, end) recomputed from the bronze partitions that can hold accepted
    copies (``bronze_window``).  A copy ingested after those is not seen: where it would be the
    survivor of a full run, use ``backfill_table``, which reads all copies and writes."""
    src = bronze_window(spark, bronze_path, start, end, lateness_days, schema)
    kept, _, _, _ = apply_steps(spark, src, product, salt, as_of)
    return kept


def backfill_table(spark: SparkSession, product: Product, bronze_path: str, target: str, start: str, end: str, salt: str,
                   as_of: str = "ingest_timestamp", schema: str | None = None, target_schema: str | None = None, log=None) -> None:
    """V9: bring [start, end) of a written product table to what a full run over bronze gives.

    The steps run over all copies of the events of the range.  Keys whose survivor
    a full run rejects leave the table, the others are replaced, and other keys are not
    touched.  A stored row newer than every copy in bronze (bronze past its retention) stays.
    ``log``: a ``ChangeLog`` for the changed rows; its commit makes a retry safe."""
    dedup = next(st.params for st in product.steps if st.type == "deduplicate")
    keys, order = list(dedup["keys"]), (dedup.get("keep") or {}).get("latest_by") or "ingest_timestamp"
    part = list(product.tier("silver").partition_by)
    src = key_complete(spark, bronze_path, keys, start, end, schema)
    kept, _, _, _ = apply_steps(spark, src, product, salt, as_of)
    current = spark.read.schema(target_schema).parquet(target) if target_schema else spark.read.parquet(target)
    fresh = _shape(kept, product, tuple(part)).select(*current.columns)
    if not writes.exists(spark, target):
        raise FileNotFoundError(target)

    seen = src.withColumn("event_date", F.to_date("event_timestamp")) if "event_date" in part else src
    newest = seen.groupBy(*keys).agg(F.max(order).alias("__newest"))
    behind = (current.where(F.col("event_date") >= F.lit(start).cast("date")) if "event_date" in part else current).select(*keys, F.col(order).alias("__stored"))
    ahead = behind.join(newest, keys).where(F.col("__stored") > F.col("__newest")).select(*keys)
    held = f"{target.rstrip('/')}__backfill_{uuid.uuid4().hex[:8]}"
    try:
        fresh.join(ahead, keys, "left_anti").write.parquet(f"{held}/fresh")
        # the partitions of all copies and of the stored rows, so that a survivor that moved leaves its old place
        stored = current.join(newest.select(*keys), keys, "left_semi").select(*keys, *part)
        seen.select(*keys, *part).unionByName(stored).distinct().join(ahead, keys, "left_anti").write.parquet(f"{held}/touched")
        touched = spark.read.schema(current.select(*keys, *part).schema).parquet(f"{held}/touched")
        writes.replace_keys(spark, target, spark.read.schema(current.schema).parquet(f"{held}/fresh"), touched, keys, part, target_schema, log=log)
    finally:
        writes.discard(spark, held)
