"""Right-to-erasure across product tables.

A request is a set of pseudonyms (many subjects at once).  Per target table:
rows of the subjects are found with a semi join against the (size-checked,
broadcast) key set; only partitions holding such rows are rewritten, as
``left_anti`` survivors staged next to the table and swapped in; partitions
left empty are deleted.  NULL keys are never erased (``col != x`` would have
dropped them).  Every request is audited with pseudonyms only, on dry runs
too.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.expressions import pseudonym
from lakeward.operators import joins
from lakeward.sinks import changes, writes

AUDIT_SCHEMA = ("request_id string, subject string, table_name string, rows_erased bigint, "
                "executed boolean, requested_at timestamp")


@dataclass(frozen=True)
class Target:
    """A table to erase from.  ``raw_salt`` is set for tables that hold raw
    ids (bronze): their key is compared through the same pseudonym."""
    table: str
    path: str
    column: str
    partition_by: tuple = ()
    schema: str | None = None
    raw_salt: str | None = None


@dataclass(frozen=True)
class Rollup:
    """A derived table recomputed for the keys an erasure touched.
    ``recompute(source_rows)`` maps rows of the erased source table to fresh
    rollup rows; ``key_of`` maps source columns to the rollup's key columns."""
    path: str
    keys: tuple
    partition_by: tuple
    key_of: dict
    recompute: object
    schema: str | None = None


def subjects(spark: SparkSession, raw_ids: DataFrame, column: str, salt: str) -> DataFrame:
    """Raw ids -> pseudonyms, the silver-side key of the subjects."""
    return raw_ids.select(pseudonym(column, salt).alias("subject")).where(F.col("subject").isNotNull()).distinct()


def _read(spark: SparkSession, t: Target) -> DataFrame | None:
    if not writes.exists(spark, t.path):
        return None
    r = spark.read
    if t.schema:
        r = r.schema(t.schema)
    df = r.parquet(t.path)
    return df if t.column in df.columns else None


def _key(t: Target) -> F.Column:
    return pseudonym(t.column, t.raw_salt) if t.raw_salt else F.col(t.column)


def _hits(df: DataFrame, t: Target, keys: DataFrame) -> DataFrame:
    k = joins.bounded_broadcast(keys.select(F.col("subject").alias("__subject")))
    return df.join(k, _key(t) == F.col("__subject"), "left_semi")


def _survivors(df: DataFrame, t: Target, keys: DataFrame) -> DataFrame:
    """``left_anti``: rows with a NULL key are kept (they match no subject)."""
    k = joins.bounded_broadcast(keys.select(F.col("subject").alias("__subject")))
    return df.join(k, _key(t) == F.col("__subject"), "left_anti")


def erase_plan(spark: SparkSession, targets: list[Target], keys: DataFrame) -> DataFrame:
    """V3/V4: rows per (table, column, partition) that an erasure would remove."""
    parts = []
    for t in targets:
        df = _read(spark, t)
        if df is None:
            continue
        part = (F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in t.partition_by])
                if t.partition_by else F.lit(""))
        parts.append(_hits(df, t, keys).groupBy(part.alias("partition"))
                     .agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(t.table).alias("table_name"), F.lit(t.column).alias("column"), "partition", "rows"))
    if not parts:
        return spark.createDataFrame([], "table_name string, column string, partition string, rows bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def erase_preview(spark: SparkSession, targets: list[Target], keys: DataFrame) -> DataFrame:
    """V4: rows per table (dry run)."""
    return (erase_plan(spark, targets, keys).groupBy("table_name", "column")
            .agg(F.sum("rows").cast("bigint").alias("rows")))


def erase_subjects(spark: SparkSession, targets: list[Target], keys: DataFrame, audit_path: str,
                   as_of: str, dry_run: bool = False, request_id: str | None = None,
                   rollups: dict | None = None, logs: dict | None = None) -> dict:
    """V2: erase the subjects from every target; returns rows erased per
    table.  ``logs`` maps a target's table name to the ``ChangeLog`` that gets its deletes;
    the log keeps the images of erased rows, so it is a target of its own once its readers have gone past them.  ``rollups`` maps a target's table name to the ``Rollup`` tables
    derived from it: their keys touched by the erased rows are recomputed
    from the erased source (keys left without rows disappear)."""
    request_id = request_id or uuid.uuid4().hex[:12]
    per_subject = []
    counts = {}
    for t in targets:
        df = _read(spark, t)
        if df is None:
            counts[t.table] = 0
            continue
        hits = _hits(df, t, keys)
        by_subject = hits.groupBy(_key(t).alias("subject")).agg(F.count(F.lit(1)).alias("rows_erased"))
        by_subject = by_subject.withColumn("table_name", F.lit(t.table))
        rows = by_subject.collect()                     # one row per requested subject
        n = sum(r["rows_erased"] for r in rows)
        counts[t.table] = n
        per_subject += [(request_id, r["subject"], t.table, r["rows_erased"], not dry_run) for r in rows]
        if dry_run or n == 0:
            continue
        log = (logs or {}).get(t.table)
        if log is not None:
            log.record(changes.deletes(hits))
        derived = (rollups or {}).get(t.table, [])
        touched_keys = {}
        for r in derived:     # keys of the derived rows the erased rows fed (stored before the rewrite)
            cols = [F.col(src).alias(dst) for src, dst in r.key_of.items()]
            path = f"{t.path.rstrip('/')}__erase_keys_{request_id}_{len(touched_keys)}"
            hits.select(*cols).distinct().write.mode("overwrite").parquet(path)
            touched_keys[r.path] = spark.read.parquet(path)
        if t.partition_by:
            touched = writes._partitions_of(hits, list(t.partition_by))
            survivors = _survivors(writes._in_partitions(df, list(t.partition_by), touched), t, keys)
            writes.replace_partitions(spark, survivors, t.path, list(t.partition_by), touched)
        else:
            writes.replace_table(spark, _survivors(df, t, keys), t.path)
        if _hits(_read(spark, t), t, keys).take(1):         # the audit must not say erased while rows are left
            raise writes.MoveError(f"{t.table} still holds rows of request {request_id}")
        if log is not None:
            log.publish(spark)
        for r in derived:
            src = spark.read.schema(t.schema).parquet(t.path) if t.schema else spark.read.parquet(t.path)
            tk = touched_keys[r.path]
            on = [src[src_c] == tk[dst] for src_c, dst in r.key_of.items()]
            scope = src.join(joins.bounded_broadcast(tk), on, "left_semi")
            fresh = r.recompute(scope)
            writes.replace_keys(spark, r.path, fresh, tk, list(r.keys), list(r.partition_by), r.schema)
    audit = spark.createDataFrame(per_subject or [(request_id, None, None, 0, not dry_run)],
                                  "request_id string, subject string, table_name string, rows_erased bigint, "
                                  "executed boolean")
    audit.withColumn("requested_at", F.lit(as_of).cast("timestamp")).write.mode("append").parquet(audit_path)
    return counts
