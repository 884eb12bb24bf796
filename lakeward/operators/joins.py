"""Joins the contracts call for: reference-table checks, keyed anti/semi
joins, re-identification, parity and interval joins.

Broadcasting is only used behind a size check: ``bounded_broadcast`` counts
at most ``max_rows + 1`` rows of the small side (a cheap bounded job) and
falls back to a plain shuffle join (which AQE may still turn into a broadcast
from runtime statistics) when the side is larger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.expressions import pseudonym

BROADCAST_MAX_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only when the side provably has at most ``max_rows`` rows."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def reference_keys(ref: DataFrame, ref_column: str, column: str, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    keys = ref.select(F.col(ref_column).alias(column)).where(F.col(column).isNotNull()).distinct()
    return bounded_broadcast(keys, max_rows)


def flag_reference(df: DataFrame, ref: DataFrame, column: str, ref_column: str | None = None,
                   flag: str = "__ref_hit", max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Add a boolean ``flag``: does the row's value exist in the reference?"""
    keys = reference_keys(ref, ref_column or column, column, max_rows).withColumn(flag, F.lit(True))
    return (df.join(keys, on=column, how="left")
              .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def reference_check(df: DataFrame, ref: DataFrame, column: str, ref_column: str | None = None) -> DataFrame:
    """One row: rows, matched rows, share matched."""
    flagged = flag_reference(df, ref, column, ref_column)
    return flagged.agg(F.count(F.lit(1)).alias("rows"),
                       F.sum(F.col("__ref_hit").cast("bigint")).alias("matched"),
                       F.round(F.avg(F.col("__ref_hit").cast("double")), 6).alias("share"))


def unmatched_rows(df: DataFrame, ref: DataFrame, column: str, ref_column: str | None = None) -> DataFrame:
    """Rows whose value is absent from the reference (``left_anti``).
    NULL values never match, so they are returned too."""
    return df.join(reference_keys(ref, ref_column or column, column), on=column, how="left_anti")


def matched_rows(df: DataFrame, ref: DataFrame, column: str, ref_column: str | None = None) -> DataFrame:
    """Rows with a match (``left_semi``)."""
    return df.join(reference_keys(ref, ref_column or column, column), on=column, how="left_semi")


def reidentify(df: DataFrame, vault: DataFrame, column: str, raw_column: str, salt: str) -> DataFrame:
    """Pseudonym -> raw id through the vault (equi-join on the recomputed hash)."""
    v = vault.select(F.col(raw_column).alias("raw_" + column),
                     pseudonym(raw_column, salt).alias(column)).where(F.col(column).isNotNull()).distinct()
    return df.join(v, on=column, how="inner")


def interval_join(events: DataFrame, spans: DataFrame, key: str, ts: str, start: str, end: str,
                  bucket: str = "1 hour") -> DataFrame:
    """Events inside [start, end] of a span of the same key.

    Joining on the key alone would compare every event of a heavy key with
    every span of it.  Each span is instead listed once per time bucket it
    touches and the join is on (key, bucket) with the range as a residual
    filter: an event meets only the few spans overlapping its own bucket, and
    since an event lies in exactly one bucket no pair is produced twice."""
    count, unit = bucket.split()
    width = int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]

    def number(c):
        return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000 * width)).cast("bigint")

    s = spans.withColumn("__bucket", F.explode(F.sequence(number(F.col(start)), number(F.col(end)))))
    e = events.withColumn("__bucket", number(F.col(ts)))
    return (e.join(s, on=[e[key] == s[key], e["__bucket"] == s["__bucket"],
                          e[ts] >= s[start], e[ts] <= s[end]], how="inner")
             .drop(s[key]).drop(s["__bucket"]).drop(e["__bucket"]))
