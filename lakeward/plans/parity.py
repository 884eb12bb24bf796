"""Parity of two versions of a table (migration check): full outer join on
the keys with NULL-safe comparison of every metric, and the row delta."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parity_report(legacy: DataFrame, new: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One row per key present on either side."""
    l = legacy.select(*keys, *[F.col(m).alias(f"{m}_legacy") for m in metrics]).withColumn("__l", F.lit(True))
    r = new.select(*keys, *[F.col(m).alias(f"{m}_new") for m in metrics]).withColumn("__r", F.lit(True))
    j = l.join(r, keys, "full_outer")
    same = F.lit(True)
    for m in metrics:
        same = same & F.col(f"{m}_legacy").eqNullSafe(F.col(f"{m}_new"))
    return j.select(*keys, F.coalesce("__l", F.lit(False)).alias("in_legacy"),
                    F.coalesce("__r", F.lit(False)).alias("in_new"),
                    *[F.col(f"{m}_{s}") for m in metrics for s in ("legacy", "new")],
                    same.alias("matches"))


def row_delta(legacy: DataFrame, new: DataFrame) -> DataFrame:
    """Relative row-count difference (target: below 0.1 %)."""
    a = legacy.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("legacy"))
    b = new.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("new"))
    return (a.unionByName(b).groupBy().pivot("side", ["legacy", "new"]).agg(F.first("n"))
             .withColumn("delta_pct", F.abs(F.col("new") - F.col("legacy")) * 100.0 / F.col("legacy")))
