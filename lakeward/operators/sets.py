"""Set operations over product tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows present in both (INTERSECT, distinct)."""
    return a.intersect(b)


def difference_both_ways(left: DataFrame, right: DataFrame, left_label: str = "left_only",
                         right_label: str = "right_only") -> DataFrame:
    """E5: multiset differences in both directions (EXCEPT ALL each way),
    labelled, in one pass: each side is read once, rows are counted per side
    with a hash aggregate on the full row, and the surplus of either side is
    re-expanded.  (Two ``exceptAll`` calls would read each side twice.)"""
    cols = left.columns
    tagged = (left.withColumn("__l", F.lit(1)).withColumn("__r", F.lit(0))
              .unionByName(right.select(*cols).withColumn("__l", F.lit(0)).withColumn("__r", F.lit(1))))
    counts = tagged.groupBy(*cols).agg(F.sum("__l").alias("__nl"), F.sum("__r").alias("__nr"))
    surplus = counts.where(F.col("__nl") != F.col("__nr")).withColumn(
        "side", F.when(F.col("__nl") > F.col("__nr"), F.lit(left_label)).otherwise(F.lit(right_label)))
    n = F.abs(F.col("__nl") - F.col("__nr")).cast("int")
    return surplus.withColumn("__i", F.explode(F.sequence(F.lit(1), n))).select(*cols, "side")


def difference_both_ways_except_all(left: DataFrame, right: DataFrame, left_label: str = "left_only",
                                    right_label: str = "right_only") -> DataFrame:
    """The same result with two ``exceptAll`` (reference form, used in tests)."""
    return (left.exceptAll(right).withColumn("side", F.lit(left_label))
            .unionByName(right.exceptAll(left).withColumn("side", F.lit(right_label))))


def present_in_all(df: DataFrame, key: str, by: str, values: list) -> DataFrame:
    """E6 in one pass: keys seen under every one of ``values`` of ``by``
    (the INTERSECT of the per-value key sets, without reading once per value)."""
    return (df.where(F.col(by).isin(*values)).groupBy(key)
              .agg(F.count_distinct(by).alias("__n")).where(F.col("__n") == len(values)).select(key))


def union_versions(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become NULL."""
    return v1.unionByName(v2, allowMissingColumns=True)
