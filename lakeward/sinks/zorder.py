"""Z-order layout of stored tables, and the audit that shows what it buys.

A linear sort prunes files by its first key only: within one value of that key a file holds all values of the
second.  The Morton key interleaves the bits of several columns' ranks, so every file is a small box in all
of them and its min/max values exclude it for a filter on any.

Ranks are places among range bounds found by one approximate-quantile aggregate over the columns (so a skewed
column is cut by rows, not by value range); the bounds are ``2**bits - 1`` numbers a column whatever the size of the
table.  A row's rank is a binary search in ``bits`` steps, all within codegen.  Texts are compared by the seven bytes
after the prefix that all of a column's values share; values that agree there share a rank, which costs pruning but no rows.
NULL ranks first.  Rows of one Morton key are spread over files by the columns and a hash of the row, so a
combination that holds a third of the table does not end in one task.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.sinks import writes

PREFIX_BYTES = 7                                   # fits a bigint


def _shared_prefixes(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Bytes that all values of each text column begin with: those its least and greatest value share."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    if not texts:
        return {}
    row = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(texts) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: len(os.path.commonprefix([(row[f"lo{i}"] or "").encode(), (row[f"hi{i}"] or "").encode()]))
            for i, c in enumerate(texts)}


def ordinal(df: DataFrame, column: str, skip: int = 0) -> F.Column:
    """A number that orders as the column does; ``skip``: bytes of a text left out."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        head = F.substring(F.encode(c, "UTF-8"), skip + 1, PREFIX_BYTES)
        return F.conv(F.rpad(F.hex(head), 2 * PREFIX_BYTES, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise TypeError(f"column {column} of type {kind.simpleString()} has no place in a Z-order")


def with_morton(df: DataFrame, columns: list[str], name: str = "_z", bits: int = 8) -> DataFrame:
    """``df`` with the Morton key of ``columns`` (two or more); reads ``df`` once more, only those columns."""
    if not 2 <= len(columns) <= 62 // bits:
        raise ValueError(f"a Z-order takes 2 to {62 // bits} columns of {bits} bits, not {len(columns)}")
    skips = _shared_prefixes(df, columns)
    marks = [i / 2 ** bits for i in range(1, 2 ** bits)]
    found = df.agg(*[F.percentile_approx(ordinal(df, c, skips.get(c, 0)), marks).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    values = [f"_v{i}" for i in range(len(columns))]
    ranks = [f"_r{i}" for i in range(len(columns))]
    out = df.withColumns({v: ordinal(df, c, skips.get(c, 0)) for v, c in zip(values, columns)})
    out = out.withColumns({r: F.lit(0) for r in ranks})
    for bit in reversed(range(bits)):              # one step of every column's binary search a projection
        step = 1 << bit
        out = out.withColumns({r: F.when(F.col(v) >= F.element_at(F.lit(found[i]), F.col(r) + step), F.col(r) + step).otherwise(F.col(r))
                               for i, (r, v) in enumerate(zip(ranks, values)) if found[i]})
    key = F.lit(0).cast("bigint")
    for i, r in enumerate(ranks):
        for bit in range(bits):
            one = F.shiftright(F.col(r), bit).bitwiseAND(F.lit(1)).cast("bigint")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + i))
    return out.withColumn(name, key).drop(*values, *ranks)


def zorder(df: DataFrame, columns: list[str], partition_by: list[str] | tuple = (), files: int | None = None, bits: int = 8) -> DataFrame:
    """``df`` range-partitioned and sorted by (partition columns, Morton key); ``files``: how many ranges (None: Spark's setting)."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))]
    tie = ["_z", *columns]
    keyed = with_morton(df, columns, bits=bits).withColumn("_tie", F.xxhash64(*plain))
    keys = [*partition_by, *tie, "_tie"]
    spread = keyed.repartitionByRange(files, *keys) if files else keyed.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*keys).drop("_z", "_tie")


def optimize(spark: SparkSession, path: str, columns: list[str], schema: str | T.StructType, partition_by: list[str] | tuple = (),
             only: str | None = None, files: int | None = None, fmt: str = "parquet") -> int:
    """Rewrite a stored table (or the partitions that ``only``, a condition on partition columns, names) in Z-order, in place.

    The new files are staged beside the table, their rows counted against the old ones (footers only), then swapped; a job lost before
    the swap leaves the table as it was.  Returns the number of rows rewritten."""
    table = spark.read.schema(schema).format(fmt).load(path)
    part = list(partition_by)
    rows = table.where(only) if only else table
    if only and not part:
        raise ValueError("only a partitioned table can be rewritten in part")
    before = rows.count()
    if not before:
        return 0
    # a staging folder inside a partitioned table starts with "_", which readers skip
    staged = f"{path.rstrip('/')}/_staging_{uuid.uuid4().hex[:8]}" if part else f"{path.rstrip('/')}__staging_{uuid.uuid4().hex[:8]}"
    touched = writes._partitions_of(rows, part) if part else []
    out = zorder(rows, columns, part, files).write.format(fmt)
    (out.partitionBy(*part) if part else out).save(staged)
    after = spark.read.schema(schema).format(fmt).load(staged).count()
    if after != before:
        raise writes.MoveError(f"{after} rows staged for {before}; the table is unchanged, the staged files are in {staged}")
    if part:
        writes.swap_partitions(spark, staged, path, part, touched)
        writes._remove(*writes._fs(spark, staged))
    else:
        writes.promote(spark, staged, path)
    return before


def file_ranges(table: DataFrame, columns: list[str]) -> DataFrame:
    """One row per file of a stored table: its rows and each column's least and greatest value (``min_c``, ``max_c``)."""
    return (table.groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]))


def files_admitted(ranges: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """For each of a few ``values`` (one column of the same name): how many files a reader must open for ``column = value``, and the rows in them."""
    return (ranges.join(values, F.col(column).between(F.col(f"min_{column}"), F.col(f"max_{column}")))
            .groupBy(column).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows_read")))
