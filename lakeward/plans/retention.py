"""Retention by partition: what a table holds, what is past its days, and an audited drop that can be resumed.

The catalogue of partitions is a folder listing (one entry a partition, no data is read).  A drop is a request
with a name.  Its plan (the folders, their files, bytes and rows) is stored before anything goes; then the folders
go one by one, and a marker closes the request.  A request that was interrupted is taken up from its stored
plan under the same name, whatever has gone already, and a closed request does nothing.  A partition that has files
the plan does not know was written again in between: it is left as it is and listed as ``changed``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.model import Product
from lakeward.sinks import writes

CATALOGUE_DDL = "folder string, value date, files bigint, bytes bigint, names string"
AUDIT_DDL = "request string, folder string, value date, files bigint, bytes bigint, rows bigint, outcome string"


def _folder_files(fs, folder) -> tuple[int, int, str]:
    """Number of files, bytes and the file names of a folder."""
    names, size = [], 0
    it = fs.listFiles(folder, True)
    while it.hasNext():
        f = it.next()
        if not f.getPath().getName().startswith(("_", ".")):
            names.append(f.getPath().getName())
            size += f.getLen()
    return len(names), size, ",".join(sorted(names))


def catalogue(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row per folder of the date ``column``, the table's first partition column (NULL: the default partition)."""
    fs, root = writes._fs(spark, path)
    rows = []
    for status in (fs.listStatus(root) if fs.exists(root) else []):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{column}="):
            text = name.split("=", 1)[1]
            rows.append((name, None if text == "__HIVE_DEFAULT_PARTITION__" else text, *_folder_files(fs, status.getPath())))
    frame = spark.createDataFrame(rows, "folder string, text string, files bigint, bytes bigint, names string")
    return frame.select("folder", F.to_date("text").alias("value"), "files", "bytes", "names")


def expired(spark: SparkSession, path: str, column: str, days: int, as_of: str) -> DataFrame:
    """The catalogue's rows whose date is more than ``days`` days before ``as_of``; a NULL date never expires."""
    return catalogue(spark, path, column).where(F.col("value") < F.date_sub(F.lit(as_of).cast("date"), days))


def _plan(spark: SparkSession, path: str, column: str, days: int, as_of: str, schema: str, fmt: str, place: str) -> None:
    """Store the request's plan; rows are counted from the footers of the expired partitions alone."""
    gone = expired(spark, path, column, days, as_of)
    table = spark.read.schema(schema).format(fmt)
    if writes.exists(spark, path):
        old = F.col(column) < F.date_sub(F.lit(as_of).cast("date"), days)
        counts = table.load(path).where(old).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
        gone = gone.join(counts, "value", "left")
    else:
        gone = gone.withColumn("rows", F.lit(0).cast("bigint"))
    (gone.select("folder", "value", "files", "bytes", "names", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"))
     .coalesce(1).write.mode("overwrite").parquet(place))


def drop(spark: SparkSession, path: str, column: str, days: int, as_of: str, request: str, audit: str, schema: str,
         fmt: str = "parquet") -> DataFrame:
    """Drop the partitions past retention under the name ``request``; returns its audit (one row a folder, outcome ``dropped`` or ``changed``)."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", request):
        raise ValueError(f"request {request!r} may hold letters, digits, dots, dashes and underscores only")
    planned, closed = f"{audit.rstrip('/')}/_planned/{request}", f"{audit.rstrip('/')}/request={request}"
    if not writes.exists(spark, f"{closed}/_SUCCESS"):
        if not writes.exists(spark, f"{planned}/_SUCCESS"):
            _plan(spark, path, column, days, as_of, schema, fmt, planned)
        fs, _ = writes._fs(spark, path)
        outcomes = []
        for row in spark.read.parquet(planned).collect():       # one row a partition folder
            folder = writes._path(spark, f"{path.rstrip('/')}/{row.folder}")
            left = set(_folder_files(fs, folder)[2].split(",")) - {""} if fs.exists(folder) else set()
            changed = bool(left - set(row.names.split(",")))    # files the plan does not know
            if not changed:
                writes._remove(fs, folder)
            outcomes.append((row.folder, row.value, row.files, row.bytes, row.rows, "changed" if changed else "dropped"))
        done = spark.createDataFrame(outcomes, "folder string, value date, files bigint, bytes bigint, rows bigint, outcome string")
        done.coalesce(1).write.mode("overwrite").parquet(closed)
    return audit_rows(spark, audit).where(F.col("request") == request)


def audit_rows(spark: SparkSession, audit: str) -> DataFrame:
    """All closed requests."""
    return spark.read.schema(AUDIT_DDL).parquet(audit)


def enforce(spark: SparkSession, product: Product, tier: str, path: str, as_of: str, request: str, audit: str, schema: str) -> DataFrame | None:
    """The drop a contract's tier declares (``retention_days`` over its first partition column); None where it declares none."""
    t = product.tier(tier)
    if t.retention_days is None or not t.partition_by:
        return None
    return drop(spark, path, t.partition_by[0], t.retention_days, as_of, request, audit, schema, t.format)
