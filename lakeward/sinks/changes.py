"""Row-level change log of a table: what each commit inserted, updated and deleted.

A table that is rewritten in place cannot be followed by reading its files: a
rewritten file looks like new rows, and a deleted row like nothing.  So a writer
that is given a ``ChangeLog`` records the images of the rows it changes,
one folder a commit: ``insert`` and ``delete`` rows, and a row before
(``update_before``) and after (``update_after``) each update.  Rows that a write
leaves as they are have no image.  The log is append-only Parquet and is read
as a stream.

A commit's images are stored aside before the table is touched and become visible
after it.  A commit that is visible is done: writing it again does nothing, whatever
checkpoint or run asks for it.  One that was interrupted keeps the images it
stored first, since a second look at a half-written table would miss some.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.sinks import writes

CHANGE, COMMIT = "_change", "commit"
INSERT, BEFORE, AFTER, DELETE = "insert", "update_before", "update_after", "delete"


class ChangeLog:
    """One commit of a change log.  ``commit``: a name that a retry of the same write uses again."""

    def __init__(self, path: str, commit: str):
        if not re.fullmatch(r"[A-Za-z0-9._-]+", commit):
            raise ValueError(f"commit {commit!r} may hold letters, digits, dots, dashes and underscores only")
        self.path, self.commit = path.rstrip("/"), commit
        self.pending, self.place = f"{self.path}/_pending/{commit}", f"{self.path}/{COMMIT}={commit}"

    def done(self, spark: SparkSession) -> bool:
        return writes.exists(spark, self.place)

    def record(self, images: DataFrame) -> None:
        """Store the commit's images aside, unless an interrupted try has done so."""
        if not writes.exists(images.sparkSession, f"{self.pending}/_SUCCESS"):
            images.write.mode("overwrite").parquet(self.pending)

    def publish(self, spark: SparkSession) -> None:
        if not self.done(spark):
            writes.promote(spark, self.pending, self.place)


def images(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """The change rows that lead from ``before`` to ``after``, two sets of rows of the same columns with unique keys.
    NULL equals NULL in keys and values; one full outer join on the keys."""
    cols = after.columns
    b = before.select(F.struct(*cols).alias("b"))
    a = after.select(F.struct(*cols).alias("a"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}"))
    both = b.join(a, same, "full_outer")
    row = lambda op, x: F.struct(F.lit(op).alias("op"), F.col(x).alias("row"))
    changed = (F.when(F.col("b").isNull(), F.array(row(INSERT, "a"))).when(F.col("a").isNull(), F.array(row(DELETE, "b")))
               .when(~F.col("a").eqNullSafe(F.col("b")), F.array(row(BEFORE, "b"), row(AFTER, "a"))))
    return both.select(F.explode(changed).alias("c")).select(F.col("c.op").alias(CHANGE), "c.row.*")


def deletes(rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(DELETE).alias(CHANGE), *rows.columns)


def stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """The log as a stream: the table's columns, ``_change`` and ``commit``."""
    r = spark.readStream.schema(f"{CHANGE} string, {schema}, {COMMIT} string")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)
