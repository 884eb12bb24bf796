"""Commit log of a stream, keyed by (query, commit), that all sinks of a micro-batch go by.

A checkpoint alone makes a batch's number mean something only as long as the checkpoint lives:
with a new one numbers start at 0 again, over the same files.  The ledger therefore names a commit
by the checkpoint's own id and the batch number, and keeps the source files each commit took in:

* a micro-batch is stored once, and the sinks read the stored rows (the stream's plan runs once a batch);
* a sink writes the partition ``commit=<id>`` with overwrite, so doing it again changes nothing;
* the entry appears by one rename after the last sink.  A commit with an entry is done; one that was
  stored but has none (the driver was lost between two sinks) is finished first, by whichever run comes next;
* rows of files that an entry holds are left out, so a new checkpoint, which reads every file again, adds nothing.

For stateless streams over a file source, whose files never change.  One run of a query at a time.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators import joins
from lakeward.sinks import writes

FILE = "__source_file"


def with_file(df: DataFrame) -> DataFrame:
    """A frame of a file source with the path of each row's file."""
    return df.withColumn(FILE, F.col("_metadata.file_path"))


def commit_writer(path: str, partition_by: list[str] | tuple = ()):
    """Append sink: a commit owns ``commit=<id>``."""
    def write(rows: DataFrame, commit: str):
        w = rows.withColumn("commit", F.lit(commit)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        w.partitionBy("commit", *partition_by).parquet(path)
    return write


class Ledger:
    def __init__(self, spark: SparkSession, path: str, query: str):
        if not re.fullmatch(r"[A-Za-z0-9._-]+", query):
            raise ValueError(f"query name {query!r} may hold letters, digits, dots, dashes and underscores only")
        self.spark, self.query = spark, query
        self.entries = f"{path.rstrip('/')}/query={query}"
        self.open = f"{path.rstrip('/')}/_open/{query}"

    def _names(self, folder: str) -> list[str]:
        fs, p = writes._fs(self.spark, folder)
        return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) if fs.exists(p) else []

    def commits(self) -> list[str]:
        return [n.removeprefix("commit=") for n in self._names(self.entries) if n.startswith("commit=")]

    def done(self, commit: str) -> bool:
        return writes.exists(self.spark, f"{self.entries}/commit={commit}")

    def files(self) -> DataFrame:
        """Files the commits took in, with their rows."""
        schema = f"{FILE} string, rows bigint, commit string"
        if not self.commits():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.entries)

    def _finish(self, commit: str, sinks: list) -> None:
        """Bring a stored batch to its sinks and enter it."""
        held = f"{self.open}/{commit}"
        if not self.done(commit):
            stored = self.spark.read.parquet(f"{held}/rows")
            taken = stored.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows"))
            rows, before = stored, taken.select(FILE).join(self.files().select(FILE), FILE, "left_semi")
            if before.take(1):
                rows = stored.join(joins.bounded_broadcast(before), FILE, "left_anti")
                taken = taken.join(before, FILE, "left_anti")
            for sink in sinks:
                sink(rows.drop(FILE), commit)
            taken.write.mode("overwrite").parquet(f"{held}/entry")
            writes.promote(self.spark, f"{held}/entry", f"{self.entries}/commit={commit}")
        writes.discard(self.spark, held)

    def commit(self, batch: DataFrame, commit: str, sinks: list) -> None:
        for name in self._names(self.open):
            if name != commit and writes.exists(self.spark, f"{self.open}/{name}/rows/_SUCCESS"):
                self._finish(name, sinks)
        if self.done(commit):
            return
        if not writes.exists(self.spark, f"{self.open}/{commit}/rows/_SUCCESS"):
            batch.write.mode("overwrite").parquet(f"{self.open}/{commit}/rows")
        self._finish(commit, sinks)

    def run(self, source: DataFrame, sinks: list, checkpoint: str) -> int:
        """Bring all that is available of a stream (with ``FILE``) to the sinks, functions of (rows, commit);
        returns how many rows its source read (a plan that ran twice a batch would read them twice)."""
        def each(batch: DataFrame, batch_id: int):
            told = self.spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]       # one line
            self.commit(batch, f"{json.loads(told)['id']}-{batch_id}", sinks)

        q = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        return sum(p["numInputRows"] for p in q.recentProgress)
