"""Running stage with keyed state: the spans of every (user, day), kept by Spark's ``transformWithState``.

``jobs.running_stage`` recomputes the user-days a batch touches from a stored silver table.  Here the
stage is carried forward instead: what a user-day needs is the spans of its sessions (events no more than
the gap apart, so at most one span a gap, 48 a day) and the seconds of its closing events.  Spans only ever
merge, so events may come in any order, and copies of an event change nothing: a copy lies inside a span,
and closing events are kept by id.

A user-day is a few numbers, and every call of Python for a key costs as much as thousands of them.  So the
user-days of one day are dealt into ``SLICES`` slices by a hash of the user, and the key of the state is (slice, day):
one call, one read and one write for all user-days of a slice that a batch touches.  The number of calls is then
bounded by slices and open days, not by users.  A slice holds a ``SLICES``-th of a day's users; its rows
reach one task as a stream of Arrow batches, of which only the seconds and the closing ids are kept.

A day's state is dropped by an event-time timer once the watermark has passed the end of the day; rows
behind the watermark are dropped by Spark before they get here, so no row can miss its state.  The state is
therefore bounded by the open days (the lateness bound and one more), whatever the length of the stream, and
``run`` reports how many state rows were left after each batch.

The operator is Python (Arrow batches): DataFrame functions have no keyed state with timers.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeward.functions.expressions import REFERENCE_VOCAB, Vocabulary, pseudonym
from lakeward.operators.journey import derive_stage
from lakeward.operators.sessions import SESSION_GAP_SECONDS
from lakeward.sinks import writes
from lakeward.streaming import jobs

OUT_DDL = "user_id string, journey_date date, session_count int, seconds double"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000
EPOCH = pd.Timestamp("1970-01-01").date()
SLICES = 128                 # of a day's users; part of the state's key, so a checkpoint keeps the number it began with
SPANS_DDL = "users array<string>, sizes array<int>, starts array<bigint>, ends array<bigint>, seconds array<double>"
CLOSING_DDL = "users array<string>, sizes array<int>, event_ids array<string>"


def merge_seconds(starts: list[int], ends: list[int], seconds: list[int], gap: int) -> None:
    """Take sorted event seconds into the spans (sorted, disjoint, more than ``gap`` apart), in place."""
    for second in seconds:
        i = bisect.bisect_left(ends, second - gap)          # the first span the event may join
        j = bisect.bisect_right(starts, second + gap)       # one past the last
        if i < j:
            first, last = min(starts[i], second), max(ends[j - 1], second)
        else:
            first = last = second
        starts[i:j], ends[i:j] = [first], [last]


class StageState(StatefulProcessor):
    """Spans and closing events of one slice of a day's users; emits the totals of the user-days that a batch touches."""

    def __init__(self, gap: int = SESSION_GAP_SECONDS):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getValueState("spans", SPANS_DDL)
        self.closing = handle.getValueState("closing", CLOSING_DDL)

    def _known(self) -> tuple[dict[str, tuple[list[int], list[int]]], dict[str, float], dict[str, dict[str, None]]]:
        """Spans, seconds and closing ids of every user in the state."""
        spans, total, closed = {}, {}, {}
        held = self.spans.get()
        if held is None:
            return spans, total, closed
        at = 0
        for user, size, seconds in zip(held[0], held[1], held[4]):
            spans[user], total[user] = (list(held[2][at:at + size]), list(held[3][at:at + size])), seconds
            at += size
        at, held = 0, self.closing.get()
        for user, size in zip(held[0], held[1]) if held else ():
            closed[user] = dict.fromkeys(held[2][at:at + size])
            at += size
        return spans, total, closed

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        spans, total, closed = self._known()
        if not spans:
            self.handle.registerTimer(((key[1] - EPOCH).days + 1) * DAY_MS)
        touched, more = {}, False
        for batch in rows:
            fresh: dict[str, set[int]] = {}
            for user, second in zip(batch["user_id"].tolist(), batch["second"].tolist()):
                fresh.setdefault(user, set()).add(second)
            for user, seconds in fresh.items():
                merge_seconds(*spans.setdefault(user, ([], [])), sorted(seconds), self.gap)
                total.setdefault(user, 0.0)
            touched.update(dict.fromkeys(fresh))
            ends = batch[batch["seconds"].notna()]
            for user, event_id, seconds in zip(ends["user_id"].tolist(), ends["event_id"].tolist(), ends["seconds"].tolist()):
                own = closed.setdefault(user, {})
                if event_id not in own:
                    own[event_id], more = None, True
                    total[user] += seconds
        self.spans.update((list(spans), [len(x) for x, _ in spans.values()], [t for x, _ in spans.values() for t in x],
                           [t for _, x in spans.values() for t in x], [total[user] for user in spans]))
        if more:
            self.closing.update((list(closed), [len(x) for x in closed.values()], [i for x in closed.values() for i in x]))
        users = list(touched)
        yield pd.DataFrame({"user_id": users, "journey_date": [key[1]] * len(users),
                            "session_count": [len(spans[user][0]) for user in users], "seconds": [total[user] for user in users]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.spans.clear()
        self.closing.clear()
        return iter(())

    def close(self) -> None:
        pass


def user_days(events: DataFrame, vocab: Vocabulary = REFERENCE_VOCAB, days: int = 7, slices: int = SLICES) -> DataFrame:
    """The stream of user-day totals of ``events``, pseudonymized and on time; NULL users are left out."""
    own = events.where(F.col("user_id").isNotNull()).withWatermark("event_timestamp", f"{days} days")
    return (own.select("user_id", F.to_date("event_timestamp").alias("journey_date"), "event_timestamp", "event_id",
                       F.floor(F.unix_micros("event_timestamp") / 1_000_000).cast("bigint").alias("second"),
                       F.when(vocab.is_end(), vocab.duration()).cast("double").alias("seconds"))
            .withColumn("slice", F.pmod(F.xxhash64("user_id"), F.lit(slices)).cast("int"))
            .groupBy("slice", "journey_date")
            .transformWithStateInPandas(StageState(), OUT_DDL, outputMode="Update", timeMode="EventTime"))


def run(spark: SparkSession, landing: str, root: str, checkpoint: str, salt: str, vocab: Vocabulary = REFERENCE_VOCAB,
        days: int = 7, max_files: int | None = None, slices: int = SLICES) -> tuple[str, list[int]]:
    """Keep the latest stage of every user-day in ``<root>/stage``; returns its path and the state rows left after each batch.
    The sink is an upsert on (user, day) of whole totals, so a batch run again changes nothing."""
    path = f"{root}/stage"
    rows = jobs.read_landing(spark, landing, max_files)
    on_time = rows.where(~jobs.malformed(rows) & ~jobs.late(rows, days)).withColumn("user_id", pseudonym("user_id", salt))

    def each(batch: DataFrame, batch_id: int):
        totals = batch.withColumn("total_engagement_min", F.col("seconds") / 60.0).persist()
        try:
            if not totals.isEmpty():
                fresh = derive_stage(totals).select(*[c.split()[0] for c in jobs.STAGE_DDL.split(", ")])
                writes.upsert(spark, path, fresh, ["user_id", "journey_date"], ["journey_date"], schema=jobs.STAGE_DDL)
        finally:
            totals.unpersist()

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)             # keyed state with timers needs column families
    try:
        query = (user_days(on_time, vocab, days, slices).writeStream.outputMode("update").foreachBatch(each)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
    jobs._run(query)
    return path, [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
