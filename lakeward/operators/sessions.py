"""Inactivity sessionization.

Reference rule: per user, ordered by time, a gap of more than 1800 whole
seconds starts a new session; the session number is the running count of
such starts (RANGE frame, so tied timestamps share a number).

A plain ``Window.partitionBy(user)`` puts all of a user's events in one
task; with one user holding a third of the data that task is the job.  Here
the window runs per (user, time chunk), and a small per-(user, chunk) summary
(first/last timestamp, number of inner session starts) supplies what crosses
chunk boundaries: the gap before a chunk's first event and the session
offset of the chunk.  The summary has one row per user-chunk, so its per-user
window is tiny even for the heaviest user.  The result is identical to the
single-window definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the reference rule.
SESSION_GAP_SECONDS = 1800


def sessionize(df: DataFrame, user: str = "user_id", ts: str = "event_timestamp",
               gap_seconds: int = SESSION_GAP_SECONDS, chunk: str = "hour", precise: bool = False) -> DataFrame:
    """Add ``prev_ts``, ``gap_seconds``, ``new_session_flag`` and
    ``derived_session_id`` (0-based, per user, across partners and days).

    ``precise=False`` is the reference rule (whole epoch seconds, gap >
    ``gap_seconds``).  ``precise=True`` compares microseconds, which is the
    rule of ``session_window`` (a gap of exactly the timeout stays)."""
    unit = F.unix_micros if precise else F.unix_timestamp
    limit = gap_seconds * 1_000_000 if precise else gap_seconds

    def t(c):
        return unit(F.col(c).cast("timestamp")) if isinstance(c, str) else unit(c)

    sec = t(ts)
    d = df.withColumn("__chunk", F.date_trunc(chunk, F.col(ts)))
    w_local = Window.partitionBy(user, "__chunk").orderBy(ts)
    d = d.withColumn("__lprev", F.lag(ts).over(w_local))
    d = d.withColumn("__lflag", F.coalesce((sec - t("__lprev")) > limit, F.lit(False)).cast("int"))
    d = d.withColumn("__lsid", F.sum("__lflag").over(w_local))

    summary = d.groupBy(user, "__chunk").agg(F.min(ts).alias("__cmin"), F.max(ts).alias("__cmax"),
                                             F.sum("__lflag").alias("__cflags"))
    w_user = Window.partitionBy(user).orderBy("__chunk")
    summary = summary.withColumn("__pmax", F.lag("__cmax").over(w_user))
    first_flag = F.coalesce((t("__cmin") - t("__pmax")) > limit, F.lit(False)).cast("long")
    summary = summary.withColumn("__fflag", first_flag)
    upto = w_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w_user.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(user, "__chunk", "__pmax",
                             (F.sum("__fflag").over(upto)
                              + F.coalesce(F.sum("__cflags").over(before), F.lit(0))).alias("__offset"))

    out = d.join(summary, on=[user, "__chunk"], how="inner")
    prev = F.coalesce(F.col("__lprev"), F.col("__pmax"))
    gap = F.coalesce(F.unix_timestamp(F.col(ts)) - F.unix_timestamp(prev), F.lit(0)).cast("long")
    flag = F.coalesce((sec - t(prev)) > limit, F.lit(False)).cast("int")
    return (out.withColumn("prev_ts", prev)
               .withColumn("gap_seconds", gap)
               .withColumn("new_session_flag", flag)
               .withColumn("derived_session_id", (F.col("__offset") + F.col("__lsid")).cast("long"))
               .drop("__chunk", "__lprev", "__lflag", "__lsid", "__pmax", "__offset"))


def session_summary(sessionized: DataFrame, user: str = "user_id", ts: str = "event_timestamp") -> DataFrame:
    """One row per derived session."""
    return (sessionized.groupBy(user, "derived_session_id")
                       .agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"),
                            F.count(F.lit(1)).alias("events"))
                       .withColumn("duration_s", F.unix_timestamp("session_end") - F.unix_timestamp("session_start")))


def session_windows(df: DataFrame, user: str = "user_id", ts: str = "event_timestamp",
                    gap_seconds: int = SESSION_GAP_SECONDS, chunk: str = "hour") -> DataFrame:
    """The sessions of ``session_window(ts, gap)`` (microsecond gaps, a
    gap of exactly the timeout stays; a session ends at last event + gap).

    Spark's batch ``session_window`` aggregation shuffles every event of a
    user to one task before merging; here the chunked sessionizer assigns
    the sessions and a partially aggregated ``groupBy(user, session)``
    builds them, so a hot user is split by hour and by session."""
    s = sessionize(df, user, ts, gap_seconds, chunk, precise=True)
    return (s.groupBy(user, "derived_session_id")
             .agg(F.min(ts).alias("session_start"),
                  (F.max(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds)))
                  .alias("session_end"),
                  F.count(F.lit(1)).alias("events"))
             .select(user, "session_start", "session_end", "events"))


def session_windows_builtin(df: DataFrame, user: str = "user_id", ts: str = "event_timestamp",
                            gap: str = "30 minutes") -> DataFrame:
    """Spark's ``session_window`` aggregation (the streaming form uses it)."""
    return (df.groupBy(user, F.session_window(ts, gap).alias("session"))
              .agg(F.count(F.lit(1)).alias("events"))
              .select(user, F.col("session.start").alias("session_start"),
                      F.col("session.end").alias("session_end"), "events"))
