"""Keyed running stage: equals the recomputed one, any order of rows, copies, bounded state."""

import random
from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from lakeward.catalog.common import VOCAB, raw
from lakeward.sources import fixture
from lakeward.streaming import jobs, stage_state


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=40), st.integers(1, 30), st.randoms())
def test_spans_do_not_depend_on_order(seconds, gap, rnd):
    starts, ends = [], []
    left = seconds[:]
    rnd.shuffle(left)
    while left:                                   # batches of any size
        n = rnd.randint(1, len(left))
        stage_state.merge_seconds(starts, ends, sorted(set(left[:n])), gap)
        left = left[n:]
    want = []
    for s in sorted(set(seconds)):
        if want and s - want[-1][1] <= gap:
            want[-1][1] = s
        else:
            want.append([s, s])
    assert [list(x) for x in zip(starts, ends)] == want


def test_equals_recomputed_stage_over_shuffled_loads(spark, tmp_dir):
    rows = raw(spark, SF001)
    paths = {}
    for name in ("state", "again"):
        root = f"{tmp_dir}/{name}"
        for lo, hi in (("2024-01-01", "2024-01-12"), ("2024-01-12", "2024-03-01")):
            load = rows.where((F.col("ingest_timestamp") >= lo) & (F.col("ingest_timestamp") < hi)).orderBy(F.rand(3))
            jobs.write_landing(load, f"{root}/landing", by_day=False)
            if name == "state":
                paths[name], left = stage_state.run(spark, f"{root}/landing", root, f"{root}/ckpt", fixture.SALT, VOCAB)
            else:
                paths[name] = jobs.running_stage(spark, f"{root}/landing", root, f"{root}/ckpt", fixture.SALT, VOCAB)
    got, want = (sorted((r.user_id, r.journey_date, r.session_count, round(r.total_engagement_min, 6), r.derived_stage)
                        for r in spark.read.schema(jobs.STAGE_DDL).parquet(paths[n]).collect()) for n in ("state", "again"))
    assert got and got == want
    assert left                                   # the state that is left is reported


def _event(n, ts, user="u", kind="view", seconds=None):
    return (str(n), ts, ts + timedelta(minutes=1), user, "p", kind, "s", seconds, "false", 0)


def test_state_is_bounded_by_the_open_days(spark, tmp_dir):
    """Forty days of one user, one load a day: the state rows do not grow with the stream."""
    ddl = ("event_id string, event_timestamp timestamp, ingest_timestamp timestamp, user_id string, partner_id string, "
           "event_type string, session_id string, duration_seconds double, is_first_session string, copy int")
    begin, left = datetime(2024, 1, 1, 9), []
    for block in range(4):
        days = [begin + timedelta(days=10 * block + d) for d in range(10)]
        events = [_event(f"{t:%d%m}-{k}", t + timedelta(hours=k), kind="purchase" if k == 1 else "view", seconds=90.0)
                  for t in days for k in range(3)]
        random.Random(block).shuffle(events)
        events += events[:5]                      # copies
        jobs.write_landing(spark.createDataFrame(events, ddl), f"{tmp_dir}/landing")
        path, sizes = stage_state.run(spark, f"{tmp_dir}/landing", tmp_dir, f"{tmp_dir}/ckpt", "x", VOCAB)
        left.append(sizes[-1])
    out = spark.read.schema(jobs.STAGE_DDL).parquet(path).collect()
    assert len(out) == 40
    assert {(r.session_count, r.total_engagement_min) for r in out} == {(3, 1.5)}
    assert max(left) <= 9 * 4                     # open days x (spans, one closing event, timers)


def test_empty_and_anonymous(spark, tmp_dir):
    ddl = ("event_id string, event_timestamp timestamp, ingest_timestamp timestamp, user_id string, partner_id string, "
           "event_type string, session_id string, duration_seconds double, is_first_session string, copy int")
    rows = spark.createDataFrame([_event(1, datetime(2024, 1, 1), user=None), _event(2, datetime(2024, 1, 2), kind="purchase")], ddl)
    jobs.write_landing(rows, f"{tmp_dir}/landing")
    path, _ = stage_state.run(spark, f"{tmp_dir}/landing", tmp_dir, f"{tmp_dir}/ckpt", "x", VOCAB)
    out = spark.read.schema(jobs.STAGE_DDL).parquet(path).collect()
    assert [(r.session_count, r.total_engagement_min) for r in out] == [(1, 0.0)]   # a closing event without a duration


def test_state_and_calls_do_not_grow_with_the_users(spark, tmp_dir):
    """Six hundred users of one day in two loads: the state rows are bounded by the slices, every user-day is right."""
    ddl = ("event_id string, event_timestamp timestamp, ingest_timestamp timestamp, user_id string, partner_id string, "
           "event_type string, session_id string, duration_seconds double, is_first_session string, copy int")
    t = datetime(2024, 1, 1, 9)
    first = [_event(f"{u}-a", t, f"u{u}", "purchase", 60.0) for u in range(600)]
    again = first[:300] + [_event(f"{u}-b", t + timedelta(hours=2), f"u{u}", "purchase", 30.0) for u in range(100)]
    again += [_event("0-a", t + timedelta(minutes=5), "u599", "purchase", 60.0)]          # another user's id is not a copy
    for load in (first, again):
        jobs.write_landing(spark.createDataFrame(load, ddl), f"{tmp_dir}/landing")
        path, left = stage_state.run(spark, f"{tmp_dir}/landing", tmp_dir, f"{tmp_dir}/ckpt", "x", VOCAB)
        assert left[-1] <= 128 * 4                # slices x (spans, closing events, timers)
    out = spark.read.schema(jobs.STAGE_DDL).parquet(path).collect()
    got = sorted((r.session_count, r.total_engagement_min) for r in out)
    assert got == [(1, 1.0)] * 499 + [(1, 2.0)] + [(2, 1.5)] * 100
