"""Streaming: incremental runs equal one run, batch and stream agree,
replays are idempotent, metrics are observed, malformed lines are kept."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from lakeward.catalog.common import gold_daily, raw, silver
from lakeward.sources import fixture, landing
from lakeward.streaming import jobs


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


GOLD_COLS = ["partner_id", "metric_date", "dau", "total_sessions", "exercise_completions", "new_signups"]


def test_incremental_rollup_equals_batch(spark, tmp_dir):
    r = raw(spark, SF001).cache()
    cut = F.lit("2024-01-15").cast("timestamp")
    land = f"{tmp_dir}/landing"
    landing.write_landing(r.where(F.col("ingest_timestamp") < cut), land)
    out = jobs.exact_rollup(spark, land, tmp_dir, f"{tmp_dir}/ckpt", fixture.SALT, fixture.FIXTURE_VOCAB)
    landing.write_landing(r.where(F.col("ingest_timestamp") >= cut), land)
    out = jobs.exact_rollup(spark, land, tmp_dir, f"{tmp_dir}/ckpt", fixture.SALT, fixture.FIXTURE_VOCAB)
    g = spark.read.schema(jobs.GOLD_DDL).parquet(out["gold"])
    assert _rows(g, GOLD_COLS) == _rows(gold_daily(spark, SF001), GOLD_COLS)
    s = spark.read.schema(jobs.SILVER_DDL).parquet(out["silver"])
    assert s.count() == silver(spark, SF001).count()


def test_stream_dedup_rows_equal_batch_silver(spark, tmp_dir):
    land = landing.write_landing(raw(spark, SF001), f"{tmp_dir}/landing")
    path = jobs.dedup_to_table(spark, land, tmp_dir, f"{tmp_dir}/ckpt", fixture.SALT)
    st = spark.read.parquet(path)
    b = silver(spark, SF001)
    assert st.count() == b.count()
    assert _rows(st.select("event_id"), ["event_id"]) == _rows(b.select("event_id"), ["event_id"])


def test_batch_writer_replay_is_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    w = jobs._batch_partition_writer(f"{tmp_dir}/sink")
    w(df, 0)
    w(df, 0)                                      # the same batch replayed
    w(df.limit(1), 1)
    assert spark.read.parquet(f"{tmp_dir}/sink").count() == 3


def test_observed_metrics(spark, tmp_dir):
    r = raw(spark, SF001)
    land = landing.write_landing(r, f"{tmp_dir}/landing")
    m = jobs.observed_metrics(spark, land, f"{tmp_dir}/ckpt")
    assert m["rows"] == r.count()
    late = r.where(~F.coalesce(F.expr(fixture.late_predicate()), F.lit(False))).count()
    assert m["within_sla"] == r.count() - late
    assert m["max_lag_s"] >= 8 * 86400


def test_malformed_lines_are_quarantined(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    os.makedirs(land)
    with open(f"{land}/part-bad.json", "w") as fh:
        fh.write('{"event_id": "x1", "event_timestamp": "2024-01-01T00:00:00.000000", '
                 '"ingest_timestamp": "2024-01-01T00:01:00.000000", "user_id": "1"}\n')
        fh.write('{"event_id": "x2", "event_timestamp": "not a time", '
                 '"ingest_timestamp": "2024-01-01T00:01:00.000000"}\n')
        fh.write('this is not json\n')
    good, bad = landing.read_json_events(spark, land)
    assert [r["event_id"] for r in good.collect()] == ["x1"]
    assert bad.count() == 2
    out = jobs.land(spark, land, tmp_dir, f"{tmp_dir}/ckpt")
    assert spark.read.parquet(out["bronze"]).count() == 1
    assert spark.read.parquet(out["quarantine"]).count() == 2


def _two_loads(spark, tmp_dir, job):
    """An event of day 4 that arrives on time in the second load, behind events of day 10; ``job`` runs after each load."""
    from datetime import datetime, timedelta

    schema = raw(spark, SF001).schema
    start = datetime(2024, 1, 1)

    def rows(*events):
        base = {"user_id": "u", "partner_id": "p", "event_type": "view", "session_id": "s", "is_first_session": "false", "copy": 0}
        made = [{**base, "event_id": k, "event_timestamp": start + timedelta(days=at), "ingest_timestamp": start + timedelta(days=seen)}
                for k, at, seen in events]
        return spark.createDataFrame([tuple(m.get(f.name) for f in schema) for m in made], schema)

    land = f"{tmp_dir}/landing"
    landing.write_landing(rows(("a", 10, 10), ("b", 10.001, 10.001)), land)
    job(land)
    landing.write_landing(rows(("c", 4, 10.5), ("d", 30, 30)), land)
    return job(land)


def test_windows_lose_no_on_time_row_of_a_later_load(spark, tmp_dir):
    path = _two_loads(spark, tmp_dir, lambda land: jobs.windowed_counts(spark, land, tmp_dir, f"{tmp_dir}/ckpt", fixture.SALT))
    got = sorted((r["window_start"].day, r["deliveries"]) for r in spark.read.parquet(path).collect())
    assert got == [(5, 1), (11, 2)]               # day 31 is still open


def test_sessions_lose_no_on_time_row_of_a_later_load(spark, tmp_dir):
    path = _two_loads(spark, tmp_dir, lambda land: jobs.session_windows(spark, land, tmp_dir, f"{tmp_dir}/ckpt", fixture.SALT))
    got = sorted((r["session_start"].day, r["events"]) for r in spark.read.parquet(path).collect())
    assert got == [(5, 1), (11, 2)]


def test_metrics_are_totalled_over_every_batch_and_load(spark, tmp_dir):
    m = _two_loads(spark, tmp_dir, lambda land: jobs.observed_metrics(spark, land, f"{tmp_dir}/ckpt", max_files=1))
    assert m == {"rows": 4, "within_sla": 3, "max_lag_s": int(6.5 * 86400)}


def test_stage_of_an_earlier_day_is_corrected_by_a_later_load(spark, tmp_dir):
    """Day 10 keeps its row and day 4, which arrives behind it, gets its own; a replayed load changes nothing."""
    def job(land):
        return jobs.running_stage(spark, land, tmp_dir, f"{tmp_dir}/ckpt", fixture.SALT, fixture.FIXTURE_VOCAB)

    path = _two_loads(spark, tmp_dir, job)
    cols = ["journey_date", "session_count", "derived_stage"]
    want = [(5, 1, "lapsing"), (11, 1, "lapsing"), (31, 1, "lapsing")]
    table = spark.read.schema(jobs.STAGE_DDL).parquet(path)
    assert [(d.day, n, s) for d, n, s in _rows(table, cols)] == want
    job(f"{tmp_dir}/landing")
    jobs.running_stage(spark, f"{tmp_dir}/landing", tmp_dir, f"{tmp_dir}/other", fixture.SALT, fixture.FIXTURE_VOCAB)
    assert [(d.day, n, s) for d, n, s in _rows(spark.read.schema(jobs.STAGE_DDL).parquet(path), cols)] == want
