"""Single-step behaviour (the reference's transform tests, on our API)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeward.operators import steps

NOW = datetime(2024, 3, 1, 12, 0, 0)


@pytest.fixture
def sample_events(spark):
    rows = [
        ("e1", "user_001", "acme-corp", "session_start", NOW, NOW, "s1"),
        ("e2", "user_001", "acme-corp", "exercise_complete", NOW, NOW, "s1"),
        ("e3", "user_002", "globex", "session_start", NOW - timedelta(hours=1), NOW, "s2"),
        ("e1", "user_001", "acme-corp", "session_start", NOW, NOW + timedelta(seconds=30), "s1"),
        ("e4", "user_003", "initech", "session_end", NOW - timedelta(days=10), NOW, "s3"),
    ]
    cols = ["event_id", "user_id", "partner_id", "event_type", "event_timestamp", "ingest_timestamp", "session_id"]
    return spark.createDataFrame(rows, cols)


def test_dedup_keeps_latest(sample_events):
    out = steps.dedup_latest(sample_events, ["event_id"], "ingest_timestamp")
    assert out.count() == 4
    e1 = out.where("event_id = 'e1'").collect()
    assert len(e1) == 1 and e1[0]["ingest_timestamp"] == NOW + timedelta(seconds=30)


def test_dedup_agg_form_matches(sample_events):
    a = steps.dedup_latest(sample_events, ["event_id"], "ingest_timestamp")
    b = steps.dedup_latest_agg(sample_events, ["event_id"], "ingest_timestamp")
    assert sorted(a.collect()) == sorted(b.collect())


def test_filter_routes_late_rows(sample_events):
    pred = f"event_timestamp >= timestamp'{NOW:%Y-%m-%d %H:%M:%S}' - INTERVAL 7 DAYS"
    res = steps.filter_step(sample_events, pred, "late_event_handling")
    assert res.kept.count() == 4
    rej = res.rejected.collect()
    assert [r["event_id"] for r in rej] == ["e4"]
    assert rej[0][steps.REJECT_REASON] == "late_event_handling"


def test_filter_without_quarantine(sample_events):
    res = steps.filter_step(sample_events, "event_type != 'session_end'", "f", quarantine=False)
    assert res.rejected is None and res.kept.count() == 4


def test_hash_format_and_position(sample_events):
    out = steps.pseudonymize(sample_events, "user_id", "salt")
    assert out.columns == sample_events.columns          # position kept
    vals = [r["user_id"] for r in out.collect()]
    assert all(len(v) == 64 and all(c in "0123456789abcdef" for c in v) for v in vals)


def test_hash_deterministic_and_null_safe(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "user_id string")
    out = [r[0] for r in steps.pseudonymize(df, "user_id", "s").collect()]
    assert out[0] == out[1] and out[2] is None
    import hashlib
    assert out[0] == hashlib.sha256(b"sa").hexdigest()


def test_null_predicate_rows_are_rejected_not_lost(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 20)], "id int, v int")
    kept, rej = steps.split_by(df, "v > 10", "big")
    assert kept.count() + rej.count() == 3
    reasons = {r["id"]: r[steps.REJECT_REASON] for r in rej.collect()}
    assert reasons == {1: "big", 2: "big:null"}


def test_sql_step_replaces_whole_name_only(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    out = steps.sql_step(spark, df, "SELECT count(*) AS n FROM silver.engagement_events", table="silver.engagement_events")
    assert out.first()["n"] == 2
    with pytest.raises(Exception):
        steps.sql_step(spark, df, "SELECT * FROM silver.engagement_events_v2", table="silver.engagement_events").count()


def test_function_step_allow_list(spark):
    df = spark.createDataFrame([(1,)], "x int")
    steps.register("plus_one")(lambda d: d.withColumn("x", F.col("x") + 1))
    assert steps.function_step(df, "plus_one").first()["x"] == 2
    with pytest.raises(KeyError):
        steps.function_step(df, "os.system")


def test_bag_to_struct_uses_try_cast(spark):
    df = spark.createDataFrame([({"duration_seconds": "60", "is_first_session": "true"},),
                                ({"duration_seconds": "abc"},)], "event_properties map<string,string>")
    out = steps.upgrade_bag(df, "event_properties", {"duration_seconds": "int", "is_first_session": "boolean"},
                            {"clinical_intensity": "double"}).collect()
    assert out[0]["event_properties"]["duration_seconds"] == 60
    assert out[0]["event_properties"]["is_first_session"] is True
    assert out[1]["event_properties"]["duration_seconds"] is None
    assert out[0]["clinical_intensity"] is None
