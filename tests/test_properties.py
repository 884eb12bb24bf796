"""Properties: kept + rejected = input, chunked sessionization = one-window
definition, upsert idempotence, erase then preview = 0, partition handling."""

from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF01, plain_sessions
from lakeward.catalog.common import silver
from lakeward.operators import sessions, steps
from lakeward.plans import erasure
from lakeward.sinks import writes
from lakeward.sources import fixture

T0 = datetime(2024, 1, 1, 23, 0, 0)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 6 * 3600), st.integers(0, 2)), min_size=1, max_size=60))
def test_chunked_sessionize_equals_single_window(spark, rows):
    # offsets around midnight and hour boundaries, with ties and exact 1800 s gaps
    data = [(f"u{u}", T0 + timedelta(seconds=s - s % 900 if k == 0 else s), f"e{i}")
            for i, (u, s, k) in enumerate(rows)]
    df = spark.createDataFrame(data, "user_id string, event_timestamp timestamp, event_id string")
    a = sessions.sessionize(df).select("event_id", "derived_session_id", "new_session_flag")
    ra = {r["event_id"]: r["derived_session_id"] for r in a.collect()}
    rb = plain_sessions([tuple(r) for r in df.select("user_id", "event_timestamp", "event_id").collect()])
    assert ra == rb


def test_gap_of_exactly_1800_stays(spark):
    df = spark.createDataFrame([("u", T0, "a"), ("u", T0 + timedelta(seconds=1800), "b"),
                                ("u", T0 + timedelta(seconds=3601), "c")],
                               "user_id string, event_timestamp timestamp, event_id string")
    ids = {r["event_id"]: r["derived_session_id"] for r in sessions.sessionize(df).collect()}
    assert ids == {"a": 0, "b": 0, "c": 1}


def test_chunked_sessionize_equals_single_window_on_fixture(spark):
    s = silver(spark, SF01).where("user_id is not null")
    a = sessions.sessionize(s).select("event_id", "derived_session_id")
    want = plain_sessions([tuple(r) for r in s.select("user_id", "event_timestamp", "event_id").collect()])
    assert {r["event_id"]: r["derived_session_id"] for r in a.collect()} == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=0, max_size=30))
def test_split_keeps_every_row(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    kept, rej = steps.split_by(df, "v > 0", "pos")
    assert kept.count() + rej.count() == len(values)


def test_upsert_twice_equals_once(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    ddl = "k int, v string, d date"
    base = spark.createDataFrame([(1, "a", datetime(2024, 1, 1).date()), (2, "b", datetime(2024, 1, 2).date())], ddl)
    writes.write_table(base, path, ["d"])
    upd = spark.createDataFrame([(2, "B", datetime(2024, 1, 2).date()), (3, "c", datetime(2024, 1, 3).date())], ddl)
    writes.upsert(spark, path, upd, ["k"], ["d"], schema=ddl)
    once = sorted(spark.read.schema(ddl).parquet(path).collect())
    writes.upsert(spark, path, upd, ["k"], ["d"], schema=ddl)
    twice = sorted(spark.read.schema(ddl).parquet(path).collect())
    assert once == twice
    assert [(r["k"], r["v"]) for r in once] == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_refuses_duplicate_keys(spark, tmp_dir):
    upd = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(writes.UpsertError):
        writes.upsert(spark, f"{tmp_dir}/x", upd, ["k"])


def test_partition_values_keep_declared_type(spark, tmp_dir):
    df = spark.createDataFrame([("007", 1)], "code string, v int")
    writes.write_table(df, f"{tmp_dir}/p", ["code"])
    assert spark.read.schema("v int, code string").parquet(f"{tmp_dir}/p").first()["code"] == "007"


def test_erase_then_preview_is_zero_and_empty_partitions_go(spark, tmp_dir):
    ddl = "user_id string, v int, d string"
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "y"), (None, 4, "y")]
    path = f"{tmp_dir}/silver"
    writes.write_table(spark.createDataFrame(rows, ddl), path, ["d"])
    keys = erasure.subjects(spark, spark.createDataFrame([("raw-a",)], "r string"), "r", "s")
    # the stored ids are pseudonyms of raw ids
    stored = spark.createDataFrame(rows, ddl).withColumn(
        "user_id", F.when(F.col("user_id") == "a", F.sha2(F.lit("sraw-a"), 256)).otherwise(F.col("user_id")))
    writes.write_table(stored, path, ["d"])
    t = [erasure.Target("silver.t", path, "user_id", ("d",), ddl)]
    assert erasure.erase_preview(spark, t, keys).first()["rows"] == 2
    counts = erasure.erase_subjects(spark, t, keys, f"{tmp_dir}/audit", "2024-02-01 00:00:00")
    assert counts == {"silver.t": 2}
    back = spark.read.schema(ddl).parquet(path)
    assert sorted((r["v"], r["d"]) for r in back.collect()) == [(3, "y"), (4, "y")]   # NULL user kept
    assert erasure.erase_preview(spark, t, keys).count() == 0
    import os
    assert not os.path.exists(f"{path}/d=x")                                        # emptied partition deleted
    audit = spark.read.parquet(f"{tmp_dir}/audit").collect()
    assert all(r["subject"] != "raw-a" for r in audit)                               # pseudonyms only


def test_fixture_raw_single_scan(spark):
    plan = fixture.raw_events(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2            # events + customer, once each


def test_erasure_recomputes_rollup_keys(spark, tmp_dir):
    """Erasing a subject rewrites the derived rollup rows it fed, and a key
    whose only rows were the subject's disappears."""
    ddl = "user_id string, partner_id string, v int, d string"
    rows = [("pa", "p1", 1, "x"), ("pb", "p1", 2, "x"), ("pa", "p2", 3, "y")]
    src = f"{tmp_dir}/src"
    writes.write_table(spark.createDataFrame(rows, ddl), src, ["d"])
    roll_ddl = "partner_id string, total bigint, users bigint, d string"

    def recompute(r):
        return r.groupBy("partner_id", "d").agg(F.sum("v").cast("bigint").alias("total"),
                                                F.count_distinct("user_id").alias("users"))
    gold = f"{tmp_dir}/gold"
    writes.write_table(recompute(spark.read.schema(ddl).parquet(src)), gold, ["d"])
    keys = spark.createDataFrame([("pa",)], "subject string")
    t = erasure.Target("src", src, "user_id", ("d",), ddl)
    r = erasure.Rollup(gold, ("partner_id", "d"), ("d",), {"partner_id": "partner_id", "d": "d"}, recompute, roll_ddl)
    erasure.erase_subjects(spark, [t], keys, f"{tmp_dir}/audit", "2024-02-01 00:00:00", rollups={"src": [r]})
    out = sorted(tuple(x) for x in spark.read.schema(roll_ddl).parquet(gold).collect())
    assert out == [("p1", 2, 1, "x")]                  # p2/y only had the subject's rows: gone


def test_erasure_of_raw_id_table(spark, tmp_dir):
    ddl = "user_id string, v int, d string"
    path = f"{tmp_dir}/bronze"
    writes.write_table(spark.createDataFrame([("7", 1, "x"), ("8", 2, "x"), (None, 3, "y")], ddl), path, ["d"])
    keys = erasure.subjects(spark, spark.createDataFrame([("7",)], "r string"), "r", "salt")
    t = erasure.Target("bronze", path, "user_id", ("d",), ddl, raw_salt="salt")
    assert erasure.erase_subjects(spark, [t], keys, f"{tmp_dir}/audit", "2024-02-01 00:00:00") == {"bronze": 1}
    assert sorted(r["v"] for r in spark.read.schema(ddl).parquet(path).collect()) == [2, 3]


def test_one_pass_set_operations_match_builtin(spark):
    from lakeward.operators import sets
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (3,), (4,)], "x int")
    one = sorted(tuple(r) for r in sets.difference_both_ways(a, b, "l", "r").collect())
    two = sorted(tuple(r) for r in sets.difference_both_ways_except_all(a, b, "l", "r").collect())
    assert one == two == [(1, "l"), (2, "l"), (3, "r"), (4, "r")]
    days = spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 1), ("u3", 2), ("u3", 2)], "u string, d int")
    assert sorted(r[0] for r in sets.present_in_all(days, "u", "d", [1, 2]).collect()) == ["u1"]
    assert sorted(r[0] for r in sets.common(days.where("d = 1").select("u"), days.where("d = 2").select("u")).collect()) == ["u1"]


def test_approx_dau_error_bound(spark):
    from lakeward.catalog.common import silver
    from lakeward.operators.rollups import approx_dau
    rows = approx_dau(silver(spark, SF01)).collect()
    assert rows and all(abs(r["dau_approx"] - r["dau"]) <= max(1, 0.05 * r["dau"]) for r in rows)


def test_approx_dau_holds_a_sketch_per_partner_day_only(spark):
    """No aggregation keyed by the user carries a sketch; repeats, NULL users, partners and times count as before."""
    from lakeward.operators.rollups import approx_dau
    day = T0.replace(hour=1)
    events = spark.createDataFrame([("p", day, "a"), ("p", day, "a"), ("p", day, "b"), ("p", day, None), ("p", day + timedelta(days=1), None),
                                    (None, day, "a"), ("q", None, "c")], "partner_id string, event_timestamp timestamp, user_id string")
    out = approx_dau(events)
    got = {(r["partner_id"], str(r["metric_date"])): (r["dau_approx"], r["dau"]) for r in out.collect()}
    assert got == {("p", str(day.date())): (2, 2), ("p", str((day + timedelta(days=1)).date())): (0, 0), (None, str(day.date())): (1, 1), ("q", "None"): (1, 1)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    sketched = [line for line in plan.splitlines() if "Aggregate(" in line and "approx_count_distinct" in line]
    assert sketched and not any("user_id" in line.split("keys=")[1].split("functions=")[0] for line in sketched), plan


def test_table_registry_resolves_dotted_names(spark, tmp_dir):
    from lakeward.sources.tables import TableRegistry
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp_dir}/silver/partners")
    reg = TableRegistry(spark, tmp_dir)
    assert reg.get("silver.partners", "x int").count() == 1
    reg.register("gold.x", spark.createDataFrame([(2,)], "x int"))
    assert "gold.x" in reg and reg.get("gold.x").first()["x"] == 2


@pytest.mark.parametrize("bucket", ["1 hour", "15 minutes", "2 hours", "1 day"])
def test_interval_join_is_the_same_for_any_bucket(spark, bucket):
    from lakeward.operators import joins

    events = spark.createDataFrame([("u", T0 + timedelta(minutes=7 * i), i) for i in range(40)], "k string, ts timestamp, i int")
    spans = spark.createDataFrame([("u", T0 + timedelta(minutes=a), T0 + timedelta(minutes=b), a) for a, b in ((0, 0), (10, 95), (50, 300))],
                                  "k string, s timestamp, e timestamp, a int")
    got = sorted((r["i"], r["a"]) for r in joins.interval_join(events, spans, "k", "ts", "s", "e", bucket).collect())
    assert got == sorted((i, a) for i in range(40) for a, b in ((0, 0), (10, 95), (50, 300)) if a <= 7 * i <= b)
