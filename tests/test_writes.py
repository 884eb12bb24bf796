"""Write layer off the clean path: odd partition values, moving and NULL keys, plain paths, several runs."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lakeward.catalog.common import raw
from lakeward.operators import checks
from lakeward.plans import erasure, flow
from lakeward.sinks import writes
from lakeward.sources import fixture

DDL = "id string, day date, partner string, ok boolean, v int"
ODD = ["a:b", "x/y", "007", "", None, "p q", "100%", "true"]


def rows(spark, path, cols=("id", "partner", "v")):
    return sorted((tuple(r) for r in spark.read.schema(DDL).parquet(path).select(*cols).collect()), key=str)


def table(spark, values):
    return spark.createDataFrame(values, DDL).withColumn("day", F.coalesce("day", F.lit("2024-01-01").cast("date")))


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_upsert_with_odd_partition_values(spark, tmp_dir, scheme):
    path, part = f"{scheme}{tmp_dir}/t", ["day", "partner", "ok"]
    first = table(spark, [(f"k{i}", None, p, i % 2 == 0, 1) for i, p in enumerate(ODD)])
    writes.upsert(spark, path, first, ["id"], part)
    again = table(spark, [(f"k{i}", None, p, i % 2 == 0, 2) for i, p in enumerate(ODD)] + [("new", None, "a:b", True, 3)])
    for _ in range(2):                                              # replaying a batch changes nothing
        writes.upsert(spark, path, again, ["id"], part)
    want = [(f"k{i}", p or None, 2) for i, p in enumerate(ODD)] + [("new", "a:b", 3)]
    assert rows(spark, path) == sorted(want, key=str)


def test_key_that_changes_its_partition_moves(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    writes.upsert(spark, path, table(spark, [("a", None, "p1", True, 1), ("b", None, "p1", True, 1)]), ["id"], ["partner"])
    writes.upsert(spark, path, table(spark, [("a", None, "p2", True, 2)]), ["id"], ["partner"])
    assert rows(spark, path) == [("a", "p2", 2), ("b", "p1", 1)]


def test_null_key_is_one_key(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    for _ in range(3):
        writes.upsert(spark, path, table(spark, [(None, None, "p", True, 1)]), ["id"], ["partner"])
    assert rows(spark, path) == [(None, "p", 1)]
    with pytest.raises(writes.UpsertError):
        writes.upsert(spark, path, table(spark, [(None, None, "p", True, 1)] * 2), ["id"], ["partner"])


def test_many_touched_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    wide = spark.range(500).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("p"), "id").alias("partner"), F.lit(1).alias("v"))
    writes.upsert(spark, path, wide, ["id"], ["partner"])
    writes.upsert(spark, path, wide.withColumn("v", F.lit(2)), ["id"], ["partner"])
    assert spark.read.parquet(path).groupBy("v").count().collect() == [(2, 500)]


def test_staged_rows_without_a_place_are_an_error(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    writes.write_table(table(spark, [("a", None, "p1", True, 1)]), path, ["partner"])
    with pytest.raises(writes.MoveError):
        writes.replace_partitions(spark, table(spark, [("a", None, "p2", True, 2)]), path, ["partner"], [("p1",)])


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_append_keeps_partition_folders(spark, tmp_dir, scheme):
    for i in range(2):
        staged = f"{scheme}{tmp_dir}/staged{i}"
        writes.write_table(table(spark, [(f"k{i}", None, "a:b", True, i)]), staged, ["partner"])
        writes.append_by_rename(spark, staged, f"{tmp_dir}/bronze")
    assert rows(spark, f"{tmp_dir}/bronze") == [("k0", "a:b", 0), ("k1", "a:b", 1)]


def test_erasure_of_escaped_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    writes.write_table(table(spark, [("u1", None, p, True, i) for i, p in enumerate(ODD)] + [("u2", None, "a:b", True, 9)]), path, ["partner", "ok"])
    target = erasure.Target("t", path, "id", ("partner", "ok"), DDL)
    keys = spark.createDataFrame([("u1",)], "subject string")
    counts = erasure.erase_subjects(spark, [target], keys, f"{tmp_dir}/audit", "2024-02-01 00:00:00")
    assert counts == {"t": len(ODD)} and rows(spark, path) == [("u2", "a:b", 9)]


def test_silver_and_bronze_keep_earlier_runs(spark, tmp_dir):
    refs = {"silver.partners": fixture.partners(spark, SF001)}
    events = raw(spark, SF001).cache()
    half = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    for part in (events.where(half), events.where(~half)):
        res = flow.run_flow(spark, part, tmp_dir, fixture.SALT, "2024-02-01 00:00:00", fixture.FIXTURE_VOCAB, refs, "warn")
    silver = spark.read.parquet(res.engagement.outputs["target"])
    from lakeward.catalog.common import silver as expected
    assert silver.select("event_id").distinct().count() == silver.count() == expected(spark, SF001).count()
    assert spark.read.parquet(f"{tmp_dir}/bronze/engagement_events").count() == events.count()


def test_gate_sees_one_bad_row_among_millions(spark):
    df = spark.range(4_000_001).select(F.when(F.col("id") > 0, F.col("id")).alias("a"), F.greatest("id", F.lit(1)).alias("b"))
    report = {r["rule"]: r for r in checks.evaluate(df, [checks.completeness("a", 1.0), checks.uniqueness(["b"], 1.0)]).collect()}
    assert not report["completeness"]["passed"] and not report["uniqueness"]["passed"]
    empty = {r["rule"]: r["passed"] for r in checks.evaluate(df.limit(0), [checks.completeness("a", 0.9), checks.uniqueness(["b"], 1.0)]).collect()}
    assert empty == {"completeness": False, "uniqueness": True}
