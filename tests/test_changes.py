"""Change log, versioned merge, backfill and replayed runs off the clean path."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lakeward.catalog.common import raw
from lakeward.plans import backfill, flow
from lakeward.plans.runner import run_product
from lakeward.products import ENGAGEMENT_EVENTS
from lakeward.model import load_product
from lakeward.sinks import changes, writes
from lakeward.sources import fixture

DDL = "id string, day date, partner string, at int, v int"
WARN = load_product({**ENGAGEMENT_EVENTS, "quality": {**ENGAGEMENT_EVENTS["quality"], "on_failure": "warn"}})


def table(spark, values):
    return spark.createDataFrame([(i, None, p, at, v) for i, p, at, v in values], DDL).withColumn("day", F.lit("2024-01-01").cast("date"))


def log_rows(spark, path):
    df = spark.read.schema(f"_change string, {DDL}, commit string").parquet(path)
    return sorted((tuple(r) for r in df.select("commit", "_change", "id", "partner", "v").collect()), key=str)


def stored(spark, path):
    return sorted((tuple(r) for r in spark.read.schema(DDL).parquet(path).select("id", "partner", "at", "v").collect()), key=str)


@pytest.mark.parametrize("partition", [["partner"], []])
def test_log_holds_the_images_of_changed_rows_alone(spark, tmp_dir, partition):
    path, log = f"{tmp_dir}/t", f"{tmp_dir}/log"
    writes.upsert(spark, path, table(spark, [("a", "p", 1, 1), ("b", "007", 1, 1), (None, "p", 1, None)]), ["id"], partition, schema=DDL, log=changes.ChangeLog(log, "c1"))
    writes.upsert(spark, path, table(spark, [("a", "q", 2, 1), ("b", "007", 1, 1), (None, "p", 1, 5), ("c", None, 1, 1)]), ["id"], partition, schema=DDL, log=changes.ChangeLog(log, "c2"))
    assert log_rows(spark, log) == sorted([
        ("c1", "insert", "a", "p", 1), ("c1", "insert", "b", "007", 1), ("c1", "insert", None, "p", None),
        ("c2", "update_before", "a", "p", 1), ("c2", "update_after", "a", "q", 1), ("c2", "update_before", None, "p", None),
        ("c2", "update_after", None, "p", 5), ("c2", "insert", "c", None, 1)], key=str)
    before = stored(spark, path)
    writes.upsert(spark, path, table(spark, [("a", "z", 9, 9)]), ["id"], partition, schema=DDL, log=changes.ChangeLog(log, "c2"))   # c2 is done
    assert stored(spark, path) == before and len(log_rows(spark, log)) == 8


def test_interrupted_commit_keeps_its_first_images(spark, tmp_dir, monkeypatch):
    path, log = f"{tmp_dir}/t", f"{tmp_dir}/log"
    writes.upsert(spark, path, table(spark, [("a", "p", 1, 1), ("b", "q", 1, 1)]), ["id"], ["partner"], log=changes.ChangeLog(log, "c1"))
    edit = table(spark, [("a", "p", 2, 2), ("b", "q", 2, 2)])
    swap = writes.swap_partitions

    def crash(*args):
        swap(*args)
        raise RuntimeError("executor and driver lost after the swap")

    monkeypatch.setattr(writes, "swap_partitions", crash)
    with pytest.raises(RuntimeError):
        writes.upsert(spark, path, edit, ["id"], ["partner"], log=changes.ChangeLog(log, "c2"))
    monkeypatch.setattr(writes, "swap_partitions", swap)
    assert {r[0] for r in log_rows(spark, log)} == {"c1"}                     # not visible yet
    writes.upsert(spark, path, edit, ["id"], ["partner"], log=changes.ChangeLog(log, "c2"))
    assert [r for r in log_rows(spark, log) if r[0] == "c2"] == sorted([("c2", op, i, p, v) for i, p in (("a", "p"), ("b", "q"))
                                                                       for op, v in (("update_before", 1), ("update_after", 2))], key=str)
    assert stored(spark, path) == [("a", "p", 2, 2), ("b", "q", 2, 2)]


def test_older_copies_never_win(spark, tmp_dir):
    path = f"{tmp_dir}/t"

    def merge(values):
        writes.upsert(spark, path, table(spark, values), ["id"], ["partner"], schema=DDL, latest_by=["at"])

    merge([("a", "p", 5, 1), ("b", "p", None, 1), (None, "p", 5, 1)])
    merge([("a", "q", 4, 2), ("b", "q", 1, 2), (None, "q", 6, 2), ("c", "p", None, 2)])
    assert stored(spark, path) == sorted([("a", "p", 5, 1), ("b", "q", 1, 2), (None, "q", 6, 2), ("c", "p", None, 2)], key=str)
    merge([("a", "p", 5, 3), ("b", "q", None, 3)])                             # equal order: the update; NULL is oldest
    assert stored(spark, path) == sorted([("a", "p", 5, 3), ("b", "q", 1, 2), (None, "q", 6, 2), ("c", "p", None, 2)], key=str)


def test_fixed_partition_columns_prune_the_search(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    wide = spark.range(40).select(F.col("id").cast("string").alias("id"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 20).cast("int")).alias("day"),
                                  F.lit("p").alias("partner"), F.lit(1).alias("at"), F.lit(1).alias("v"))
    writes.upsert(spark, path, wide, ["id"], ["day", "partner"], schema=DDL)
    edit = wide.where("id = '3'").withColumns({"partner": F.lit("q"), "v": F.lit(2)})
    current = spark.read.schema(DDL).parquet(path)
    plan = writes._of_values(current, edit, ["day"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Filters: \[isnotnull\(day#\d+\), \(day#\d+ = 2024-01-04\)\], PushedFilters", plan)          # one partition is listed
    writes.upsert(spark, path, edit, ["id"], ["day", "partner"], schema=DDL, fixed=["day"])
    back = spark.read.schema(DDL).parquet(path)
    assert back.count() == 40 and [tuple(r) for r in back.where("v = 2").select("id", "partner").collect()] == [("3", "q")]


def test_partner_007_goes_through_the_flow(spark, tmp_dir):
    events = raw(spark, SF001).withColumn("partner_id", F.lit("007"))
    refs = {"silver.partners": spark.createDataFrame([("007",)], "partner_id string")}
    res = flow.run_flow(spark, events, tmp_dir, fixture.SALT, "2024-02-01 00:00:00", fixture.FIXTURE_VOCAB, refs, "warn")
    gold = spark.read.schema("partner_id string, dau bigint").parquet(res.dashboard.outputs["target"])
    assert {r[0] for r in gold.select("partner_id").distinct().collect()} == {"007"}


def test_backfill_equals_a_full_run(spark, tmp_dir):
    """Copies 10 days apart, a copy that changes the partner, a stored row that is newer than bronze."""
    cols = "event_id string, event_timestamp timestamp, ingest_timestamp timestamp, user_id string, partner_id string, event_type string, session_id string, duration_seconds double, is_first_session string, copy int, ingest_date date"

    def rows(values):
        return spark.createDataFrame([(e, t, i, "u", p, k, "s", 1.0, "false", 0) for e, t, i, p, k in values],
                                     "event_id string, event_timestamp string, ingest_timestamp string, user_id string, partner_id string, event_type string, session_id string, duration_seconds double, is_first_session string, copy int"
                                     ).withColumns({c: F.col(c).cast("timestamp") for c in ("event_timestamp", "ingest_timestamp")})

    first = [("a", "2024-01-05 10:00", "2024-01-05 10:01", "p", "view"), ("b", "2024-01-05 11:00", "2024-01-05 11:01", "p", "view"),
             ("c", "2024-01-05 12:00", "2024-01-05 12:01", "p", "view"), ("d", "2024-01-09 12:00", "2024-01-09 12:01", "p", "view"),
             ("e", "2024-01-05 13:00", "2024-01-05 13:01", "p", "view")]
    later = [("a", "2024-01-05 10:00", "2024-01-15 10:00", "p", "error"), ("b", "2024-01-05 11:00", "2024-01-08 11:00", "q", "click"),
             ("d", "2024-01-09 12:00", "2024-01-10 12:00", "q", "click")]
    run_product(spark, WARN, rows(first + [("e", "2024-01-05 13:00", "2024-01-06 13:00", "p", "click")]), f"{tmp_dir}/one", "salt", "ingest_timestamp",
                refs={"silver.partners": spark.createDataFrame([("p",), ("q",)], "partner_id string")})
    bronze, target = f"{tmp_dir}/bronze", f"{tmp_dir}/one/silver/engagement_events"
    writes.write_table(rows(first + later).withColumn("ingest_date", F.to_date("ingest_timestamp")), bronze, ["ingest_date"])
    ddl = f"{WARN.ddl()}, event_date date"
    log = f"{tmp_dir}/log"
    for _ in range(2):
        backfill.backfill_table(spark, WARN, bronze, target, "2024-01-05", "2024-01-06", "salt", schema=cols, target_schema=ddl, log=changes.ChangeLog(log, "b1"))
    got = sorted(tuple(r) for r in spark.read.schema(ddl).parquet(target).select("event_id", "partner_id", "event_type").collect())
    # a: the survivor is 10 days late, so a full run rejects it; b: moved; c: as it was; d: outside the range; e: newer than bronze
    assert got == [("b", "q", "click"), ("c", "p", "view"), ("d", "p", "view"), ("e", "p", "click")]
    images = spark.read.schema(f"_change string, {ddl}, commit string").parquet(log)
    assert sorted((r["_change"], r["event_id"]) for r in images.collect()) == [("delete", "a"), ("update_after", "b"), ("update_before", "b")]
