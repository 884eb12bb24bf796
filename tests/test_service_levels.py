"""Freshness and volume in the gate, and the sketches behind them."""

import pytest
from pyspark.sql import functions as F

from lakeward.model import load_product
from lakeward.operators import checks, sketches
from lakeward.plans.runner import run_product


def spec(**quality):
    return load_product({"contract": {"name": "ev", "version": "1.0.0", "owner": "o"}, "source": {"type": "parquet"},
                         "schema": [{"name": "event_id", "type": "string"}, {"name": "event_timestamp", "type": "timestamp"},
                                    {"name": "ingest_timestamp", "type": "timestamp"}],
                         "storage": {"silver": {"partition_by": []}},
                         "transformations": [{"name": "d", "type": "deduplicate", "keys": ["event_id"]}], "quality": quality})


def events(spark, first, n, late=0, day="2024-01-01"):
    at = F.expr(f"timestamp'{day} 00:00:00'")
    lag = F.when(F.col("id") < first + late, 300).otherwise(120)
    return spark.range(first, first + n).select(F.col("id").cast("string").alias("event_id"), at.alias("event_timestamp"),
                                                (at + F.make_interval(secs=lag)).alias("ingest_timestamp"))


def test_rules_alert_or_block_as_declared(spark, tmp_dir):
    loud = {"freshness_sla_minutes": 2, "volume": {"expected_events_per_minute": 1, "alert_if_below_pct": 50}, "on_failure": "block"}
    res = run_product(spark, spec(**loud), events(spark, 0, 100, late=5), tmp_dir, "s", "ingest_timestamp", run_id="r1")
    got = {r["rule"]: (r["actual"], r["threshold"], r["passed"]) for r in res.report}
    assert got["freshness_p95"] == (0.95, 0.95, True)               # exactly 95 % inside: p95 is the SLA
    assert got["volume_expected"] == (round(100 / 1440, 6), 0.5, False) and "volume_baseline" not in got
    res = run_product(spark, spec(**loud), events(spark, 200, 49, late=3, day="2024-01-02"), tmp_dir, "s", "ingest_timestamp", run_id="r2")
    got = {r["rule"]: (r["actual"], r["threshold"], r["passed"]) for r in res.report}
    assert not got["freshness_p95"][2] and got["volume_baseline"] == (49.0, 50.0, False)
    run = spark.read.parquet(f"{tmp_dir}/_runs").where("run_id = 'r2'").first()
    assert run["status"] == "written" and run["failed_rules"] == []
    assert run["alerts"] == ["freshness_p95", "volume_expected", "volume_baseline"]
    for strict in ({**loud, "freshness": {"on_failure": "block"}}, {**loud, "volume": {**loud["volume"], "on_failure": "block"}}):
        with pytest.raises(checks.GateError):
            run_product(spark, spec(**strict), events(spark, 300, 10, late=9), tmp_dir, "s", "ingest_timestamp", run_id="r3")
    kept = spark.read.schema(sketches.LAG_DDL).parquet(f"{tmp_dir}/_metrics")
    assert sorted(r["run_id"] for r in kept.select("run_id").distinct().collect()) == ["r1", "r2"]      # a blocked run is no baseline
    total = sketches.lag_quantile(kept, 0.95).first()
    assert (total["rows"], total["within_sla"], total["lag_s"]) == (149, 141, 300)
    assert sketches.lag_quantile(kept.where("run_id = 'r1'"), 0.5).first()["lag_s"] == 120


def test_empty_output_and_no_declared_level(spark, tmp_dir):
    none = events(spark, 0, 0)
    res = run_product(spark, spec(freshness_sla_minutes=2, volume={"expected_events_per_minute": 1}), none, tmp_dir, "s", "ingest_timestamp")
    got = {r["rule"]: r["passed"] for r in res.report}
    assert "freshness_p95" not in got and got["volume_expected"] is False
    res = run_product(spark, spec(), events(spark, 0, 3), f"{tmp_dir}/other", "s", "ingest_timestamp")
    assert not {"freshness_p95", "volume_expected"} & {r["rule"] for r in res.report}


def test_user_sketches_fold_and_merge(spark, tmp_dir):
    day = lambda d: F.lit(f"2024-01-0{d} 10:00:00").cast("timestamp").alias("event_timestamp")
    load = lambda d, lo, hi: spark.range(lo, hi).select(F.lit("007").alias("partner_id"), F.when(F.col("id") >= 0, F.col("id").cast("string")).alias("user_id"), day(d))
    path = f"{tmp_dir}/users"
    for rows in (load(1, -3, 1000), load(1, 500, 2000), load(1, 500, 2000), load(2, 1900, 2500)):
        sketches.fold_users(spark, path, rows)
    stored = spark.read.schema(sketches.USERS_DDL).parquet(path)
    assert stored.count() == 2
    days = {str(r["period_start"]): r["users_approx"] for r in sketches.users_by(stored, F.col("metric_date")).collect()}
    assert abs(days["2024-01-01"] - 2000) < 160 and abs(days["2024-01-02"] - 600) < 49
    month = sketches.users_by(stored, F.trunc("metric_date", "month")).collect()
    assert [r["partner_id"] for r in month] == ["007"] and abs(month[0]["users_approx"] - 2500) < 200
