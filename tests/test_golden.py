"""Golden values of FIXTURES.md at sf0.01."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from lakeward.catalog import QUERIES
from lakeward.catalog.common import dedup, gold_daily, raw, silver
from lakeward.operators import journey
from lakeward.sources import fixture


@pytest.fixture(scope="module")
def sv(spark):
    return silver(spark, SF01).cache()


def test_raw_dedup_late_counts(spark):
    r = raw(spark, SF01)
    assert r.count() == 10213
    d = dedup(spark, SF01)
    assert d.count() == 10000
    assert d.where("copy = 1").count() == 213
    c = QUERIES["raw_to_silver_counts"](spark, SF01).first()
    assert (c["raw_rows"], c["dedup_rows"], c["late_rows"], c["silver_rows"]) == (10213, 10000, 200, 9800)


def test_silver_users(sv):
    assert sv.count() == 9800
    assert sv.where("user_id is not null").select("user_id").distinct().count() == 150
    assert sv.where("user_id is null").count() == 9


def test_ghost_partner_rows(spark, sv):
    assert QUERIES["ghost_rows"](spark, SF01).count() == 98


def test_uniqueness_raw(spark):
    rows = {r["table_name"]: r for r in QUERIES["quality_uniqueness"](spark, SF01).collect()}
    assert rows["raw"]["actual"] == 0.979144 and rows["raw"]["passed"] is False
    assert rows["silver"]["passed"] is True


def test_partner_day_golden(spark):
    g = gold_daily(spark, SF01)
    assert g.count() == 180
    a = g.where("partner_id = 'AUTOMOBILE' and metric_date = date'2024-01-01'").first()
    assert (a["dau"], a["total_sessions"], a["exercise_completions"], a["new_signups"]) == (22, 42, 11, 6)
    assert round(a["total_engagement_min"], 6) == 10.816667
    assert g.where("dau > total_sessions").count() == 0


def test_hourly_weekly_rows(spark):
    assert QUERIES["partner_hourly"](spark, SF01).count() == 3457
    assert QUERIES["partner_weekly"](spark, SF01).count() == 30


def test_journey_golden(spark, sv):
    u = journey.derive_stage(journey.user_day(sv, fixture.FIXTURE_VOCAB))
    assert u.count() == 4054
    stages = {r["derived_stage"]: r["count"] for r in u.groupBy("derived_stage").count().collect()}
    assert stages == {"lapsing": 2503, "engaged": 1287, "habitual": 246, "exploring": 18}
    assert QUERIES["rule_sessions"](spark, SF01).first()["violations"] == 1371


def test_erase_count_for_user_7(spark, sv):
    from lakeward.functions.expressions import pseudonym
    target = spark.range(1).select(pseudonym(F.lit("7"), fixture.SALT).alias("p")).first()["p"]
    assert sv.where(F.col("user_id") == target).count() == 80
