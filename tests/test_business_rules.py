"""Partner rollup invariants (reference vocabulary, map property bag)."""

from datetime import datetime

from pyspark.sql import functions as F

from lakeward.operators import checks, rollups

T0 = datetime(2024, 3, 1, 9, 0, 0)


def _silver(spark):
    rows = [
        ("a1", "user_001", "acme-corp", "session_start", T0, "s1", {}),
        ("a2", "user_001", "acme-corp", "session_end", T0, "s1", {"duration_seconds": "60"}),
        ("a3", "user_001", "acme-corp", "exercise_complete", T0, "s1", {}),
        ("g1", "user_002", "globex", "session_start", T0, "s2", {}),
        ("g2", "user_002", "globex", "session_end", T0, "s2", {"duration_seconds": "300"}),
        ("g3", "user_003", "globex", "session_start", T0, "s3", {"is_first_session": "true"}),
        ("g4", "user_003", "globex", "session_end", T0, "s3", {"duration_seconds": "120"}),
    ]
    return spark.createDataFrame(rows, "event_id string, user_id string, partner_id string, event_type string, "
                                       "event_timestamp timestamp, session_id string, "
                                       "event_properties map<string,string>")


def test_dau_never_exceeds_sessions(spark):
    g = rollups.partner_daily(_silver(spark))
    assert g.where("dau > total_sessions").count() == 0


def test_minutes_reasonable(spark):
    g = rollups.partner_daily(_silver(spark))
    assert g.where("total_engagement_min > dau * 24 * 60").count() == 0


def test_shape_matches_contract(spark):
    g = rollups.partner_daily(_silver(spark), as_of="2024-03-02 00:00:00")
    assert set(g.columns) == {"partner_id", "metric_date", "dau", "total_sessions", "total_engagement_min",
                              "exercise_completions", "new_signups", "top_event_types", "last_refreshed_at"}


def test_globex_golden(spark):
    g = rollups.partner_daily(_silver(spark)).where("partner_id = 'globex'").first()
    assert g["dau"] == 2 and g["total_sessions"] == 2
    assert abs(g["total_engagement_min"] - 7.0) < 1e-9
    assert g["new_signups"] == 1
    assert g["top_event_types"] == ["session_end", "session_start"]


def test_acme_golden(spark):
    g = rollups.partner_daily(_silver(spark)).where("partner_id = 'acme-corp'").first()
    assert (g["dau"], g["total_sessions"], g["exercise_completions"]) == (1, 1, 1)
    assert abs(g["total_engagement_min"] - 1.0) < 1e-9


def test_bad_duration_is_null_and_sum_is_zero(spark):
    rows = [("x", "u", "p", "session_end", T0, "s", {"duration_seconds": "abc"})]
    df = spark.createDataFrame(rows, _silver(spark).schema)
    g = rollups.partner_daily(df).first()
    assert g["total_engagement_min"] == 0.0


def test_business_rules_as_report(spark):
    g = rollups.partner_daily(_silver(spark))
    rules = [checks.violation_count("dau_cannot_exceed_total_sessions", "dau > total_sessions"),
             checks.violation_count("engagement_minutes_reasonable", "total_engagement_min > dau * 24 * 60")]
    assert all(r["passed"] for r in checks.evaluate(g, rules).collect())


def test_weekly_is_date_and_filtered_average(spark):
    w = rollups.partner_weekly(_silver(spark)).where("partner_id = 'globex'").first()
    assert str(w["week_start"]) == "2024-02-26"                 # Monday, as a date
    assert abs(w["avg_session_min"] - 3.5) < 1e-9               # (5 + 2) / 2 end events


def test_top_types_by_count_orders_by_frequency(spark):
    t = rollups.top_types_by_count(_silver(spark), 1).where("partner_id = 'globex'").first()
    assert t["event_type"] in ("session_end", "session_start") and t["events"] == 2
    assert F is not None
