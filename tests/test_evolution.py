"""Contract evolution: change classes, bump check, double-write parity."""

import copy

from lakeward import products
from lakeward.model import load_product
from lakeward.plans import evolution, parity


def _changes(spark, old_spec, new_spec):
    old, new = load_product(old_spec), load_product(new_spec)
    ch = evolution.classify_changes(evolution.registry(spark, old), evolution.registry(spark, new))
    return ch, {(r["field"], r["change"]): r["class"] for r in ch.collect()}


def test_v1_to_v2_is_breaking_and_major(spark):
    ch, kinds = _changes(spark, products.ENGAGEMENT_EVENTS_V1_BAG, products.ENGAGEMENT_EVENTS_V2)
    assert kinds[("event_type", "allowed_values narrowed")] == "breaking"
    assert kinds[("event_properties", "type changed")] == "breaking"
    assert kinds[("clinical_intensity", "optional field added")] == "additive"
    assert evolution.bump_check(ch, "1.2.0", "2.0.0") == {"required": "major", "actual": "major", "passed": True}
    assert evolution.bump_check(ch, "1.2.0", "1.3.0")["passed"] is False


def test_all_change_kinds(spark):
    old = copy.deepcopy(products.ENGAGEMENT_EVENTS)
    new = copy.deepcopy(products.ENGAGEMENT_EVENTS)
    new["schema"] = [f for f in new["schema"] if f["name"] != "duration_seconds"]          # removed
    new["schema"].append({"name": "req", "type": "string", "nullable": False})              # required added
    new["schema"].append({"name": "opt", "type": "string"})                                 # optional added
    for f in new["schema"]:
        if f["name"] == "session_id":
            f["nullable"] = False                                                            # tightened
        if f["name"] == "user_id":
            f["nullable"] = True                                                             # relaxed
        if f["name"] == "event_type":
            f["allowed_values"] = f["allowed_values"] + ["share"]                             # widened
        if f["name"] == "is_first_session":
            f.pop("allowed_values")                                                          # constraint removed
        if f["name"] == "partner_id":
            f["allowed_values"] = ["a"]                                                      # constraint added
        if f["name"] == "event_id":
            f["description"] = "new words"                                                   # cosmetic
        if f["name"] == "ingest_timestamp":
            f["type"] = "string"                                                             # type changed
    _, kinds = _changes(spark, old, new)
    assert kinds == {
        ("duration_seconds", "field removed"): "breaking",
        ("req", "required field added"): "breaking",
        ("opt", "optional field added"): "additive",
        ("session_id", "nullability tightened"): "breaking",
        ("user_id", "nullability relaxed"): "additive",
        ("event_type", "allowed_values widened"): "additive",
        ("is_first_session", "allowed_values removed"): "additive",
        ("partner_id", "allowed_values added"): "breaking",
        ("event_id", "description changed"): "cosmetic",
        ("ingest_timestamp", "type changed"): "breaking",
    }


def test_type_compare_ignores_blanks(spark):
    old = copy.deepcopy(products.ENGAGEMENT_EVENTS_V1_BAG)
    new = copy.deepcopy(old)
    for f in new["schema"]:
        if f["name"] == "event_properties":
            f["type"] = "map<string, string>"
    ch, kinds = _changes(spark, old, new)
    assert kinds == {}
    assert evolution.bump_check(ch, "1.2.0", "1.2.0")["passed"] is True


def test_downgrade_fails_and_cosmetic_never_fails(spark):
    old = copy.deepcopy(products.ENGAGEMENT_EVENTS)
    new = copy.deepcopy(old)
    new["schema"][0]["description"] = "changed"
    ch, _ = _changes(spark, old, new)
    assert evolution.bump_check(ch, "2.0.0", "1.9.0")["actual"] == "downgrade"
    assert evolution.bump_check(ch, "2.0.0", "1.9.0")["passed"] is False
    assert evolution.bump_check(ch, "1.0.0", "1.0.0")["passed"] is True


def test_double_write_window_parity(spark):
    """The same events through v1 and v2 give the same keyed rows."""
    from conftest import SF001
    from lakeward.catalog.common import silver

    v1 = silver(spark, SF001)
    v2 = evolution.to_v2(v1)
    rep = parity.parity_report(v1.select("event_id", "partner_id"), v2.select("event_id", "partner_id"),
                               ["event_id"], ["partner_id"])
    assert rep.where("not matches").count() == 0
    d = parity.row_delta(v1, v2).first()
    assert d["delta_pct"] == 0.0
