"""Double write of two contract versions: one read, routing, parity per commit, lost drivers."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lakeward import products
from lakeward.catalog.common import raw
from lakeward.model import load_product
from lakeward.sources import fixture
from lakeward.streaming import double_write as dw
from lakeward.streaming import jobs

OLD, NEW = products.ENGAGEMENT_EVENTS_V1_BAG, products.ENGAGEMENT_EVENTS_V2


@pytest.fixture
def contracts(spark):
    return load_product(OLD), load_product(NEW)


def _sizes(spark, out):
    return {side: spark.read.parquet(out[side]).count() for side in ("old", "new", "rejected")}


def _parity(spark, out):
    return spark.read.schema(dw.PARITY_DDL).parquet(out["parity"]).collect()


def test_one_read_two_tables(spark, tmp_dir, contracts):
    rows = raw(spark, SF001)
    for half in (0, 1):
        jobs.write_landing(rows.where(F.crc32("event_id") % 2 == half), f"{tmp_dir}/landing")
    out = dw.run(spark, f"{tmp_dir}/landing", tmp_dir, f"{tmp_dir}/ckpt", *contracts, fixture.SALT, max_files=1)
    n = rows.count()
    assert out["rows_read"] == n                       # the source ran once a batch for four sinks
    sizes = _sizes(spark, out)
    bad = rows.where("event_type = 'error' or user_id is null").count()
    assert sizes == {"old": n, "new": n - bad, "rejected": bad}
    found = _parity(spark, out)
    assert len(found) > 1 and all(r.matches for r in found) and sum(r.rows_old for r in found) == n
    assert dw.reconcile(spark, tmp_dir, *contracts, ["event_id", "ingest_timestamp"]).count() == 0
    assert spark.read.parquet(out["rejected"]).where("user_id in ('1', '2', '3')").count() == 0     # pseudonyms only


def test_parity_sees_a_changed_and_a_lost_row(spark, tmp_dir, contracts, monkeypatch):
    jobs.write_landing(raw(spark, SF001).limit(300), f"{tmp_dir}/landing")
    real = dw.new_shape
    monkeypatch.setattr(dw, "new_shape", lambda rows, old, new: real(rows, old, new).withColumn(
        "session_id", F.when(F.col("event_type") == "click", "x").otherwise(F.col("session_id"))))
    out = dw.run(spark, f"{tmp_dir}/landing", tmp_dir, f"{tmp_dir}/ckpt", *contracts, fixture.SALT)
    assert not any(r.matches for r in _parity(spark, out))
    wrong = dw.reconcile(spark, tmp_dir, *contracts, ["event_id", "ingest_timestamp"])
    assert wrong.count() == spark.read.parquet(out["old"]).where("event_type = 'click'").count() > 0


def test_driver_lost_between_the_sinks_and_a_new_checkpoint(spark, tmp_dir, contracts, monkeypatch):
    rows = raw(spark, SF001).limit(500).cache()
    jobs.write_landing(rows, f"{tmp_dir}/landing")
    real = dw.commit_parity
    monkeypatch.setattr(dw, "commit_parity", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(Exception):
        dw.run(spark, f"{tmp_dir}/landing", tmp_dir, f"{tmp_dir}/ckpt", *contracts, fixture.SALT)
    monkeypatch.setattr(dw, "commit_parity", real)
    for checkpoint in ("ckpt", "ckpt", "another"):
        out = dw.run(spark, f"{tmp_dir}/landing", tmp_dir, f"{tmp_dir}/{checkpoint}", *contracts, fixture.SALT)
        sizes = _sizes(spark, out)
        assert sizes["old"] == 500 == sizes["new"] + sizes["rejected"]
        assert all(r.matches for r in _parity(spark, out))


def test_values_the_new_types_lose_are_routed(spark, contracts):
    old, new = contracts
    row = raw(spark, SF001).limit(1).withColumns({"event_type": F.lit("purchase"), "user_id": F.lit("u"), "partner_id": F.lit("p")})
    cases = {"whole": (12.0, "true"), "too long": (3e10, "true"), "odd flag": (12.0, "perhaps"), "nothing": (None, None)}
    got = {name: dw.new_shape(row.withColumns({"duration_seconds": F.lit(d).cast("double"), "is_first_session": F.lit(flag).cast("string")}), old, new).first()[dw.REASON]
           for name, (d, flag) in cases.items()}
    assert got == {"whole": None, "too long": "event_properties: value lost", "odd flag": "event_properties: value lost", "nothing": None}
