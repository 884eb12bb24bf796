"""The streams' ledger: replays, new checkpoints and a driver lost between two sinks change nothing; quarantined ids are masked."""

import pytest
from pyspark.sql import functions as F

from lakeward.functions.expressions import pseudonym
from lakeward.streaming import jobs, ledger

GOOD = '{"event_id": "%s", "event_timestamp": "2024-01-01T00:00:00.000000", "ingest_timestamp": "2024-01-0%dT00:01:00.000000", "user_id": "%s"}\n'


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(lines))


def test_lost_between_sinks_then_new_checkpoint(spark, tmp_path):
    land = tmp_path / "landing"
    put(land, "a", GOOD % ("e1", 1, "u1"), "no json\n")
    put(land, "b", GOOD % ("e2", 1, "u2"))
    book = ledger.Ledger(spark, f"{tmp_path}/ledger", "q")
    one, two = ledger.commit_writer(f"{tmp_path}/one"), ledger.commit_writer(f"{tmp_path}/two")

    def lost(rows, commit):
        raise OSError("lost")

    def run(sinks, ckpt):
        book.run(jobs.read_landing(spark, str(land), files=True), sinks, f"{tmp_path}/{ckpt}")

    def held():
        return [sorted(str(r[0]) for r in spark.read.parquet(f"{tmp_path}/{x}").select("event_id").collect()) for x in ("one", "two")]

    with pytest.raises(Exception, match="lost"):
        run([one, lost], "c1")
    assert book.commits() == []
    put(land, "c", GOOD % ("e3", 1, "u1"))
    run([one, two], "c2")                               # another checkpoint finishes the lost commit, then takes the new file alone
    assert held() == [["None", "e1", "e2", "e3"]] * 2 and len(book.commits()) == 2
    run([one, two], "c1")                               # the first one comes back: its batch has an entry
    run([one, two], "c3")
    put(land, "d", GOOD % ("e4", 1, "u1"))
    run([one, two], "c3")
    assert held() == [["None", "e1", "e2", "e3", "e4"]] * 2
    files = {r[ledger.FILE].rsplit("/", 1)[1]: r["rows"] for r in book.files().collect()}
    assert files == {"a.json": 2, "b.json": 1, "c.json": 1, "d.json": 1}


def test_metrics_do_not_count_a_new_checkpoint(spark, tmp_path):
    land = tmp_path / "landing"
    put(land, "a", GOOD % ("e1", 1, "u1"), GOOD % ("e2", 9, "u1"))
    root = f"{tmp_path}/metrics"
    first = jobs.observed_metrics(spark, str(land), f"{tmp_path}/c1", metrics_root=root)
    assert first == {"rows": 2, "within_sla": 1, "max_lag_s": 8 * 86400 + 60}
    assert jobs.observed_metrics(spark, str(land), f"{tmp_path}/c2", metrics_root=root) == first


def test_quarantine_holds_no_raw_id(spark, tmp_path):
    land = tmp_path / "landing"
    put(land, "a", GOOD % ("e1", 9, "user-77"), '{"event_id": "x", "user_id" : "user-77", "event_timestamp\n', "{user_id: user-77, oops}\n",
        '{"event_id": "y", "user_id": "user-77", "event_timestamp": "bad"}\n')
    hashed = spark.range(1).select(pseudonym(F.lit("user-77"), "s")).first()[0]
    for salt, shown in (("s", 3), (None, 0)):
        root = f"{tmp_path}/{salt}"
        bad = spark.read.parquet(jobs.land(spark, str(land), root, f"{root}/c1", salt)["quarantine"])
        late = spark.read.parquet(jobs.quarantine_late(spark, str(land), root, f"{root}/c2", salt=salt))
        text = [r[0] for r in bad.select(F.to_json(F.struct("*"))).union(late.select(F.to_json(F.struct("*")))).collect()]
        assert len(text) == 4 and not any("user-77" in t for t in text)
        assert sum(hashed in t for t in text) == shown + (salt is not None)
