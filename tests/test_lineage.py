"""Erasure by contract: the tables are found from the contracts, nothing of a subject is left below the root
(but in the audit), rollups of any depth follow, and a request that was interrupted anywhere ends the same."""

import pytest
from pyspark.sql import functions as F

from lakeward.model import ContractError, load_product
from lakeward.operators import checks
from lakeward.plans import erasure, lineage
from lakeward.plans.runner import read_source, run_product
from lakeward.sinks import writes

AS_OF = "2024-02-01 00:00:00"


def contract(name, source, fields, steps, **storage):
    return load_product({
        "contract": {"name": name, "version": "1.0.0", "owner": "o"}, "source": source,
        "schema": [{"name": f.split()[0], "type": f.split()[1], "pii": f.endswith("pii")} for f in fields],
        "storage": storage, "transformations": steps,
        "quality": {"business_rules": [{"name": "no_bad", "violation": "v < 0", "expected": 0}] if name == "ev" else [],
                    "on_failure": "block"}})


def sql(query):
    return {"name": "q", "type": "sql", "sql": query, "table": "t"}


EVENTS = contract("ev", {"type": "parquet"},
                  ["event_id string", "event_timestamp timestamp", "ingest_timestamp timestamp", "user_id string pii", "partner string", "v int"],
                  [{"name": "d", "type": "deduplicate", "keys": ["event_id"], "keep": {"latest_by": "ingest_timestamp"}},
                   {"name": "f", "type": "filter", "expr": "v < 100", "on_violation": "route_to_quarantine"},
                   {"name": "h", "type": "hash", "column": "user_id"}],
                  bronze={"partition_by": ["ingest_date"]}, silver={"partition_by": ["event_date", "partner"]})
USERS = contract("users", {"type": "table", "table": "silver.ev"}, ["pseudonymized_user_id string", "n bigint"],
                 [sql("select user_id as pseudonymized_user_id, count(*) as n from t where user_id is not null group by 1"),
                  {"name": "m", "type": "merge", "match_on": ["pseudonymized_user_id"]}], gold={"partition_by": []})
DAILY = contract("daily", {"type": "table", "table": "silver.ev"}, ["partner string", "day date", "n bigint", "users bigint"],
                 [sql("select partner, event_date as day, count(*) as n, count(distinct user_id) as users from t group by 1, 2"),
                  {"name": "m", "type": "merge", "match_on": ["partner", "day"], "fed_by": {"day": "event_date", "partner": "partner"}}],
                 gold={"partition_by": ["day"]})
TOTAL = contract("total", {"type": "table", "table": "gold.daily"}, ["partner string", "n bigint"],
                 [sql("select partner, cast(sum(n) as bigint) as n from t group by 1"), {"name": "m", "type": "merge", "match_on": ["partner"]}],
                 gold={"partition_by": ["partner"]})
REF = contract("ref", {"type": "parquet"}, ["partner string"], [], silver={"partition_by": []})
ALL = [TOTAL, USERS, REF, DAILY, EVENTS]


def rows(n):
    """Event i of user u<i % 5> (every seventh anonymous) on one of three days and three partners, one of them 007."""
    return [(f"e{i}", f"2024-01-0{1 + i % 3} 10:00:00", f"2024-01-0{1 + i % 3} 10:01:00", None if i % 7 == 6 else f"u{i % 5}",
             "007" if i % 2 else "acme" if i % 4 else "solo", 200 if i % 11 == 10 else i) for i in range(n)]


def build(spark, root):
    def frame(data):
        df = spark.createDataFrame(data, "event_id string, a string, b string, user_id string, partner string, v int")
        return df.select("event_id", F.col("a").cast("timestamp").alias("event_timestamp"),
                         F.col("b").cast("timestamp").alias("ingest_timestamp"), "user_id", "partner", "v")

    run_product(spark, EVENTS, frame(rows(40)), root, "s", "ingest_timestamp", "silver", run_id="r1")
    with pytest.raises(checks.GateError):               # its staged output stays behind
        run_product(spark, EVENTS, frame([(*r[:5], -1) for r in rows(6)]), root, "s", "ingest_timestamp", "silver", run_id="r2")
    for p in (USERS, DAILY, TOTAL):
        run_product(spark, p, read_source(spark, p, root, ALL), root, "s", AS_OF, "gold", run_id="r1")


def traces(spark, root, values):
    """Every folder of files below ``root``, but the audit, that holds one of the values in some column or partition."""
    fs, top = writes._fs(spark, root)
    it, found, folders = fs.listFiles(top, True), [], set()
    while it.hasNext():
        p = it.next().getPath()
        if p.getName().endswith(".parquet") and "/_audit/" not in str(p):
            folders.add(str(p.getParent()))
    for f in sorted(folders):
        text = F.to_json(F.struct("*"))
        df = spark.read.parquet(f).select(text.alias("j"))
        if any(v in f for v in values) or df.where(" or ".join(f"j like '%\"{v}\"%'" for v in values)).take(1):
            found.append(f)
    return found


def state(spark, root):
    out = {}
    for p in (USERS, DAILY, TOTAL):
        on = [f.name for f in p.fields]
        kept = read_source(spark, load_product({**p.raw, "source": {"type": "table", "table": f"gold.{p.name}"}}), root, ALL)
        out[p.name] = sorted(tuple(r) for r in kept.select(*on).collect())
    return out


def test_graph_is_found_from_contracts(spark, tmp_dir):
    nodes = {n.table: n for n in lineage.graph(spark, tmp_dir, ALL)}
    assert set(nodes) == {"bronze.ev", "quarantine.ev", "silver.ev", "gold.users", "gold.daily", "gold.total"}
    assert nodes["bronze.ev"].columns == (("user_id", True),) and nodes["silver.ev"].columns == (("user_id", False),)
    assert nodes["gold.users"].columns == (("pseudonymized_user_id", False),)
    assert nodes["gold.daily"].rollup and nodes["gold.total"].rollup
    order = list(nodes)
    assert order.index("bronze.ev") < order.index("silver.ev") < order.index("gold.daily") < order.index("gold.total")
    a = contract("a", {"type": "table", "table": "gold.b"}, ["x string pii"], [], gold={"partition_by": []})
    b = contract("b", {"type": "table", "table": "gold.a"}, ["x string pii"], [], gold={"partition_by": []})
    with pytest.raises(ContractError, match="circle"):
        lineage.graph(spark, tmp_dir, [a, b])


def test_request_leaves_no_trace_wherever_it_was_interrupted(spark, tmp_dir, monkeypatch):
    root, erased = tmp_dir, ["u1", "u3"]
    build(spark, root)
    keys = erasure.subjects(spark, spark.createDataFrame([(u,) for u in [*erased, "nobody"]], "u string"), "u", "s")
    values = erased + [r[0] for r in keys.collect()]
    assert any("bronze" in f for f in traces(spark, root, values)) and any("_staging/ev" in f for f in traces(spark, root, values))

    move, calls = writes._move, []
    for stop in (2, 9):                                 # the driver is lost in the middle of the swaps, twice
        calls.clear()

        def fail(fs, src, dst, stop=stop):
            calls.append(src)
            if len(calls) == stop:
                raise OSError("lost")
            move(fs, src, dst)

        monkeypatch.setattr(writes, "_move", fail)
        with pytest.raises(OSError, match="lost"):
            lineage.erase(spark, root, ALL, keys, "s", AS_OF, "q1")
        monkeypatch.setattr(writes, "_move", move)
    audit = lineage.erase(spark, root, ALL, keys, "s", AS_OF, "q1").collect()

    assert traces(spark, root, values) == []
    kept = [r for r in rows(40) if r[3] not in erased]
    silver = read_source(spark, DAILY, root, ALL)
    assert sorted(r["event_id"] for r in silver.collect()) == sorted(r[0] for r in kept if r[5] < 100)
    assert silver.where("user_id is null").count() == sum(r[3] is None and r[5] < 100 for r in kept)
    got = state(spark, root)
    days, totals = {}, {}
    for e, ts, _, u, partner, v in kept:
        if v < 100:
            d = days.setdefault((partner, ts[:10]), [])
            d.append(u)
            totals[partner] = totals.get(partner, 0) + 1
    assert [(p, str(d), n, u) for p, d, n, u in got["daily"]] == sorted((p, d, len(x), len({u for u in x if u})) for (p, d), x in days.items())
    assert got["total"] == sorted(totals.items())
    n_silver = sum(r[3] in erased and r[5] < 100 for r in rows(40))
    sums = {}
    for r in audit:
        sums[r["table_name"]] = sums.get(r["table_name"], 0) + r["rows_erased"]
    assert sums == {"bronze.ev": sum(r[3] in erased for r in rows(40)) + sum(r[3] in erased for r in rows(6)), "silver.ev": n_silver,
                    "quarantine.ev": sum(r[3] in erased and r[5] >= 100 for r in rows(40)), "gold.users": 2,
                    "staging.ev/r2": sum(r[3] in erased for r in rows(6))}
    assert {r["request_id"] for r in audit} == {"q1"} and "nobody" not in str(audit)


def test_request_for_nobody_changes_nothing(spark, tmp_dir):
    build(spark, tmp_dir)
    before = state(spark, tmp_dir)
    keys = erasure.subjects(spark, spark.createDataFrame([("nobody",), (None,)], "u string"), "u", "s")
    assert lineage.erase(spark, tmp_dir, ALL, keys, "s", AS_OF, "q1").count() == 0
    assert state(spark, tmp_dir) == before
