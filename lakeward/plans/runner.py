"""Run a data product: source -> steps -> staged write -> one-pass checks ->
gate -> swap/upsert -> quarantine append -> run-history row.

Checks run over the *staged* output (a written table: it cuts the lineage and
is read back column-pruned), so the source is computed once for the output
and once for the quarantine, never once per rule.  Row accounting: output
rows come from the same single checks aggregate, rejected rows from
``Observation`` metrics of the quarantine writes, input rows from the staged
bronze table.  (An observation placed under the range-partitioned output
write would be counted twice, since range partitioning samples its input
with a separate job.)
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.expressions import Vocabulary, pseudonym
from lakeward.model import ContractError, Product
from lakeward.operators import checks, joins, sketches, steps
from lakeward.sinks import writes

RUNS_SCHEMA = ("run_id string, contract string, version string, as_of timestamp, status string, "
               "rows_in bigint, rows_out bigint, rows_rejected bigint, step_counts map<string,bigint>, "
               "failed_rules array<string>, alerts array<string>")


@dataclass
class RunResult:
    run_id: str
    status: str
    rows_out: int
    rows_rejected: int
    step_counts: dict
    report: list = field(default_factory=list)
    outputs: dict = field(default_factory=dict)


def _as_of_sql(as_of: str) -> str:
    """A column name is used as is; anything else is a timestamp literal."""
    return as_of if as_of.replace("_", "").isalnum() and not as_of[0].isdigit() else f"timestamp'{as_of}'"


def apply_steps(spark: SparkSession, df: DataFrame, product: Product, salt: str, as_of: str,
                refs: dict | None = None) -> tuple[DataFrame, list[tuple[str, DataFrame]], dict, dict]:
    """Walk the steps; returns (kept, [(step, rejected)], observations, merge spec)."""
    rejected: list[tuple[str, DataFrame]] = []
    observations: dict[str, Observation] = {}
    merge: dict = {}
    out = df
    for st in product.steps:
        p = st.params
        if st.type == "deduplicate":
            keep = p.get("keep", {}) or {}
            tb = [c for c in p.get("tie_break", []) if c in out.columns]
            out = steps.dedup_latest(out, list(p["keys"]), keep.get("latest_by") or "ingest_timestamp", tb)
        elif st.type == "filter":
            expr = p["expr"].replace("{as_of}", _as_of_sql(as_of))
            kept, rej = steps.split_by(out, expr, st.name)
            if p.get("on_violation", "route_to_quarantine") == "route_to_quarantine":
                ob = Observation(f"{st.name}:rejected")
                rejected.append((st.name, rej.observe(ob, F.count(F.lit(1)).alias("n"))))
                observations[f"{st.name}:rejected"] = ob
            out = kept
        elif st.type == "hash":
            out = steps.pseudonymize(out, p["column"], salt)
        elif st.type == "sql":
            out = steps.sql_step(spark, out, p["sql"], table=p.get("table"))
        elif st.type == "expr":
            out = steps.expr_step(out, p["column"], p["expression"].replace("{as_of}", _as_of_sql(as_of)))
        elif st.type == "pyspark_function":
            given = {"vocab": Vocabulary(**p["vocabulary"])} if "vocabulary" in p else {}
            out = steps.function_step(out, p["function"], **given)
        elif st.type == "join":
            other = (refs or {})[p["with"]]
            if p.get("broadcast"):
                other = joins.bounded_broadcast(other)
            out = out.join(other, on=p["on"], how=p.get("how", "inner"))
        elif st.type == "upgrade":
            out = steps.upgrade_bag(out, p["column"], p["fields"], p.get("new_columns"))
        elif st.type == "merge":
            merge = {"keys": list(p.get("match_on", [])), "target": p.get("target")}
    return out, rejected, observations, merge


def _shape(df: DataFrame, product: Product, partition_by: tuple) -> DataFrame:
    if "event_date" in partition_by and "event_date" not in df.columns:
        df = df.withColumn("event_date", F.to_date("event_timestamp"))
    cols = [f.name for f in product.fields if f.name in df.columns]
    cols += [c for c in partition_by if c not in cols]
    return df.select(*cols)


def read_source(spark: SparkSession, product: Product, root: str, contracts: list[Product]) -> DataFrame:
    """The table a contract names as ``source.table``, below ``root``, with the columns and types of the
    contract that writes it (folder names alone would turn the partner 007 into a number)."""
    table = product.source.get("table") or ""
    tier, _, name = table.partition(".")
    writer = next((p for p in contracts if p.name == name and p.tier(tier).enabled), None)
    if writer is None:
        raise ContractError(f"{product.name}: no contract writes its source {table!r}")
    t = writer.tier(tier)
    own = [f.name for f in writer.fields]
    extra = [f"`{c}` {'date' if c.endswith('_date') else 'string'}" for c in t.partition_by if c not in own]
    return spark.read.format(t.format).schema(", ".join([writer.ddl(), *extra])).load(f"{root}/{tier}/{name}")


P95, BASELINE_RUNS = 0.95, 7


def _blocks(product: Product, rule: str) -> bool:
    """Volume and freshness alert, unless their block of the contract (``volume``, ``freshness``) says ``on_failure: block..``."""
    declared = product.quality.volume if rule.startswith("volume") else product.raw.get("quality", {}).get("freshness")
    return str((declared or {}).get("on_failure", "alert")).startswith("block")


def _service_levels(spark: SparkSession, product: Product, out: DataFrame, root: str, run_id: str) -> tuple[list[dict], str | None]:
    """Q6/Q7 in the gate, from one pass over two columns of the output; also the staged folder of the run's metrics, one row a day.
    ``freshness_p95``: at least 95 % of the rows inside the SLA, which is p95 <= SLA without an estimate.  ``volume_expected``:
    rows per minute over the run's days against the declared rate.  ``volume_baseline``: the run's rows a day against the
    mean of the last seven runs before it, whose metrics are kept under ``_metrics``."""
    q = product.quality
    if not (q.volume or q.freshness_sla_minutes is not None) or not {"event_timestamp", "ingest_timestamp"} <= set(out.columns):
        return [], None
    path = f"{root}/_staging/metrics/{product.name}-{run_id}"
    sketches.lag_by_day(out, q.freshness_sla_minutes).withColumn("stored_at", F.current_timestamp()).write.mode("overwrite").parquet(path)
    total = spark.read.parquet(path).agg(F.sum("rows").alias("n"), F.sum("within_sla").alias("inside"), F.count("day").alias("days")).first()
    n, found = total["n"] or 0, []

    def rule(name, actual, threshold):
        found.append(dict(rule=name, column="", actual=round(float(actual), 6), threshold=float(threshold), passed=actual >= threshold))

    if q.freshness_sla_minutes is not None and n:
        rule("freshness_p95", total["inside"] / n, P95)
    if q.volume:
        share = q.volume.get("alert_if_below_pct", 50) / 100.0
        a_day = n / max(total["days"], 1)
        if q.volume.get("expected_events_per_minute") is not None:
            rule("volume_expected", a_day / 1440.0, q.volume["expected_events_per_minute"] * share)
        kept = f"{root}/_metrics/contract={product.name}"
        if writes.exists(spark, kept):
            runs = (spark.read.parquet(kept).where(F.col("run_id").cast("string") != run_id).groupBy("run_id")
                    .agg((F.sum("rows") / F.count("day")).alias("a_day"), F.max("stored_at").alias("at")))
            before = runs.orderBy(F.desc("at"), "run_id").limit(BASELINE_RUNS).agg(F.avg("a_day")).first()[0]
            if before:
                rule("volume_baseline", a_day, before * share)
    return found, path


def run_product(spark: SparkSession, product: Product, source: DataFrame, root: str, salt: str,
                as_of: str, tier: str = "silver", refs: dict | None = None, run_id: str | None = None,
                raise_on_block: bool = True) -> RunResult:
    """Run one product into ``root/<tier>/<name>`` and append to ``root/_runs``.
    A run tried again under its ``run_id`` with the same input replaces what it left before:
    its bronze files, its quarantine partition and its row of the run history."""
    run_id = run_id or uuid.uuid4().hex[:12]
    t = product.tier(tier)
    part = tuple(t.partition_by)
    target = f"{root}/{tier}/{product.name}"
    staged = f"{root}/_staging/{product.name}/{run_id}"

    bronze = product.tier("bronze")
    if bronze.enabled:
        # K1: land this run's input once; the steps read it back (the source is
        # computed one time and the lineage is cut), then its files are moved
        # into the append-only bronze table.
        b_part = list(bronze.partition_by)
        if "ingest_date" in b_part and "ingest_date" not in source.columns:
            source = source.withColumn("ingest_date", F.to_date("ingest_timestamp"))
        b_staged = f"{root}/_staging/bronze/{product.name}/{run_id}"
        writes.write_table(source, b_staged, b_part, bronze.format)
        source = spark.read.format(bronze.format).schema(source.schema).load(b_staged)
        if "ingest_date" in source.columns and "ingest_date" not in [f.name for f in product.fields]:
            source = source.drop("ingest_date")

    kept, rejected, obs, merge = apply_steps(spark, source, product, salt, as_of, refs)
    out = _shape(kept, product, part)
    writes.write_table(out, staged, part, t.format, "overwrite", t.z_order_by)

    q_root = f"{root}/quarantine"
    for step_name, rej in rejected:
        for c in product.pii_columns():        # quarantine never keeps raw identifiers
            if c in rej.columns:
                rej = rej.withColumn(c, pseudonym(c, salt))
        writes.append_quarantine(rej, q_root, product.name, step_name, run_id, as_of)

    staged_df = spark.read.format(t.format).schema(out.schema).load(staged)
    rules = ([checks.Rule("row_count", "", F.count(F.lit(1)).cast("double"), None)]
             + checks.schema_rules(staged_df, product) + checks.quality_rules(product))
    ref_rules = [r for r in rules if r.rule == "in_reference_table"]
    frame = staged_df
    for r in ref_rules:
        spec = next(c for c in product.quality.completeness if c["column"] == r.column
                    and c.get("check") == "in_reference_table")
        ref = (refs or {}).get(spec.get("ref"))
        if ref is None:
            raise ValueError(f"{product.name}: reference table {spec.get('ref')!r} of rule on {r.column} was not passed")
        frame = joins.flag_reference(frame, ref, r.column, flag=f"__ref_{r.column}")
    static = checks.schema_static(staged_df, product, check_types=True)
    static += checks.sql_rules(staged_df, list(product.quality.business_rules))
    report = [row.asDict() for row in checks.evaluate(frame, rules, static).collect()]
    alerts, metrics = _service_levels(spark, product, staged_df, root, run_id)
    report += alerts
    blocking = checks.blocking_failures([r for r in report if r not in alerts], product.quality.on_failure,
                                        checks.non_blocking_rules(product))
    blocking += [r for r in alerts if not r["passed"] and _blocks(product, r["rule"])]

    counts = {k: int(o.get.get("n", 0)) for k, o in obs.items()}
    rows_out = int(next(r["actual"] for r in report if r["rule"] == "row_count"))
    rows_rej = sum(v for k, v in counts.items() if k.endswith(":rejected"))
    rows_in = source.count()
    counts["output"] = rows_out
    status = "blocked" if blocking else "written"
    if metrics and not blocking:
        writes.promote(spark, metrics, f"{root}/_metrics/contract={product.name}/run_id={run_id}")
    if not blocking:
        # rows of earlier runs stay: by the merge keys, else by the idempotency key of the dedup step
        dedup = next((st.params for st in product.steps if st.type == "deduplicate"), {})
        keys = merge.get("keys") or list(dedup.get("keys", []))
        if keys and writes.exists(spark, target):
            # a copy that comes in a later run wins only if the dedup step would have kept it
            order = [] if merge.get("keys") else [(dedup.get("keep") or {}).get("latest_by") or "ingest_timestamp"]
            writes.upsert(spark, target, staged_df, keys, part, fmt=t.format, cluster_by=t.z_order_by,
                          latest_by=[c for c in order if c in out.columns], fixed=dedup.get("fixed", []))
            writes.discard(spark, staged)
        else:
            writes.promote(spark, staged, target)

    if bronze.enabled:
        writes.append_by_rename(spark, b_staged, f"{root}/bronze/{product.name}", tag=f"run-{run_id}")

    failed = [f"{r['rule']}[{r['column']}]" for r in report if not r["passed"] and (r not in alerts or r in blocking)]
    raised = [r["rule"] for r in alerts if not r["passed"] and r not in blocking]
    runs = spark.createDataFrame(
        [(run_id, product.name, product.version, None, status, rows_in, rows_out, rows_rej,
          counts, failed, raised)], RUNS_SCHEMA).withColumn("as_of", F.try_to_timestamp(F.lit(as_of)))
    record = f"{root}/_staging/runs/{product.name}-{run_id}"
    runs.write.mode("overwrite").parquet(record)
    writes.append_by_rename(spark, record, f"{root}/_runs", tag=f"{product.name}-{run_id}")    # one row a run, however often it is tried
    result = RunResult(run_id, status, rows_out, rows_rej, counts, report,
                       {"target": target, "staged": staged, "quarantine": q_root, "runs": f"{root}/_runs"})
    if blocking and raise_on_block:
        raise checks.GateError(blocking)
    return result
