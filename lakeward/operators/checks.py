"""Schema and quality rules evaluated in one aggregated pass.

Every rule compiles to one or more aggregate expressions; all of them run in
a single ``agg`` over the candidate frame (one scan, partial aggregation on
every task) and the one-row result is unpivoted into a report table
``(rule, column, actual, threshold, passed)`` with ``inline``.  Schema facts
that need no data (missing columns, declared types) are decided from the
frame's schema on the driver, without a job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.model import Product

PSEUDONYM_PATTERN = "^[0-9a-f]{64}$"
REPORT_SCHEMA = "rule string, column string, actual double, threshold double, passed boolean"


class GateError(RuntimeError):
    """A blocking rule failed; nothing was written."""

    def __init__(self, failures: list[dict]):
        super().__init__("; ".join(f"{f['rule']}[{f['column']}]" for f in failures))
        self.failures = failures


@dataclass(frozen=True)
class Rule:
    """One check: an aggregate giving ``actual`` and a pass condition."""

    rule: str
    column: str
    actual: Column                # aggregate expression, double
    threshold: float | None
    kind: str = "min"             # min: actual >= threshold; max: actual <= threshold; eq


def completeness(column: str, threshold: float) -> Rule:
    """Q1: share of non-NULL values; fails when strictly below the threshold."""
    return Rule("completeness", column, F.avg(F.col(column).isNotNull().cast("double")), threshold)


def uniqueness(columns: list[str], threshold: float) -> Rule:
    """Q2: distinct/total over the columns; NULL is a value; empty passes."""
    distinct = F.count_distinct(F.struct(*[F.col(c) for c in columns]))
    return Rule("uniqueness", ",".join(columns),
                distinct.cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)), threshold)


def allowed_values(column: str, values: list) -> Rule:
    """Q3: rows whose non-NULL value is outside the allowed list."""
    bad = F.sum(F.when(F.col(column).isNotNull() & ~F.col(column).isin(*values), 1).otherwise(0))
    return Rule("allowed_values", column, bad.cast("double"), 0.0, "max")


def not_null(column: str) -> Rule:
    """Q3: NULL values in a column the contract declares non-nullable."""
    return Rule("not_null", column, F.sum(F.col(column).isNull().cast("int")).cast("double"), 0.0, "max")


def violation_count(name: str, violation: str | Column, expected: float = 0.0) -> Rule:
    """Q5: business rule as a boolean violation expression over the candidate."""
    v = F.expr(violation) if isinstance(violation, str) else violation
    return Rule(name, "", F.sum(F.when(v, 1).otherwise(0)).cast("double"), expected, "eq")


def pseudonym_format(column: str) -> Rule:
    """Q9: share of non-NULL values that look like a 64-hex pseudonym."""
    ok = F.when(F.col(column).isNotNull(), F.col(column).rlike(PSEUDONYM_PATTERN).cast("double"))
    return Rule("pseudonym_format", column, F.avg(ok), 1.0)


def reference_share(column: str, threshold: float, flag: str = "__ref_hit") -> Rule:
    """Q4: share of rows whose value exists in the reference table (the frame
    carries ``flag`` from ``joins.flag_reference``)."""
    return Rule("in_reference_table", column, F.avg(F.col(flag).cast("double")), threshold)


def evaluate(df: DataFrame, rules: list[Rule], static: list[dict] | None = None) -> DataFrame:
    """Run all rules in one aggregate and return the long report."""
    spark = df.sparkSession
    parts = []
    if rules:
        row = df.agg(*[r.actual.alias(f"__a{i}") for i, r in enumerate(rules)])
        structs = [F.struct(F.lit(r.rule).alias("rule"), F.lit(r.column).alias("column"),
                            F.col(f"__a{i}").cast("double").alias("actual"),
                            F.lit(r.threshold).cast("double").alias("threshold"),
                            F.lit(i).alias("i"))
                   for i, r in enumerate(rules)]
        long = row.select(F.inline(F.array(*structs)))
        kinds = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("i") + 1)
        a, t = F.col("actual"), F.col("threshold")
        ok = (F.when(t.isNull(), F.lit(True))
               .when(kinds == "min", a >= t).when(kinds == "max", a <= t).otherwise(a == t))
        # the verdict is on the exact value; rounding is for the report.  A table without
        # rows has no completeness and fails that rule; the others hold trivially.
        parts.append(long.select("rule", "column", F.round(a, 6).alias("actual"), "threshold",
                                 F.coalesce(ok, F.col("rule") != "completeness").alias("passed")))
    if static:
        parts.append(spark.createDataFrame([(s["rule"], s["column"], float(s["actual"]),
                                             float(s["threshold"]), bool(s["passed"])) for s in static],
                                           REPORT_SCHEMA))
    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- contract-driven rule sets --------------------------------------------------------

def _declared_type(ddl_type: str) -> T.DataType | None:
    try:
        return T.DataType.fromDDL(ddl_type)
    except Exception:  # noqa: BLE001 - unparsable type strings are reported elsewhere
        return None


def schema_static(df: DataFrame, product: Product, check_types: bool = True) -> list[dict]:
    """Schema facts decided from metadata: missing required columns, type drift."""
    out = []
    present = {f.name: f.dataType for f in df.schema.fields}
    for f in product.fields:
        if f.name not in present:
            if not f.nullable:
                out.append(dict(rule="missing_column", column=f.name, actual=1.0, threshold=0.0, passed=False))
            continue
        if check_types:
            want = _declared_type(f.type)
            if want is not None and want.simpleString() != present[f.name].simpleString():
                out.append(dict(rule="type_mismatch", column=f.name, actual=1.0, threshold=0.0, passed=False))
    return out


def schema_rules(df: DataFrame, product: Product, enforce_not_null: bool = True) -> list[Rule]:
    """Q3: allowed values and NULLs in non-nullable columns.  A completeness
    rule on a column overrides its NOT NULL flag (the contract allows a share
    of NULLs there)."""
    have = set(df.columns)
    tolerant = {c["column"] for c in product.quality.completeness if c.get("check") == "not_null"}
    rules = []
    for f in product.fields:
        if f.name not in have:
            continue
        if f.allowed_values:
            rules.append(allowed_values(f.name, list(f.allowed_values)))
        if enforce_not_null and not f.nullable and f.name not in tolerant:
            rules.append(not_null(f.name))
    return rules


def quality_rules(product: Product) -> list[Rule]:
    rules = []
    for c in product.quality.completeness:
        if c.get("check") == "not_null":
            rules.append(completeness(c["column"], float(c.get("threshold", 1.0))))
        elif c.get("check") == "in_reference_table":
            rules.append(reference_share(c["column"], float(c.get("threshold", 1.0)),
                                         f"__ref_{c['column']}"))
    for u in product.quality.uniqueness:
        rules.append(uniqueness(list(u["columns"]), float(u.get("threshold", 1.0))))
    for b in product.quality.business_rules:
        if "violation" in b:
            rules.append(violation_count(b["name"], b["violation"], float(b.get("expected", 0))))
    for c in product.pii_columns():
        rules.append(pseudonym_format(c))
    return rules


def blocking_failures(report_rows: list, on_failure: str, non_blocking: set | None = None) -> list[dict]:
    """Q8: which failed rules block the write.  Schema failures always block;
    quality failures block for any ``block_*`` policy, except rules whose own
    ``on_failure`` is a non-blocking action (``alert_squad``, ``warn``)."""
    failed = [r.asDict() if hasattr(r, "asDict") else dict(r) for r in report_rows if not r["passed"]]
    schema_kinds = {"missing_column", "type_mismatch", "allowed_values", "not_null"}
    blocks = on_failure.startswith("block")
    quiet = non_blocking or set()
    return [f for f in failed if f["rule"] in schema_kinds or (blocks and f["rule"] not in quiet)]


def non_blocking_rules(product: Product) -> set:
    return {b["name"] for b in product.quality.business_rules
            if b.get("on_failure") and not str(b["on_failure"]).startswith("block")}


def gate(report: DataFrame, on_failure: str, non_blocking: set | None = None) -> list[dict]:
    """Collect the (small, one row per rule) report and raise if it blocks."""
    rows = report.collect()
    blocking = blocking_failures(rows, on_failure, non_blocking)
    if blocking:
        raise GateError(blocking)
    return [r.asDict() for r in rows]


def sql_rules(df: DataFrame, business_rules: list[dict], table: str | None = None) -> list[dict]:
    """Q5, SQL form: ``SELECT COUNT(*) FROM {output} WHERE ..`` compared with
    ``expected``.  The text runs over the candidate frame (not over the table
    already written), with a legacy table name replaced as a whole word.
    Each SQL rule is its own small job; expression rules (``violation``)
    should be preferred, they share the single aggregate of ``evaluate``."""
    import re

    out = []
    for b in business_rules:
        if "sql" not in b:
            continue
        text = b["sql"]
        if table:
            text = re.sub(rf"(?<![\w.]){re.escape(table)}(?![\w])", "{output}", text)
        value = df.sparkSession.sql(text, output=df).first()[0]
        expected = float(b.get("expected", 0))
        out.append(dict(rule=b["name"], column="", actual=float(value or 0), threshold=expected,
                        passed=float(value or 0) == expected))
    return out
