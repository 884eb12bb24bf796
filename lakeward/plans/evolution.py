"""Contract evolution: field-level change classification between two contract
versions, the version bump they require, and the impact of a proposed
contract on the data already stored.

Contracts are turned into a registry table (one row per contract field) and
two versions are compared with a ``full_outer`` join, so the diff of every
contract in a registry runs as one job.  The impact side is one aggregated
scan of the data: rows that would break under the new contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.model import Product, parse_version
from lakeward.products import V2_BAG_FIELDS

REGISTRY_SCHEMA = ("contract string, version string, field string, type string, nullable boolean, "
                   "enum array<string>, description string")
SEVERITY = {"breaking": 3, "additive": 2, "cosmetic": 1}
BUMP = {3: "major", 2: "minor", 1: "patch", 0: "none"}


def registry(spark: SparkSession, *products: Product) -> DataFrame:
    rows = [(p.name, p.version, f.name, f.type, f.nullable,
             sorted(f.allowed_values) if f.allowed_values else None, f.description)
            for p in products for f in p.fields]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def _chg(change: str, cls: str) -> F.Column:
    return F.struct(F.lit(change).alias("change"), F.lit(cls).alias("class"))


def _norm_type(c) -> F.Column:
    return F.lower(F.regexp_replace(c, r"\s+", ""))


def classify_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per change: (contract, field, change, class).  Types are
    compared after normalising case and blanks, so ``map<string, string>``
    equals ``map<string,string>``."""
    o = old.select(*[F.col(c).alias("o_" + c) for c in old.columns])
    n = new.select(*[F.col(c).alias("n_" + c) for c in new.columns])
    j = o.join(n, (F.col("o_contract") == F.col("n_contract")) & (F.col("o_field") == F.col("n_field")), "full_outer")
    contract = F.coalesce("o_contract", "n_contract")
    field = F.coalesce("o_field", "n_field")
    both = F.col("o_field").isNotNull() & F.col("n_field").isNotNull()
    removed_vals = F.array_except(F.coalesce("o_enum", F.array().cast("array<string>")),
                                  F.coalesce("n_enum", F.array().cast("array<string>")))
    added_vals = F.array_except(F.coalesce("n_enum", F.array().cast("array<string>")),
                                F.coalesce("o_enum", F.array().cast("array<string>")))
    has_o, has_n = F.col("o_enum").isNotNull(), F.col("n_enum").isNotNull()
    desc_changed = ~F.col("o_description").eqNullSafe(F.col("n_description")) & \
        (F.col("o_description").isNotNull() | F.col("n_description").isNotNull())
    candidates = F.array(
        F.when(F.col("n_field").isNull(), _chg("field removed", "breaking")),
        F.when(F.col("o_field").isNull() & F.col("n_nullable"),
               _chg("optional field added", "additive")),
        F.when(F.col("o_field").isNull() & ~F.col("n_nullable"),
               _chg("required field added", "breaking")),
        F.when(both & (_norm_type(F.col("o_type")) != _norm_type(F.col("n_type"))),
               _chg("type changed", "breaking")),
        F.when(both & F.col("o_nullable") & ~F.col("n_nullable"),
               _chg("nullability tightened", "breaking")),
        F.when(both & ~F.col("o_nullable") & F.col("n_nullable"),
               _chg("nullability relaxed", "additive")),
        F.when(both & has_o & has_n & (F.size(removed_vals) > 0),
               _chg("allowed_values narrowed", "breaking")),
        F.when(both & has_o & has_n & (F.size(added_vals) > 0),
               _chg("allowed_values widened", "additive")),
        F.when(both & has_o & ~has_n, _chg("allowed_values removed", "additive")),
        F.when(both & ~has_o & has_n, _chg("allowed_values added", "breaking")),
        F.when(both & desc_changed, _chg("description changed", "cosmetic")),
    )
    return (j.select(contract.alias("contract"), field.alias("field"),
                     F.col("o_version").alias("old_version"), F.col("n_version").alias("new_version"),
                     F.array_join(removed_vals, ",").alias("values_removed"),
                     F.explode(F.array_compact(candidates)).alias("c"))
             .select("contract", "field", "c.change", "c.class",
                     F.when(F.col("change") == "allowed_values narrowed", F.col("values_removed"))
                      .otherwise(F.lit("")).alias("values_removed")))


def bump_check(changes: DataFrame, old_version: str, new_version: str) -> dict:
    """Required bump (worst change class) against the actual bump.  A lower
    new version is a downgrade and fails; cosmetic changes never fail."""
    worst = changes.agg(F.max(F.element_at(F.create_map(*[x for k, v in SEVERITY.items()
                                                           for x in (F.lit(k), F.lit(v))]),
                                           F.col("class")))).first()[0] or 0
    required = BUMP[worst]
    o, n = parse_version(old_version), parse_version(new_version)
    if n == o:
        actual = "none"
    elif n < o:
        actual = "downgrade"
    elif n[0] > o[0]:
        actual = "major"
    elif n[1] > o[1]:
        actual = "minor"
    else:
        actual = "patch"
    rank = {"none": 0, "patch": 1, "minor": 2, "major": 3, "downgrade": -1}
    ok = actual != "downgrade" and (required in ("none", "patch") or rank[actual] >= rank[required])
    return {"required": required, "actual": actual, "passed": ok}


def bag_map(df: DataFrame) -> DataFrame:
    """The fixture's flat properties as the v1 ``map<string,string>`` bag."""
    digits = F.col("duration_seconds").cast("bigint").cast("string")
    return df.withColumn("event_properties", F.map_from_arrays(
        F.array(F.lit("duration_seconds"), F.lit("category"), F.lit("is_first_session")),
        F.array(digits, F.col("event_type"), F.col("is_first_session"))))


def to_v2(silver_v1: DataFrame) -> DataFrame:
    """Upgrade v1 rows to the v2 shape: bag -> typed struct via try_cast,
    new optional ``clinical_intensity`` (no v1 source: NULL)."""
    from lakeward.operators.steps import upgrade_bag

    return upgrade_bag(bag_map(silver_v1), "event_properties", V2_BAG_FIELDS, {"clinical_intensity": "double"})


def upgrade_impact(df: DataFrame, old: Product, new: Product) -> DataFrame:
    """V8: rows already stored that the new contract would reject, per rule,
    in one aggregate: enum values removed, values failing the new type, NULLs
    in newly required columns."""
    aggs = []
    labels = []
    for nf in new.fields:
        of = old.field(nf.name)
        if of is None or nf.name not in df.columns:
            continue
        c = F.col(nf.name)
        if of.allowed_values and nf.allowed_values:
            gone = sorted(set(of.allowed_values) - set(nf.allowed_values))
            if gone:
                labels.append((nf.name, "allowed_values narrowed"))
                aggs.append(F.sum(c.isin(*gone).cast("bigint")))
        if of.nullable and not nf.nullable:
            labels.append((nf.name, "nullability tightened"))
            aggs.append(F.sum(c.isNull().cast("bigint")))
        new_t = T.DataType.fromDDL(nf.type)
        if _norm(of.type) != _norm(nf.type) and isinstance(new_t, T.StructType) \
                and isinstance(df.schema[nf.name].dataType, T.MapType):
            bad = F.lit(False)
            for sf_ in new_t.fields:
                v = c.getItem(sf_.name)
                bad = bad | (v.isNotNull() & v.try_cast(sf_.dataType).isNull())
            labels.append((nf.name, "type changed"))
            aggs.append(F.sum(bad.cast("bigint")))
    if not aggs:
        return df.sparkSession.createDataFrame([], "field string, change string, rows_affected bigint")
    row = df.agg(*[a.alias(f"__r{i}") for i, a in enumerate(aggs)])
    structs = [F.struct(F.lit(f).alias("field"), F.lit(ch).alias("change"),
                        F.coalesce(F.col(f"__r{i}"), F.lit(0)).cast("bigint").alias("rows_affected"))
               for i, (f, ch) in enumerate(labels)]
    return row.select(F.inline(F.array(*structs)))


def _norm(t: str) -> str:
    return "".join(t.split()).lower()
