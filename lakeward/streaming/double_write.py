"""A migration window in which one stream feeds the old and the new version of a contract.

Each micro-batch is read and stored once (by the ledger), and everything else is a read of the stored rows: the old
contract's table takes every well-formed row; the new one takes the rows that fit it, in its own shape; the rest goes to the new
contract's quarantine with the reason.  A parity row a commit says whether the two sides agree: the old side holds exactly the rows
of the new side and its quarantine, with equal values in all columns they share and in the property bag read as the new types.

Parity compares an order-free digest (row count and sum of 64-bit row hashes, as decimals that cannot overflow) of what was *written*,
so it costs one partial aggregation a side and no join.  ``reconcile`` names the rows where it fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.expressions import is_true
from lakeward.model import Product
from lakeward.operators.steps import bag_to_struct
from lakeward.plans import evolution, parity
from lakeward.products import V2_BAG_FIELDS
from lakeward.sinks import writes
from lakeward.streaming import jobs
from lakeward.streaming.ledger import Ledger, commit_writer

REASON, BAG = "__reject_reason", "event_properties"
PARITY_DDL = "rows_old bigint, rows_new bigint, rows_rejected bigint, matches boolean, commit string"


def old_shape(rows: DataFrame, old: Product) -> DataFrame:
    """Landed rows in the old contract's columns."""
    return evolution.bag_map(rows).select(*[f.name for f in old.fields])


def misfit(new: Product) -> F.Column:
    """Why an upgraded row breaks the new contract, the first field that does (NULL: it fits)."""
    tests = [F.lit(None).cast("string")]
    for f in new.fields:
        c = F.col(f.name)
        if not f.nullable:
            tests.append(F.when(c.isNull(), F.lit(f"{f.name}: missing")))
        if f.allowed_values:
            tests.append(F.when(c.isNotNull() & ~c.isin(*f.allowed_values), F.lit(f"{f.name}: value not allowed")))
    return F.coalesce(*tests, F.lit(None))


def new_shape(rows: DataFrame, old: Product, new: Product) -> DataFrame:
    """Old rows in the new contract's columns, each with the reason it does not fit (NULL: it does)."""
    held = old_shape(rows, old).withColumn("_bag", bag_to_struct(BAG, V2_BAG_FIELDS))
    lost = F.lit(False)
    for name in V2_BAG_FIELDS:
        lost = lost | (F.col(BAG).getItem(name).isNotNull() & F.col(f"_bag.{name}").isNull())
    held = held.withColumn("_lost", is_true(lost)).withColumn(BAG, F.col("_bag"))
    added = {f.name: F.lit(None).cast(f.type) for f in new.fields if f.name not in held.columns}
    reason = F.coalesce(misfit(new), F.when(F.col("_lost"), F.lit(f"{BAG}: value lost")))
    return held.withColumns(added).withColumn(REASON, reason).select(*[f.name for f in new.fields], REASON)


def shared(old: Product, new: Product) -> list[str]:
    """Columns that both contracts have with one type."""
    return [f.name for f in old.fields if (g := new.field(f.name)) and g.type == f.type]


def _written(spark: SparkSession, path: str, ddl: str, commit: str | None = None) -> DataFrame:
    place = f"{path}/commit={commit}" if commit else path
    frame = spark.read.schema(ddl)
    return frame.parquet(place) if writes.exists(spark, place) else spark.createDataFrame([], ddl)


def _digest(df: DataFrame, columns: list[str], bag: F.Column, side: str) -> DataFrame:
    mark = F.xxhash64(*columns, bag).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias(f"rows_{side}"), F.coalesce(F.sum(mark), F.lit(0).cast("decimal(38,0)")).alias(f"digest_{side}"))


def _paths(root: str) -> dict[str, str]:
    return {"old": f"{root}/v_old", "new": f"{root}/v_new", "rejected": f"{root}/quarantine/v_new", "parity": f"{root}/parity"}


def commit_parity(spark: SparkSession, root: str, old: Product, new: Product, commit: str) -> DataFrame:
    """The parity row of a commit, from the files its sinks wrote."""
    place, cols = _paths(root), shared(old, new)
    a = _digest(_written(spark, place["old"], old.ddl(), commit), cols, bag_to_struct(BAG, V2_BAG_FIELDS), "old")
    b = _digest(_written(spark, place["new"], new.ddl(), commit), cols, F.col(BAG), "new")
    c = _digest(_written(spark, place["rejected"], new.ddl(), commit), cols, F.col(BAG), "rejected")
    one = a.join(b, F.lit(True)).join(c, F.lit(True))            # three single rows
    return one.select("rows_old", "rows_new", "rows_rejected",
                      ((F.col("rows_old") == F.col("rows_new") + F.col("rows_rejected"))
                       & (F.col("digest_old") == F.col("digest_new") + F.col("digest_rejected"))).alias("matches"))


def run(spark: SparkSession, landing: str, root: str, checkpoint: str, old: Product, new: Product, salt: str | None = None,
        max_files: int | None = None) -> dict:
    """Bring all that has landed to both contracts; returns the folders and the number of rows the stream read."""
    place = _paths(root)
    to_old, to_new = commit_writer(place["old"]), commit_writer(place["new"])
    to_rejected, to_parity = commit_writer(place["rejected"]), commit_writer(place["parity"])
    sinks = [lambda rows, commit: to_old(old_shape(rows, old), commit),
             lambda rows, commit: to_new(new_shape(rows, old, new).where(F.col(REASON).isNull()).drop(REASON), commit),
             lambda rows, commit: to_rejected(new_shape(rows, old, new).where(F.col(REASON).isNotNull()), commit),
             lambda rows, commit: to_parity(commit_parity(spark, root, old, new, commit), commit)]
    src = jobs.read_landing(spark, landing, max_files, files=True)
    rows = jobs.masked(src.where(~jobs.malformed(src)), salt)
    read = Ledger(spark, f"{root}/_ledger", "double_write").run(rows, sinks, checkpoint)
    return {**place, "rows_read": read}


def reconcile(spark: SparkSession, root: str, old: Product, new: Product, keys: list[str]) -> DataFrame:
    """The keys whose rows differ between the old side and the new side with its quarantine; ``keys`` name a delivery."""
    place, cols = _paths(root), shared(old, new)
    sides = _written(spark, place["new"], new.ddl()).unionByName(_written(spark, place["rejected"], new.ddl()))
    return parity.parity_report(_written(spark, place["old"], old.ddl()), sides, keys, [c for c in cols if c not in keys]).where(~F.col("matches"))
