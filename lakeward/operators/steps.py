"""Transformation steps.  Each step maps a DataFrame to a ``StepResult`` of
kept rows and (optionally) rejected rows tagged with a reason, so that
``kept + rejected = input`` holds for every step and nothing vanishes."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeward.functions.expressions import is_true, pseudonym

REJECT_REASON = "__reject_reason"


@dataclass
class StepResult:
    kept: DataFrame
    rejected: DataFrame | None = None


# -- deduplicate --------------------------------------------------------------

def dedup_latest(df: DataFrame, keys: list[str], order_by: str = "ingest_timestamp",
                 tie_break: list[str] | tuple = ()) -> DataFrame:
    """Keep the latest row per key.  ``row_number() ... = 1`` is planned as a
    WindowGroupLimit, which already trims every map partition to one row per
    key before the shuffle, so a key with millions of copies ships one row
    per map task, not all copies.  ``tie_break`` makes exact ties repeatable."""
    order = [F.col(order_by).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_break]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def dedup_latest_agg(df: DataFrame, keys: list[str], order_by: str = "ingest_timestamp",
                     tie_break: list[str] | tuple = ()) -> DataFrame:
    """Same result through ``max_by`` (partial aggregation, no sort)."""
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(F.col(order_by), *[F.col(c) for c in tie_break])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("__row"))
    return agg.select(*keys, "__row.*").select(*df.columns)


# -- filter with quarantine ------------------------------------------------------

def split_by(df: DataFrame, predicate: str | Column, step: str) -> tuple[DataFrame, DataFrame]:
    """Rows where the predicate is TRUE are kept.  FALSE and NULL rows are
    rejected with reason ``step`` or ``step:null``: none is lost."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    kept = df.where(is_true(p))
    rejected = (df.where(~is_true(p))
                  .withColumn(REJECT_REASON, F.when(p.isNull(), F.lit(f"{step}:null"))
                              .otherwise(F.lit(step))))
    return kept, rejected


def filter_step(df: DataFrame, predicate: str, step: str, quarantine: bool = True) -> StepResult:
    kept, rejected = split_by(df, predicate, step)
    return StepResult(kept, rejected if quarantine else None)


# -- pseudonymize ---------------------------------------------------------------

def pseudonymize(df: DataFrame, column: str, salt: str) -> DataFrame:
    """Replace a column by its salted SHA-256, keeping its position."""
    return df.withColumn(column, pseudonym(column, salt))


# -- SQL / expression steps -------------------------------------------------------

def sql_step(spark: SparkSession, df: DataFrame, text: str, table: str | None = None,
             **frames: DataFrame) -> DataFrame:
    """Run SQL over the step input.  The text names its input ``{input}``; a
    legacy table name (``silver.engagement_events``) may be given as ``table``
    and is replaced as a whole word only."""
    if table:
        text = re.sub(rf"(?<![\w.]){re.escape(table)}(?![\w])", "{input}", text)
    return spark.sql(text, input=df, **frames)


def expr_step(df: DataFrame, column: str, expression: str) -> DataFrame:
    """Add or replace one column from a SQL expression (e.g. cohort tags)."""
    return df.withColumn(column, F.expr(expression))


# -- registered DataFrame functions ----------------------------------------------

FUNCTIONS: dict[str, Callable[..., DataFrame]] = {}


def register(name: str):
    """Allow-list a ``DataFrame -> DataFrame`` function for ``pyspark_function`` steps."""
    def deco(fn):
        FUNCTIONS[name] = fn
        return fn
    return deco


def function_step(df: DataFrame, name: str, **kwargs) -> DataFrame:
    if name not in FUNCTIONS:
        raise KeyError(f"function {name!r} is not registered")
    return df.transform(FUNCTIONS[name], **kwargs) if kwargs else df.transform(FUNCTIONS[name])


# -- contract upgrade (map bag -> struct) --------------------------------------------

def bag_to_struct(bag: str, fields: dict[str, str]) -> Column:
    """``map<string,string>`` property bag -> typed struct via ``try_cast``.
    (``from_json(to_json(map))`` would return NULL for string-encoded numbers.)"""
    return F.struct(*[F.col(bag).getItem(k).try_cast(t).alias(k) for k, t in fields.items()])


def upgrade_bag(df: DataFrame, bag: str, fields: dict[str, str],
                new_columns: dict[str, str] | None = None) -> DataFrame:
    out = df.withColumn(bag, bag_to_struct(bag, fields))
    for name, typ in (new_columns or {}).items():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(typ))
    return out


# -- join step --------------------------------------------------------------------------

def join_step(df: DataFrame, other: DataFrame, on, how: str = "inner", broadcast: bool = False) -> DataFrame:
    """Join with another product; ``broadcast`` is honoured only when the
    other side passes the size check."""
    if broadcast:
        from lakeward.operators.joins import bounded_broadcast

        other = bounded_broadcast(other)
    return df.join(other, on=on, how=how)
