"""Column-expression helpers.  All of them are built-in Spark expressions, so
they stay inside whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pseudonym(c: str | Column, salt: str) -> Column:
    """Salted SHA-256 hex of a value; NULL stays NULL (``concat`` is NULL-strict)."""
    return F.sha2(F.concat(F.lit(salt), col_(c).cast("string")), 256)


def is_true(pred: str | Column) -> Column:
    """Three-valued predicate folded to two values: NULL counts as not passing."""
    p = F.expr(pred) if isinstance(pred, str) else pred
    return F.coalesce(p, F.lit(False))


def as_timestamp(c: str | Column) -> Column:
    """``timestamp_ntz`` (driver Parquet) -> ``timestamp`` in the UTC session zone."""
    return col_(c).cast("timestamp")


def epoch_seconds(c: str | Column) -> Column:
    """Whole epoch seconds, truncated (the gap arithmetic of sessionization)."""
    return F.unix_timestamp(col_(c).cast("timestamp"))


def epoch_micros(c: str | Column) -> Column:
    return F.unix_micros(col_(c).cast("timestamp"))


def array_text(c: str | Column, sep: str = ",") -> Column:
    """Arrays are reported as delimiter-joined text for engine-neutral compare."""
    return F.array_join(col_(c), sep)


def round6(c: str | Column) -> Column:
    return F.round(col_(c).cast("double"), 6)


def number_in(c: str | Column) -> Column:
    """First run of digits in a string, as double; NULL when there is none."""
    return F.regexp_extract(col_(c), "[0-9]+", 0).try_cast("double")


def minutes(seconds: str | Column) -> Column:
    return col_(seconds).cast("double") / F.lit(60.0)


@dataclass(frozen=True)
class Vocabulary:
    """Event semantics a rollup needs, as column expressions over silver.

    The reference names them ``session_end`` / ``exercise_complete`` and keeps
    duration and first-session flags in a ``map<string,string>`` property bag.
    Products over other event streams pass their own mapping.
    """

    session_end_type: str = "session_end"
    completion_type: str = "exercise_complete"
    duration_seconds: str = "try_cast(event_properties['duration_seconds'] as double)"
    first_session: str = "event_properties['is_first_session'] = 'true'"
    intensity_high: str = "event_properties['intensity'] = 'high'"
    drop_off: str = "event_properties['drop_off_signal'] = 'true'"

    def duration(self) -> Column:
        return F.expr(self.duration_seconds)

    def is_first(self) -> Column:
        return is_true(F.expr(self.first_session))

    def is_end(self) -> Column:
        return F.col("event_type") == F.lit(self.session_end_type)

    def is_completion(self) -> Column:
        return F.col("event_type") == F.lit(self.completion_type)


REFERENCE_VOCAB = Vocabulary()
