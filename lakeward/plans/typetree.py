"""V6/V8: contract types compared as trees, and what each difference costs in stored rows.

``evolution`` compares a field's type as text.  Here both types are parsed and walked together, so a change deep inside a
struct, array or map has a path of its own (``bag.tags[].name``, ``bag.sizes{key}``, ``bag.sizes{value}``), and a type that only
grew is told from one that lost values:

* ``type widened`` (additive): every old value is a value of the new type (integers upwards, float to double, integers and decimals
  into decimals with room before and after the point, date to timestamp, any up-to-32-bit integer to double);
* ``type narrowed`` (breaking): both are numbers, or both dates or times, and some values may not survive;
* ``type changed`` (breaking): anything else; another kind (a map that becomes a struct) is one change, not one a leaf;
* ``renamed by case`` (breaking: readers that match names exactly lose the field), and the types below are compared still.

``impact`` compiles each difference to a predicate (``try_cast``, and for numbers and times the way back as well) and counts
the rows it hits, all in one aggregate over the stored data.  A row counts once a path, however many of its elements fail.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.model import Product, parse_version
from lakeward.plans.evolution import BUMP, SEVERITY

IMPACT_DDL = "path string, change string, class string, old_type string, new_type string, rows_affected bigint"
CLASS = {"type widened": "additive", "type narrowed": "breaking", "type changed": "breaking", "renamed by case": "breaking",
         "field removed": "breaking", "optional field added": "additive", "required field added": "breaking",
         "nullability tightened": "breaking", "nullability relaxed": "additive"}
#: Decimal digits that hold every value of an integer type.
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
INTEGERS = list(DIGITS)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)

FIELD, ELEMENT, KEY, VALUE = "field", "element", "key", "value"


@dataclass(frozen=True)
class Change:
    """One difference: ``steps`` lead to it in the old type (in the new one for an added field)."""
    steps: tuple
    change: str
    old: T.DataType | None
    new: T.DataType | None

    @property
    def path(self) -> str:
        marks = {ELEMENT: "[]", KEY: "{key}", VALUE: "{value}"}
        text = "".join(f".{name}" if kind == FIELD else marks[kind] for kind, name in self.steps)
        return text[1:]


def scalar_change(old: T.DataType, new: T.DataType) -> str | None:
    """How one leaf type becomes another; None where they are the same."""
    if old == new:
        return None
    o, n = old.simpleString(), new.simpleString()
    if isinstance(old, TIMES) and isinstance(new, TIMES):
        return "type widened" if isinstance(old, T.DateType) else "type narrowed"
    if not (isinstance(old, T.NumericType) and isinstance(new, T.NumericType)):
        return "type changed"
    if o in DIGITS and n in DIGITS:
        fits = INTEGERS.index(o) < INTEGERS.index(n)
    elif isinstance(new, T.DecimalType):
        whole, point = (DIGITS[o], 0) if o in DIGITS else (old.precision - old.scale, old.scale) if isinstance(old, T.DecimalType) else (99, 99)
        fits = new.precision - new.scale >= whole and new.scale >= point
    else:
        fits = (o, n) == ("float", "double") or (n == "double" and o in INTEGERS[:3]) or (n == "float" and o in INTEGERS[:2])
    return "type widened" if fits else "type narrowed"


def _walk(old: T.DataType, new: T.DataType, steps: tuple) -> list[Change]:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return _fields(old, new, steps)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        inner = (*steps, (ELEMENT, None))
        return _nulls(old.containsNull, new.containsNull, inner, old, new) + _walk(old.elementType, new.elementType, inner)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        key, value = (*steps, (KEY, None)), (*steps, (VALUE, None))
        return (_walk(old.keyType, new.keyType, key) + _nulls(old.valueContainsNull, new.valueContainsNull, value, old, new)
                + _walk(old.valueType, new.valueType, value))
    change = scalar_change(old, new)
    return [Change(steps, change, old, new)] if change else []


def _nulls(old: bool, new: bool, steps: tuple, o: T.DataType, n: T.DataType) -> list[Change]:
    if old == new:
        return []
    return [Change(steps, "nullability tightened" if old else "nullability relaxed", o, n)]


def _fields(old: T.StructType, new: T.StructType, steps: tuple) -> list[Change]:
    out, left = [], {f.name: f for f in new.fields}
    pairs = [(f, left.pop(f.name, None)) for f in old.fields]      # exact names first: "a" may stand beside "A"
    for f, g in pairs:
        here = (*steps, (FIELD, f.name))
        if g is None:
            alike = [n for n in left if n.lower() == f.name.lower()]
            if len(alike) != 1:
                out.append(Change(here, "field removed", f.dataType, None))
                continue
            g = left.pop(alike[0])
            out.append(Change(here, "renamed by case", f.dataType, g.dataType))
        out += _nulls(f.nullable, g.nullable, here, f.dataType, g.dataType) + _walk(f.dataType, g.dataType, here)
    for g in left.values():
        out.append(Change((*steps, (FIELD, g.name)), "optional field added" if g.nullable else "required field added", None, g.dataType))
    return out


def _tree(product: Product) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.DataType.fromDDL(f.type), f.nullable) for f in product.fields])


def diff(old: Product, new: Product) -> list[Change]:
    """All differences between two contracts' types, in the old contract's order (fields added come last at each level)."""
    return _fields(_tree(old), _tree(new), ())


# -- impact ------------------------------------------------------------------------------

def _stored(schema: T.DataType, steps: tuple) -> T.DataType | None:
    """Type of the data at a path; None where the data has no such place."""
    for kind, name in steps:
        if kind == FIELD and isinstance(schema, T.StructType) and name in schema.names:
            schema = schema[name].dataType
        elif kind == ELEMENT and isinstance(schema, T.ArrayType):
            schema = schema.elementType
        elif kind in (KEY, VALUE) and isinstance(schema, T.MapType):
            schema = schema.keyType if kind == KEY else schema.valueType
        else:
            return None
    return schema


def _any(c: F.Column, steps: tuple, test: Callable[[F.Column], F.Column]) -> F.Column:
    """Whether ``test`` holds at some place that ``steps`` lead to below ``c``; a NULL on the way is no such place."""
    if not steps:
        return F.coalesce(test(c), F.lit(False))
    (kind, name), rest = steps[0], steps[1:]
    if kind == FIELD:
        return c.isNotNull() & _any(c.getField(name), rest, test)
    places = c if kind == ELEMENT else F.map_keys(c) if kind == KEY else F.map_values(c)
    return F.coalesce(F.exists(places, lambda x: _any(x, rest, test)), F.lit(False))


def _castable(old: T.DataType, new: T.DataType) -> bool:
    number = (T.NumericType, T.BooleanType)
    if isinstance(old, T.StringType) or isinstance(new, T.StringType):
        return isinstance(old, T.AtomicType) and isinstance(new, T.AtomicType)
    return (isinstance(old, number) and isinstance(new, number)) or (isinstance(old, TIMES) and isinstance(new, TIMES))


def _fails(c: F.Column, old: T.DataType, new: T.DataType) -> F.Column:
    """A value that the new type cannot hold."""
    if isinstance(old, T.MapType) and isinstance(old.keyType, T.StringType) and isinstance(new, T.StructType):
        bad = F.lit(False)
        for f in new.fields:
            bad = bad | _fails(F.try_element_at(c, F.lit(f.name)), old.valueType, f.dataType)
        return F.coalesce(bad, F.lit(False))
    if old == new:
        return F.lit(False)
    if not _castable(old, new):
        return c.isNotNull()
    there = c.try_cast(new)
    lost = there.isNull()
    if not isinstance(old, T.StringType) and not isinstance(new, T.StringType):
        lost = lost | F.coalesce(there.try_cast(old) != c, F.lit(True))      # a cut fraction or time of day is a loss
    return c.isNotNull() & lost


def _predicate(df: DataFrame, change: Change) -> F.Column | None:
    """Rows of the old data that a change hits; None where the data has no such place."""
    if CLASS[change.change] != "breaking":
        return F.lit(False)
    if change.change == "required field added":
        parent = change.steps[:-1]
        if not parent:
            return F.lit(True)
        return None if _stored(df.schema, parent) is None else _any(F.col(f"`{parent[0][1]}`"), parent[1:], lambda c: c.isNotNull())
    at = _stored(df.schema, change.steps)
    if at is None:
        return None
    if change.change == "nullability tightened":
        test = lambda c: c.isNull()
    elif change.change in ("field removed", "renamed by case"):
        test = lambda c: c.isNotNull()
    else:
        test = lambda c: _fails(c, at, change.new)
    return _any(F.col(f"`{change.steps[0][1]}`"), change.steps[1:], test)


def impact(df: DataFrame, old: Product, new: Product) -> DataFrame:
    """Every type difference with the stored rows it hits (``rows_affected`` NULL: the data has no such place); one aggregate."""
    changes = diff(old, new)
    if not changes:
        return df.sparkSession.createDataFrame([], IMPACT_DDL)
    tests = [_predicate(df, c) for c in changes]
    sums = [F.lit(None).cast("bigint") if t is None else F.coalesce(F.sum(t.cast("bigint")), F.lit(0).cast("bigint")) for t in tests]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[s.alias(f"_r{i}") for i, s in enumerate(sums)])
    text = lambda t: F.lit(None if t is None else t.simpleString()).cast("string")
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c.path).alias("path"), F.lit(c.change).alias("change"), F.lit(CLASS[c.change]).alias("class"),
                 text(c.old).alias("old_type"), text(c.new).alias("new_type"), F.col(f"_r{i}").alias("rows_affected"))
        for i, c in enumerate(changes)])))


def bump(impacts: DataFrame, old: Product, new: Product) -> DataFrame:
    """V7 as a job: the version step the differences call for against the step taken, with the stored rows that break; one row."""
    (a, b), names = (parse_version(p.version) for p in (old, new)), ("major", "minor", "patch")
    taken = "none" if a == b else "downgrade" if b < a else names[next(i for i in range(3) if a[i] != b[i])]
    order = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    steps = F.create_map(*[F.lit(x) for kv in BUMP.items() for x in kv])
    rank = {"none": 0, "patch": 1, "minor": 2, "major": 3, "downgrade": -1}
    worst = impacts.agg(F.coalesce(F.max(F.element_at(order, F.col("class"))), F.lit(0)).alias("worst"),
                        F.coalesce(F.max(F.when(F.col("class") == "breaking", F.col("rows_affected"))), F.lit(0).cast("bigint")).alias("rows_affected"))
    return worst.select(F.lit(old.name).alias("contract"), F.element_at(steps, F.col("worst")).alias("required"), F.lit(taken).alias("actual"),
                        (F.lit(taken != "downgrade") & ((F.col("worst") <= 1) | (F.lit(rank[taken]) >= F.col("worst")))).alias("passed"),
                        "rows_affected")
