"""Type tree diff: nested paths, widening against narrowing, rename by case, rows hit."""

import copy

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward import products
from lakeward.model import load_product
from lakeward.plans import typetree

pytestmark = pytest.mark.usefixtures("spark")      # type texts are parsed by the session


def contract(version="1.0.0", **fields):
    """Fields as name=type; a type that ends in ``!`` is not nullable."""
    spec = copy.deepcopy(products.ENGAGEMENT_EVENTS)
    spec["contract"]["version"] = version
    spec["schema"] = [{"name": n, "type": t.rstrip("!"), "nullable": not t.endswith("!")} for n, t in fields.items()]
    return load_product(spec)


def changes(old, new):
    return [(c.path, c.change) for c in typetree.diff(old, new)]


@pytest.mark.parametrize("old, new, want", [
    ("int", "bigint", "type widened"), ("bigint", "int", "type narrowed"), ("float", "double", "type widened"), ("double", "float", "type narrowed"),
    ("int", "double", "type widened"), ("bigint", "double", "type narrowed"), ("double", "int", "type narrowed"), ("smallint", "float", "type widened"),
    ("decimal(10,2)", "decimal(12,2)", "type widened"), ("decimal(10,2)", "decimal(12,4)", "type widened"), ("decimal(10,2)", "decimal(11,4)", "type narrowed"),
    ("decimal(10,2)", "decimal(12,1)", "type narrowed"), ("int", "decimal(10,0)", "type widened"), ("int", "decimal(10,2)", "type narrowed"),
    ("double", "decimal(38,10)", "type narrowed"), ("decimal(10,2)", "double", "type narrowed"), ("date", "timestamp", "type widened"),
    ("timestamp", "date", "type narrowed"), ("string", "int", "type changed"), ("int", "string", "type changed"), ("boolean", "int", "type changed"),
    ("INT", "integer", None), ("map<string, int>", "map<string,int>", None)])
def test_scalar_kinds(old, new, want):
    assert changes(contract(a=old), contract(a=new)) == ([("a", want)] if want else [])


def test_nested_paths():
    old = contract(s="struct<a:int,b:struct<c:string>>", l="array<struct<x:int>>", m="map<int,array<int>>", k="map<string,string>")
    new = contract(s="struct<a:bigint,b:struct<c:int,d:int>>", l="array<struct<x:tinyint>>", m="map<bigint,array<string>>", k="struct<p:int>")
    assert changes(old, new) == [("s.a", "type widened"), ("s.b.c", "type changed"), ("s.b.d", "optional field added"), ("l[].x", "type narrowed"),
                                 ("m{key}", "type widened"), ("m{value}[]", "type changed"), ("k", "type changed")]


def test_rename_by_case_added_removed_and_nullability():
    assert changes(contract(userId="string"), contract(userid="string")) == [("userId", "renamed by case")]
    assert changes(contract(a="int", A="int"), contract(A="int")) == [("a", "field removed")]
    assert changes(contract(a="int"), contract(a="int!", b="int", c="int!")) == [
        ("a", "nullability tightened"), ("b", "optional field added"), ("c", "required field added")]
    assert changes(contract(s="struct<a:int>"), contract(s="struct<a:int not null,b:int not null>")) == [
        ("s.a", "nullability tightened"), ("s.b", "required field added")]


DDL = "s struct<a:bigint,b:string>, l array<string>, m map<string,double>, bag map<string,string>, t timestamp"


def _impact(spark, rows, old, new):
    data = spark.createDataFrame(rows, DDL).withColumn("t", F.col("t").cast("timestamp"))
    return {(r.path, r.change): r.rows_affected for r in typetree.impact(data, old, new).collect()}


def test_rows_hit(spark):
    old = contract(s="struct<a:bigint,b:string>", l="array<string>", m="map<string,double>", bag="map<string,string>", t="timestamp", gone="int")
    new = contract(s="struct<a:tinyint,b:string not null,c:int not null>", l="array<int>", m="map<string,int>", bag="struct<n:int,ok:boolean>",
                   t="date", must="int!")
    import datetime as dt
    rows = [((1, "x"), ["1", "2"], {"k": 1.0}, {"n": "5", "ok": "true"}, dt.datetime(2024, 1, 1)),
            ((300, None), ["1", "x", "y"], {"k": 1.5, "j": 2.0}, {"n": "five"}, dt.datetime(2024, 1, 1, 3)),
            ((None, None), [None], {"k": None}, {"other": "five"}, None),
            (None, None, None, None, None)]
    assert _impact(spark, rows, old, new) == {
        ("s.a", "type narrowed"): 1, ("s.b", "nullability tightened"): 2, ("s.c", "required field added"): 3, ("l[]", "type changed"): 1,
        ("m{value}", "type narrowed"): 1, ("bag", "type changed"): 1, ("t", "type narrowed"): 1, ("gone", "field removed"): None,
        ("must", "required field added"): 4}


def test_empty_data_and_no_change(spark):
    old, new = contract(s="struct<a:bigint,b:string>"), contract(s="struct<a:int>")
    assert _impact(spark, [], old, new) == {("s.a", "type narrowed"): 0, ("s.b", "field removed"): 0}
    assert _impact(spark, [], old, old) == {}


def test_one_scan_and_every_pair_of_scalars_compiles(spark, tmp_dir):
    kinds = ["tinyint", "bigint", "float", "double", "decimal(10,2)", "string", "boolean", "date", "timestamp", "binary"]
    spark.range(3).select(*[F.lit(None).cast(k).alias(f"c{i}") for i, k in enumerate(kinds)]).write.parquet(f"{tmp_dir}/t")
    data = spark.read.parquet(f"{tmp_dir}/t")
    old = contract(**{f"c{i}": k for i, k in enumerate(kinds)})
    for k in kinds:
        out = typetree.impact(data, old, contract(**{f"c{i}": k for i in range(len(kinds))}))
        assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
        assert {r.rows_affected for r in out.collect()} == {0}


@pytest.mark.parametrize("old, new, versions, want", [
    ("bigint", "int", ("1.0.0", "1.1.0"), ("major", "minor", False)), ("bigint", "int", ("1.0.0", "2.0.0"), ("major", "major", True)),
    ("int", "bigint", ("1.0.0", "1.1.0"), ("minor", "minor", True)), ("int", "bigint", ("1.0.0", "1.0.1"), ("minor", "patch", False)),
    ("int", "int", ("1.0.0", "1.0.0"), ("none", "none", True)), ("int", "int", ("2.0.0", "1.9.0"), ("none", "downgrade", False))])
def test_bump(spark, old, new, versions, want):
    a, b = contract(versions[0], x=old), contract(versions[1], x=new)
    row = typetree.bump(typetree.impact(spark.range(1).select(F.col("id").cast(T.DataType.fromDDL(old)).alias("x")), a, b), a, b).first()
    assert (row.required, row.actual, row.passed) == want
