"""Z-order layout and retention drops: rows kept, files pruned, hot keys, lost drivers."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lakeward import products
from lakeward.plans import retention
from lakeward.sinks import writes, zorder

DDL = "a string, b bigint, v bigint"


def _grid(spark, n=4096):
    return spark.range(n).select(F.format_string("user-%06d", F.hash("id") % 1000 + 1000).alias("a"),
                                 (F.abs(F.hash(F.col("id") + 7)) % 1000).alias("b").cast("bigint"), F.col("id").alias("v"))


def _opened(table, column, value):
    ranges = zorder.file_ranges(table, ["a", "b"])
    values = table.sparkSession.createDataFrame([(value,)], f"{column} {dict(table.dtypes)[column]}")
    return zorder.files_admitted(ranges, column, values).first()["files"], ranges.count()


def test_second_key_prunes_files_where_a_linear_sort_does_not(spark, tmp_dir):
    path, linear = f"{tmp_dir}/z", f"{tmp_dir}/linear"
    _grid(spark).write.parquet(path)
    _grid(spark).repartitionByRange(64, "a", "b").sortWithinPartitions("a", "b").write.parquet(linear)
    assert zorder.optimize(spark, path, ["a", "b"], DDL, files=64) == 4096
    table = spark.read.schema(DDL).parquet(path)
    assert sorted(r.v for r in table.select("v").collect()) == list(range(4096))
    a = table.first()["a"]
    (on_b, total), (on_a, _) = _opened(table, "b", 500), _opened(table, "a", a)
    plain_b, plain_total = _opened(spark.read.schema(DDL).parquet(linear), "b", 500)
    assert on_b <= total / 4 and on_a <= total / 4          # both columns prune
    assert plain_b > plain_total / 2                        # the second key of a linear sort does not
    plan = table.where("b = 500").select("v")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(b,500)" in plan


def test_hot_combination_nulls_and_types(spark, tmp_dir):
    """Half of the rows share both keys, some are NULL: no file holds them all, no row is lost."""
    path = f"{tmp_dir}/t"
    rows = spark.range(2000).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("a"),
                                    F.when(F.col("id") % 2 == 0, F.lit(date(2024, 1, 1))).otherwise(F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 50).cast("int"))).alias("d"),
                                    F.col("id").alias("v"))
    rows.write.parquet(path)
    zorder.optimize(spark, path, ["a", "d"], rows.schema, files=16)
    back = spark.read.schema(rows.schema).parquet(path)
    assert sorted(back.collect(), key=lambda r: r.v) == sorted(rows.collect(), key=lambda r: r.v)
    assert max(r["count"] for r in back.where("a = 'hot'").groupBy(F.input_file_name()).count().collect()) < 400


def test_only_named_partitions_are_rewritten(spark, tmp_dir):
    path, ddl = f"{tmp_dir}/t", DDL + ", day date"
    rows = _grid(spark, 600).withColumn("day", F.date_add(F.lit(date(2024, 1, 1)), (F.col("v") % 3).cast("int")))
    rows.write.partitionBy("day").parquet(path)
    before = {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    assert zorder.optimize(spark, path, ["a", "b"], ddl, ["day"], only="day = '2024-01-02'") == 200
    after = {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    assert all("2024-01-02" in f for f in before ^ after)
    assert spark.read.schema(ddl).parquet(path).count() == 600


def test_empty_table_one_column_and_odd_types(spark, tmp_dir):
    empty = spark.createDataFrame([], DDL)
    empty.write.parquet(f"{tmp_dir}/e")
    assert zorder.optimize(spark, f"{tmp_dir}/e", ["a", "b"], DDL) == 0
    assert zorder.zorder(empty, ["a", "b"]).collect() == []
    nulls = spark.createDataFrame([(None, None, 1)], DDL)
    assert zorder.zorder(nulls, ["a", "b"]).first()["v"] == 1
    with pytest.raises(ValueError):
        zorder.with_morton(empty, ["a"])
    with pytest.raises(TypeError):
        zorder.ordinal(spark.createDataFrame([], "m map<string,int>"), "m")


SILVER = "event_id string, day date, partner string"


def _days(spark, path, n=10):
    rows = [(f"{d}-{k}", date(2024, 1, 1) + timedelta(days=d), "a:b" if k else None) for d in range(n) for k in range(d + 1)]
    rows.append(("undated", None, "p"))
    spark.createDataFrame(rows, SILVER).write.partitionBy("day", "partner").parquet(path)
    return rows


def _left(spark, path):
    return sorted(r.event_id for r in spark.read.schema(SILVER).parquet(path).collect())


def test_drop_is_audited_and_exact(spark, tmp_dir):
    path, audit = f"{tmp_dir}/t", f"{tmp_dir}/audit"
    rows = _days(spark, path)
    for _ in range(2):                                      # a closed request does nothing
        got = retention.drop(spark, path, "day", 5, "2024-01-10", "r1", audit, SILVER).collect()
        assert sorted((r.value.day, r.rows, r.outcome) for r in got) == [(d + 1, d + 1, "dropped") for d in range(4)]
    assert _left(spark, path) == sorted(e for e, d, _ in rows if d is None or d >= date(2024, 1, 5))


def test_drop_survives_a_lost_driver(spark, tmp_dir, monkeypatch):
    path, audit = f"{tmp_dir}/t", f"{tmp_dir}/audit"
    rows = _days(spark, path)
    real, calls = writes._remove, []

    def lost(fs, folder):
        calls.append(folder)
        if len(calls) == 3:
            raise RuntimeError("driver lost")
        real(fs, folder)

    monkeypatch.setattr(writes, "_remove", lost)
    with pytest.raises(RuntimeError):
        retention.drop(spark, path, "day", 5, "2024-01-10", "r1", audit, SILVER)
    monkeypatch.setattr(writes, "_remove", real)
    # taken up later: the stored plan counts, not the later date
    got = retention.drop(spark, path, "day", 5, "2024-01-12", "r1", audit, SILVER).collect()
    assert sorted((r.value.day, r.rows, r.outcome) for r in got) == [(d + 1, d + 1, "dropped") for d in range(4)]
    assert _left(spark, path) == sorted(e for e, d, _ in rows if d is None or d >= date(2024, 1, 5))


def test_partition_written_again_after_the_plan_is_left(spark, tmp_dir, monkeypatch):
    path, audit = f"{tmp_dir}/t", f"{tmp_dir}/audit"
    _days(spark, path)
    real = retention._plan

    def plan_then_write(*args):
        real(*args)
        spark.createDataFrame([("late", date(2024, 1, 2), "p")], SILVER).write.mode("append").partitionBy("day", "partner").parquet(path)

    monkeypatch.setattr(retention, "_plan", plan_then_write)
    got = {r.value.day: r.outcome for r in retention.drop(spark, path, "day", 5, "2024-01-10", "r1", audit, SILVER).collect()}
    assert got == {1: "dropped", 2: "changed", 3: "dropped", 4: "dropped"}
    assert "late" in _left(spark, path)


def test_catalogue_reads_no_data_and_contract_declares_days(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    _days(spark, path)
    cat = retention.catalogue(spark, path, "day")
    assert "FileScan" not in cat._jdf.queryExecution().executedPlan().toString()
    assert cat.where("value is null").count() == 1 and cat.count() == 11
    assert retention.catalogue(spark, f"{tmp_dir}/none", "day").count() == 0
    gold = products.product("partner_dashboard")
    ddl = "partner_id string, metric_date date"
    spark.createDataFrame([("p", date(2000, 1, 1)), ("p", date(2024, 1, 1))], ddl).write.partitionBy("metric_date").parquet(f"{tmp_dir}/g")
    done = retention.enforce(spark, gold, "gold", f"{tmp_dir}/g", "2024-02-01", "r", f"{tmp_dir}/audit", ddl)
    assert [r.value for r in done.collect()] == [date(2000, 1, 1)]
    with pytest.raises(ValueError):
        retention.drop(spark, path, "day", 5, "2024-01-10", "../r1", f"{tmp_dir}/audit", SILVER)
