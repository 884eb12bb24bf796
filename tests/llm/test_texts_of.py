"""The texts to be compared are picked where they are read: the rest of the table is not shuffled."""

from pyspark.sql import functions as F

from lakeward.llm import odd_sketch


def test_only_wanted_texts_are_shuffled(spark):
    texts = spark.range(-500, 3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    texts = texts.unionByName(texts.where("doc_id % 70 = 0"))                  # rows that come twice
    ids = spark.range(-490, 2900, 35).select(F.col("id").alias("doc_id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")               # as where the ids are too many to be broadcast
    try:
        out = odd_sketch.texts_of(texts, ids)
        got = sorted(tuple(r) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [(i, f"text {i}") for i in range(-490, 2900, 35)]
    assert "SortMergeJoin" in plan and "BroadcastHashJoin [_place" in plan and "getbit" in plan


def test_no_ids(spark):
    texts = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    assert odd_sketch.texts_of(texts, texts.select("doc_id").where("doc_id > 1")).count() == 0
