"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every
stage's result as Parquet below the shared folder and hands it to the next.  All but the
last return the columns of documents.  Near duplicates are found on five-word shingles at similarity 0.8.

The filtering stages drop by doc_id: a row with a null doc_id passes them, and a row given twice stays or goes twice.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import adaptive_rules, odd_sketch, seed_extend, simhash_windows, tier_packing
from lakeward.llm.textkit import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their group's fences (all rows of a doc_id, or none)."""
    bad = adaptive_rules.judge(docs).filter("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the smallest doc_id."""
    gone = odd_sketch.near_duplicates(docs).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated passages; texts that lose none stay as they are."""
    cut = (seed_extend.remove_repeats(docs).filter("n_removed > 0").dropDuplicates(["doc_id"])
           .select("doc_id", F.col("kept_text").alias("_kept")))
    text = F.coalesce("_kept", "text")
    return (docs.join(cut, "doc_id", "left").withColumn("n_chars", F.when(F.col("_kept").isNull(), F.col("n_chars")).otherwise(F.length("_kept")))
            .withColumn("text", text).select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    hits = simhash_windows.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.join(hits, "doc_id", "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of the documents that are left, piece by piece."""
    pieces = tier_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


STAGES = [("quality rules", quality), ("near duplicates", near_dedup), ("substring dedup", substring_dedup),
          ("decontamination", decontaminate), ("packing", packing)]

#: The near-duplicate components and the tokenizer's ids are beyond SQL; tests/llm checks the stages on planted rows and their operators against SQL or brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
