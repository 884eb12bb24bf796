"""Registered queries of the training-data operators: thin digests over ``lakeward.llm``'s own outputs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.adaptive_rules import judge
from lakeward.llm.column_bwt import remove_shared_bytes
from lakeward.llm.norm_buckets import search
from lakeward.llm.odd_sketch import near_duplicates
from lakeward.llm.prefix_bpe import encode_documents
from lakeward.llm.rule_ensemble import fit, score
from lakeward.llm.seed_extend import remove_repeats
from lakeward.llm.simhash_windows import contaminated
from lakeward.llm.site_style import extract_text
from lakeward.llm.son_phrases import collocations
from lakeward.llm.tier_packing import pack_documents
from lakeward.llm.tool_calls import link_calls
from lakeward.llm.url_cascade import judge_urls

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
TOOL_SCHEMAS = [("search", "query", "string", True), ("search", "turn", "integer", True), ("search", "lang", "string", False),
                ("summarise", "text", "string", True), ("summarise", "max_words", "integer", True)]
HELD_OUT = 2                 # remainder of crc32(doc_id as text) mod 4 that no label is learnt from


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_read(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op2_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op3_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), shingle=2, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as calls (short ones search, long ones ask for a summary), assistant turns as results of the turn before."""
    rows = _read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")

    def name(back: int):
        return F.concat(F.lit("c"), F.col("conv_id"), F.lit("_"), F.col("turn") - back)

    short = F.coalesce(F.length("text"), F.lit(0)) <= 200
    calls = rows.filter("role = 'user'").select(
        "conv_id", name(0).alias("call_id"), name(2).alias("parent_id"), "turn", F.when(short, "search").otherwise("summarise").alias("name"),
        F.when(short, F.to_json(F.struct("turn", F.col("text").alias("query")))).otherwise(F.to_json(F.struct("text"))).alias("arguments"))
    results = rows.filter("role = 'assistant'").select("conv_id", name(1).alias("call_id"), "turn", F.col("text").alias("content"))
    schemas = spark.createDataFrame(TOOL_SCHEMAS, "name string, argument string, type string, required boolean")
    return link_calls(calls, results, schemas).drop("arguments", "content")      # the json holds both


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == HELD_OUT


def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "labels")
    ensemble = fit(docs, labels.filter(~held_out()).select("doc_id", F.col("quality").alias("label")))
    return score(docs.withColumn("held_out", F.coalesce(held_out(), F.lit(False))), ensemble).select("doc_id", "held_out", "score", "predicted")


def op7_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per contaminated document and benchmark item."""
    hits = contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return hits.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_windows"), F.min("start").alias("first_word"), F.max("n_words").alias("n_words"),
        F.min("hamming").cast("int").alias("hamming"), F.max("similarity").alias("similarity"))


def op8_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_shared_bytes(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op11_son_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_read(spark, sf_dir, "documents"))


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), top=50)


QUERIES = {f.__name__: f for f in (op1_url_cascade, op2_site_style, op3_adaptive_rules, op4_odd_sketch, op5_tool_calls,
                                   op6_rule_ensemble, op7_simhash_windows, op8_seed_extend, op9_column_bwt, op10_tier_packing,
                                   op11_son_phrases, op12_prefix_bpe, op13_norm_buckets)}
