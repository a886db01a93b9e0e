"""The corpus operators as registered queries, with production parameters over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwane.llm import ann, bpe, jaccard, language, lines, mixing, packing, periodic, pii, quality, resampling, secrets, sql, substrings
from fleetwane.llm.text import fold

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def tokenizer_path() -> str:
    """The tokenizer's file, from the public package unless FLEETWANE_TOKENIZER names another."""
    if path := os.environ.get("FLEETWANE_TOKENIZER"):
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_quality_classifier")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


@query("op2_pii")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(_read(spark, folder, "documents"))


@query("op3_quality_rules", sql.QUALITY_RULES)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return lines.judge(_read(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_words"
    )


@query("op4_secret_scans")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(_read(spark, folder, "documents"))


@query("op5_nearest_neighbours")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(_read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op6_source_mixing", sql.SOURCE_MIXING)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_read(spark, folder, "documents"))


@query("op7_bpe")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode(docs, tokenizer_path(), with_ids=False).select("doc_id", "encoded.*")


@query("op8_substring_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(_read(spark, folder, "documents")).drop("kept_text")


@query("op9_language_id")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    learned = language.learn(docs, fold("doc_id", 5) != 0)
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return language.predict(docs.select("doc_id", "text"), learned).select("doc_id", held_out, "language.*")


@query("op10_jaccard_join", sql.JACCARD_JOIN)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(_read(spark, folder, "documents"))


@query("op11_periodic_runs", sql.PERIODIC_RUNS)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", periodic.with_periods("text", "doc_id").alias("text"))
    return periodic.find(docs).select("doc_id", *periodic.digests(F.col("periodic")))


@query("op12_importance_resampling", sql.IMPORTANCE_RESAMPLING)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    weighed = resampling.weights(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    return resampling.draw(weighed).select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_packing")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_read(spark, folder, "documents"), tokenizer_path(), with_ids=False)
