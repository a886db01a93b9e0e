"""The corpus pipeline: each stage takes (spark, docs, sf_dir), is written as Parquet and read again by the next.

Language ID drops documents without a language, the n-gram Jaccard join leaves one document of
each group, secret scans replace secrets, mixing repeats or drops documents so that sources
have their weights, and BPE encodes what is left. Null texts have no language and go in the
first stage. Rows with one id and text are one document; rows of one id with different texts, and
rows without an id, are documents of their own. Extra columns, whatever their names, go through all
stages but the last; ``n_chars`` follows the redacted text where there is such a column. An
empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwane.llm import bpe, jaccard, language, mixing, secrets
from fleetwane.llm.queries import tokenizer_path
from fleetwane.llm.text import fold, unused
from fleetwane.session import scratch_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is recognised (not ``und``); a missing lang is filled in."""
    name = unused(docs, "language")
    predicted = language.predict(docs, language.learn(docs, fold("doc_id", 5) != 0), name)
    found = F.col(name)["lang_pred"]
    return predicted.filter(found != language.UNKNOWN).withColumn("lang", F.coalesce("lang", found)).select(_own(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar ones."""
    return jaccard.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced, n_chars as it is then."""
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that the sources share the words by their weights."""
    return mixing.repeated(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and digests of every document."""
    name = unused(docs, "encoded")
    return bpe.encode(docs, tokenizer_path(), result=name).select("doc_id", "lang", "source", f"{name}.*")


def _own(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [
    ("language id", identify_language),
    ("jaccard join", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("source mixing", mix_sources),
    ("bpe", encode_texts),
]

#: Profiles, redaction and BPE are not for SQL; tests/llm/test_pipeline.py holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}/{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
