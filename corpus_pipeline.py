"""The corpus pipeline: quality rules, near duplicates, benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm.common import fresh, kept_table, table
from siftworks.llm.decontaminate import decontaminate
from siftworks.llm.ngram_join import ngram_jaccard_components
from siftworks.llm.quality_rules import quality_rules
from siftworks.llm.queries import TOKENIZER
from siftworks.llm.secret_scan import redact_secrets
from siftworks.llm.sentencepiece_codec import encode_documents
from siftworks.session import scratch_path

NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules(docs, table(spark, sf_dir, "labels"), rows=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one with the smallest doc_id."""
    found = ngram_jaccard_components(docs, NEAR_WORDS, NEAR_PERCENT)
    left = docs.join(found.where("doc_id <> component_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    # Rows that repeat a doc_id are one document. There are few or none, so only they are grouped.
    twice = kept_table(found.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"), "twice")
    if twice.isEmpty():
        return left
    row = fresh(docs, "row")[0]
    once = left.join(twice, "doc_id", "left_anti").select(*docs.columns)
    again = left.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias(row))
    return once.unionByName(again.select(f"{row}.*"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return redact_secrets(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document and whether they decode to its text."""
    return encode_documents(docs, TOKENIZER, rows=True)


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks), ("secrets", secrets),
          ("token_ids", token_ids)]

# Forests, edit distances and merge ranks are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
