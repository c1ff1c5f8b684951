"""The registered queries of the operators: each reads its whole table and derives the contract's columns."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm import oracles
from siftworks.llm.chat_format import format_turns, read_back, with_probe
from siftworks.llm.collocations import collocations
from siftworks.llm.common import fold, table
from siftworks.llm.decontaminate import edit_matches
from siftworks.llm.html_extract import extract_main_text
from siftworks.llm.language_id import identify
from siftworks.llm.ngram_join import ngram_jaccard_counts
from siftworks.llm.prefix_trie import prefix_trie
from siftworks.llm.quality_rules import quality_rules
from siftworks.llm.secret_scan import secret_scan
from siftworks.llm.sentencepiece_codec import encode_documents
from siftworks.llm.suffix_repeats import remove_repeats
from siftworks.llm.toxicity import toxicity
from siftworks.llm.warc import archive_round_trip

# Model file of a public tokenizer; another may be named in the environment.
TOKENIZER = os.environ.get("SIFTWORKS_TOKENIZER", "/opt/tokenizers/piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op1_chat_format": oracles.CHAT, "op4_warc": oracles.WARC, "op9_ngram_jaccard_join": oracles.NGRAM_JOIN,
                      "op11_suffix_repeats": oracles.SUFFIX_REPEATS, "op12_prefix_trie": oracles.PREFIX_TRIE,
                      "op13_collocations": oracles.COLLOCATIONS}


def query(key: str):
    def add(function):
        QUERIES[key] = function
        return function
    return add


@query("op9_ngram_jaccard_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_counts(table(spark, sf_dir, "documents"), 3, 90)


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_warc")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


@query("op6_decontaminate")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 5) == 0
    found = identify(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 3) == 1
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op3_html_extract")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


@query("op1_chat_format")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(format_turns(with_probe(table(spark, sf_dir, "conversations"))))


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op11_suffix_repeats")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query("op12_prefix_trie")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_collocations")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
