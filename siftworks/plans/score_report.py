"""Weighted scoring of landed sources and the short report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siftworks.functions import classify as cl, scoring as sc, text as tx
from siftworks.operators import aggregates as ag, dedup, filters as fl, selection as sel
from siftworks.operators.projections import RuleBook


def scored_rows(df: DataFrame, book: RuleBook, order: str = "seq") -> DataFrame:
    """Dedup, quality labels, signal filter, score, threshold and priority.

    Dedup comes first because it depends on row order and saves scoring; the
    signal filter runs before the weighted score.
    """
    unique = dedup.dedup_two_stage(df, order)
    labelled = sc.add_quality(unique, book.quality)
    signalled = fl.signal_or_category(sc.add_matched(labelled, book.weighted), book.weighted)
    scored = sc.add_weighted_score(signalled, book.weighted)
    kept = fl.min_score_by_source(scored, book.weighted)
    return kept.withColumn("apply_priority", cl.apply_priority(F.col("job_score"), book.weighted.high, book.weighted.medium))


def score_report(df: DataFrame, book: RuleBook, order: str = "seq") -> DataFrame:
    """The top rows with their rank."""
    top = sel.top_report(scored_rows(df, book, order), book.weighted, order)
    return sel.rank_rows(top, [F.col("job_score").desc(), F.col(order)])


def score_funnel(df: DataFrame, book: RuleBook, order: str = "seq") -> DataFrame:
    """Rows collected, after dedup, after the signal filter and after the threshold.

    The last three are flags on one scored table, so it is read once; only the
    raw row count is a second (column-free) scan.
    """
    unique = dedup.dedup_two_stage(df, order)
    labelled = sc.add_quality(unique, book.quality)
    found = sc.add_matched(labelled, book.weighted)
    signal = (tx.field(labelled, "normalized_remote_category") != "Other") | sc.has_signal(book.weighted)
    scored = sc.add_weighted_score(tx.settle(found, {"_signal": signal}), book.weighted)
    threshold = F.coalesce(
        *[F.when(tx.field(scored, "source") == s, F.lit(n)) for s, n in book.weighted.min_score_by_source.items()],
        F.lit(book.weighted.default_min_score))
    passed = F.col("_signal") & (F.col("job_score") >= threshold)
    counts = ag.funnel(scored, {"after_deduplication": F.lit(True), "after_filtering": F.col("_signal"), "after_scoring": passed})
    collected = df.agg(F.count("*").alias("n")).scalar()
    return counts.select(collected.alias("collected"), "*")
