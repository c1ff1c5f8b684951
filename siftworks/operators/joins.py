"""Keyed lookups between stages of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftworks.functions import classify as cl, identity as ident, reasons as rs, text as tx, urls
from siftworks.operators.dedup import flag_duplicates, keep_last
from siftworks.operators.skew import salted_left_join
from siftworks.rules import CleanRules, UrlPatterns, fixed_values as fv
from siftworks.session import written


def classify_results(df: DataFrame, patterns: UrlPatterns, rules: CleanRules, search: tx.LongText | None = None) -> DataFrame:
    """Add url_result_type, matched_pattern and result_type; ``search``: the description, searched already."""
    typed = urls.classify_urls(df, patterns)
    if search is not None:
        short = lambda *names: [tx.field(typed, n) for n in names]
        ahead, behind = short("snippet"), short("body", "summary")
        body, titled = tx.Joined(search, ahead, behind), tx.Joined(search, [*short("title"), *ahead], behind)
        return tx.settle(typed, {"result_type": cl.result_type(typed, rules, body, titled)})
    texts = tx.settle(typed, {"_body": F.lower(cl.body_text(typed))})
    return tx.settle(texts, {"result_type": cl.result_type(texts, rules)}).drop("_body")


def mark_members(df: DataFrame, members: DataFrame, key: str, name: str) -> DataFrame:
    """Flag rows whose key occurs in a table of keys."""
    keys = members.select(key).distinct().withColumn(name, F.lit(True))
    return df.join(keys, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def not_yet_selected(df: DataFrame, selected: DataFrame, key: Column) -> DataFrame:
    """Rows whose key is not among the selected keys."""
    taken = selected.select(ident.dedup_key(selected).alias("_key"))
    return df.withColumn("_key", key).join(taken, "_key", "left_anti").drop("_key")


def attach_selection(pool: DataFrame, selected: DataFrame, min_match: int = fv.SELECTION_MIN_MATCH) -> DataFrame:
    """Selection and rejection reasons of pool rows by job_id.

    The selection is bounded by its target; whether it is broadcast is left to its measured size.
    """
    chosen = keep_last(selected.filter(tx.field(selected, "job_id") != ""), ["job_id"], "seq").select(
        "job_id", F.col("selection_reason").alias("_reason"))
    joined = pool.join(chosen, "job_id", "left")
    hit = F.col("_reason").isNotNull()
    with_reason = joined.withColumn(
        "selection_reason", tx.first_filled(tx.field(pool, "selection_reason"), tx.nz(F.col("_reason"))))
    return with_reason.withColumns({
        "selection_rejection_reason": rs.pool_selection_rejection(with_reason, hit, min_match),
        "rejection_reason": rs.pool_rejection(with_reason, hit),
    }).drop("_reason")


DEBUG_STATE = ("result_type", "url_result_type", "location_fit", "remote", "history_status", "match_score")


def url_debug_rows(raw: DataFrame, classified: DataFrame, exported: DataFrame, patterns: UrlPatterns,
                   rules: CleanRules, order: str = "seq") -> DataFrame:
    """One debug row per raw URL with its classification and fate.

    The last classified row of a URL counts; raw rows without one are classified
    here, unless they bring the columns of :func:`classify_results`.
    """
    # Written without the texts: the joins read it more than once, and would label, classify and move them each time.
    if {"url_result_type", "matched_pattern", "result_type"} <= set(raw.columns):
        raw = raw.drop(*cl.BODY_FIELDS)
    else:
        raw = written(classify_results(raw, patterns, rules).drop(*cl.BODY_FIELDS), "debug")
    base = written(flag_duplicates(raw, ident.url_key(raw), order).withColumn("_key", ident.url_key(raw)), "flagged")
    have = [n for n in DEBUG_STATE if n in classified.columns]
    last = keep_last(classified.withColumn("_key", ident.url_key(classified)), ["_key"], order).select(
        "_key", F.struct(*have).alias("_cls"))
    joined = salted_left_join(base, last, "_key", order)
    state = joined.select(
        "*", *[F.when(F.col("_cls").isNotNull(), F.col(f"_cls.{n}")).otherwise(
            joined[n] if n in joined.columns else F.lit(None)).alias(f"_s_{n}") for n in have])
    state = state.drop(*[n for n in have if n in state.columns]).withColumnsRenamed({f"_s_{n}": n for n in have})
    mailed = exported.select(ident.url_key(exported).alias("_key")).distinct().withColumn("_mailed", F.lit(True))
    state = state.join(mailed, "_key", "left")
    duplicate, final = F.col("duplicate"), rs.final_status(state, F.coalesce("_mailed", tx.no()), F.col("duplicate"))
    owner = tx.first_filled(F.trim(tx.first_filled(tx.field(state, "collector"), tx.field(state, "source"))), F.lit("unknown"))
    return state.select(
        F.col(order), owner.alias("collector"), tx.field(state, "url").alias("url"), tx.field(state, "title").alias("title"),
        rs.detected_type(state).alias("detected_type"), tx.first_filled(tx.field(state, "matched_pattern"), F.lit("none")).alias("matched_pattern"),
        rs.acceptance(final).alias("classification"), final.alias("final_status"),
        rs.debug_rejection(state, duplicate).alias("rejection_reason"))
