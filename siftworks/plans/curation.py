"""The full run: label, dedup, clean, filter, score, compare with history, select, export."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from siftworks.functions import classify as cl, identity as ident, text as tx
from siftworks.operators import aggregates as ag, dedup, filters as fl, history as hs, joins as jn, selection as sel
from siftworks.operators.projections import LOCAL, REMOTE, RuleBook, add_labels, normalize_posting, rescore
from siftworks.rules import fixed_values as fv
from siftworks.session import written


@dataclass(frozen=True)
class RunOptions:
    profile: str = LOCAL
    clean_mode: str | None = None          # None, 'soft', 'email' or 'strict'
    drop_far: bool = False
    drop_unknown: bool = False
    target: int = fv.SELECTION_TARGET
    min_match: int = fv.SELECTION_MIN_MATCH
    rotation_days: int = fv.ROTATION_DAYS
    include_seen: bool = False
    repeat: int = fv.MAX_SEEN_REPEAT
    fallback: bool = False
    top: int = fv.EXPORT_TOP


@dataclass(frozen=True)
class RunTables:
    raw: DataFrame
    pool_candidates: DataFrame
    jobs: DataFrame
    selected: DataFrame
    exported: DataFrame
    stats: DataFrame


def curated(raw: DataFrame, book: RuleBook, options: RunOptions, now: Column, order: str = "seq") -> DataFrame:
    """Labelled, deduplicated, cleaned, filtered and scored postings."""
    cleaning = options.clean_mode is not None
    jobs = dedup.dedup_postings(normalize_posting(raw, book, options.profile, with_scores=not cleaning, now=now, typed=cleaning, searched=cleaning), order)
    if cleaning:
        jobs = fl.cleaned(jobs, options.clean_mode, book.clean)
    if options.profile == REMOTE:
        jobs = fl.remote_only(jobs, book.remote)
    else:
        jobs = fl.drop_far(jobs) if options.drop_far else jobs
        jobs = fl.drop_unknown_location(jobs) if options.drop_unknown else jobs
    return rescore(jobs, book, options.profile) if cleaning else jobs


def run(raw: DataFrame, history: DataFrame | None, book: RuleBook, options: RunOptions, now: Column,
        order: str = "seq") -> RunTables:
    """All tables of a run.

    The scored and annotated postings feed selection, export and statistics, so
    they are materialised once; what follows works on that table.
    """
    scored = curated(raw, book, options, now, order)
    if history is None:
        empty = scored.sparkSession.createDataFrame(
            [], "job_id string, first_seen string, last_seen string, last_sent string, sent_count int, content_hash string")
        known = hs.annotate_history(scored, empty, now, options.rotation_days, order)
    else:
        known = hs.annotate_history(scored, history, now, options.rotation_days, order)
    candidates = written(known, "candidates")
    jobs = candidates if history is not None else candidates.filter(F.col("match_score") >= options.min_match)
    selected = written(sel.select_by_buckets(
        jobs, options.target, options.min_match, options.include_seen, options.repeat, options.fallback, order), "selected")
    marked = sel.write_back_selection(jobs, selected, options.min_match, options.include_seen)
    if options.profile == REMOTE:
        exported = marked.orderBy(*sel.status_order(marked, order)).limit(options.top)
    else:
        exported = sel.quota_top(marked, options.top, order=order)
    stats = run_stats(raw, candidates, marked, options)
    return RunTables(raw, candidates, marked, selected, exported, stats)


def run_stats(raw: DataFrame, candidates: DataFrame, marked: DataFrame, options: RunOptions) -> DataFrame:
    """One row of run counters."""
    chosen = tx.field(marked, "selection_rejection_reason") == "selected"
    counts = ag.status_counts(marked, ~chosen)
    total = raw.agg(F.count("*")).scalar()
    kept = candidates.agg(F.count("*")).scalar()
    return counts.select(
        F.lit(options.profile).alias("search_profile"), total.alias("total_candidates"),
        kept.alias("after_filters"), "*", F.lit(options.target).alias("email_target"),
        F.lit(options.min_match).alias("email_min_match"), F.lit(options.rotation_days).alias("rotation_days"))


def candidate_pool(candidates: DataFrame, selected: DataFrame, history: DataFrame, now: Column,
                   min_match: int = fv.SELECTION_MIN_MATCH) -> DataFrame:
    """Real postings with history, selection and rejection reasons."""
    real = candidates.filter(cl.is_real_posting(candidates))
    owned = hs.attach_pool_history(real, history, now).withColumn(
        "collector", tx.first_filled(tx.field(real, "collector"), tx.field(real, "source")))
    out = jn.attach_selection(owned, selected, min_match)
    return out.withColumn("action", tx.field(out, "action"))


def collector_debug(raw: DataFrame, book: RuleBook, now: Column) -> DataFrame:
    """Raw rows of collectors, normalised and classified, with a reason each."""
    from siftworks.functions.reasons import collector_debug_rejection
    typed = normalize_posting(raw, book, now=now, typed=True)
    return typed.withColumn("rejection_reason", collector_debug_rejection(typed))


def unsent_rows(scored: DataFrame, sent: DataFrame, now: Column, book: RuleBook, limit: int = fv.SENT_KEY_LIMIT,
                include_seen: bool = False, rotation_days: int = fv.ROTATION_DAYS, order: str = "seq") -> DataFrame:
    """Selection of scored rows that were not sent lately, with mail cleaning labels.

    Later rows of one key are dropped first, in input order.
    """
    from siftworks.operators.projections import mail_columns
    unique = dedup.keep_first(scored.withColumn("_key", ident.sent_key(scored)), ["_key"], [order]).drop("_key")
    known = hs.annotate_sent_keys(unique, sent, now, rotation_days, include_seen, order)
    return mail_columns(sel.rotation_top(known, limit, order), book.mail)


def report_rows(jobs: DataFrame, book: RuleBook, top: int = fv.REPORT_TOP, order: str = "seq") -> DataFrame:
    """Enriched top rows of the report in report order."""
    from siftworks.operators.projections import report_columns
    chosen = fl.selected_or_all(jobs)
    return report_columns(sel.rank_top(chosen, lambda df: sel.report_order(df, order), top, order), book.report)
