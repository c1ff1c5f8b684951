"""Counts and statistics.  All are plain grouped aggregates with map-side partials."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siftworks.functions import classify as cl, reasons as rs, text as tx, urls
from siftworks.functions.scoring import match_score  # noqa: F401  (re-exported for plans)
from siftworks.rules import ReportRules, fixed_values as fv


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, tx.no()))


def owner(df: DataFrame, lower: bool = True) -> Column:
    """Collector, else source, else 'unknown'."""
    name = tx.first_filled(tx.field(df, "collector"), tx.field(df, "source"), F.lit("unknown"))
    return F.lower(name) if lower else tx.first_filled(F.trim(name), F.lit("unknown"))


def source_counts(df: DataFrame, by: str = "source") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"))


def priority_counts(df: DataFrame, by: str = "apply_priority") -> DataFrame:
    """Rows per level, absent levels as 0."""
    counts = df.agg(*[count_if(F.col(by) == level).alias(level) for level in fv.PRIORITY_LEVELS])
    pairs = ", ".join(f"'{level}', {level}" for level in fv.PRIORITY_LEVELS)
    return counts.select(F.expr(f"stack({len(fv.PRIORITY_LEVELS)}, {pairs}) as (apply_priority, n)"))


def score_stats(df: DataFrame, score: str = "job_score") -> DataFrame:
    zero = lambda value: F.coalesce(value, F.lit(0))
    return df.agg(
        zero(F.min(score)).alias("min"), zero(F.max(score)).alias("max"),
        F.coalesce(F.bround(F.avg(score), 2), F.lit(0.0)).alias("average"))


def funnel(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """One pass over flagged rows: how many rows reach each stage."""
    return df.agg(*[count_if(test).alias(name) for name, test in stages.items()])


def clean_summary(df: DataFrame, kept: Column) -> DataFrame:
    """Rows before and after cleaning and removed rows per result type."""
    removed = [t for t in fv.RESULT_TYPES if t != "job"]
    kind = tx.field(df, "result_type")
    return df.agg(
        F.count("*").alias("total_before"), count_if(kept).alias("total_after"),
        *[count_if(~kept & (kind == name)).alias(f"removed_{name}") for name in removed])


def selection_debug(df: DataFrame, selected: Column, min_match: int = fv.SELECTION_MIN_MATCH,
                    include_seen: bool = False) -> DataFrame:
    """Eligible rows per bucket (overlapping) and exclusive rejection counts.

    ``selected`` tells whether the row's key was selected.  The rejection counts
    and the rows of selected keys add up to the pool.
    """
    ok, buckets = rs.selectable(df, min_match), rs.selection_buckets(df)
    reason = rs.selection_rejection(df, selected, min_match, include_seen)
    rotation = count_if(ok & buckets["FALLBACK_ROTATION"] & ~selected)
    rejected = lambda name: count_if(reason == name)
    return df.agg(
        F.count("*").alias("candidate_pool_total"),
        F.count("*").alias("candidates_total"),
        count_if(ok & buckets["NEW"]).alias("eligible_new"),
        count_if(ok & buckets["UPDATED"]).alias("eligible_updated"),
        count_if(ok & buckets["NEVER_SENT_FILL"]).alias("eligible_never_sent_fill"),
        count_if(ok & rs.never_sent(df)).alias("eligible_never_sent"),
        count_if(ok & buckets["RESURFACED"]).alias("eligible_resurfaced"),
        rotation.alias("eligible_fallback"),
        rotation.alias("eligible_fallback_rotation"),
        rejected("low_match").alias("rejected_low_match"),
        rejected("profile_rejected").alias("rejected_profile"),
        rejected("location_rejected").alias("rejected_location"),
        rejected("seen_recently").alias("rejected_seen_recently"),
        rejected("seen_recently").alias("rejected_seen"),
        rejected("no_selection_bucket").alias("rejected_no_selection_bucket"),
        rejected("not_selected_due_to_limit").alias("rejected_not_selected_due_to_limit"),
        rejected("selected").alias("rows_of_selected_keys"),
    )


def status_counts(df: DataFrame, unselected: Column | None = None) -> DataFrame:
    state = tx.field(df, "history_status")
    counts = [count_if(state == s).alias(f"{s.lower()}_jobs") for s in rs.STATUSES]
    if unselected is not None:
        counts.append(count_if((state == "SEEN") & unselected).alias("seen_skipped"))
    return df.agg(*counts)


# --- collectors -------------------------------------------------------------------

def share_text(part: Column, whole: Column) -> Column:
    """Percentage with one decimal and a percent sign; '0%' without a base."""
    value = F.bround(part / F.nullif(whole, F.lit(0)) * 100, 1)
    return F.coalesce(F.concat(value.cast("string"), F.lit("%")), F.lit("0%"))


def collector_stats(collected: DataFrame, candidates: DataFrame, selected: DataFrame) -> DataFrame:
    """Statistics per collector.

    ``collected`` holds (collector, collected); location, status and country are
    counted for real postings, page types for the others.
    """
    df = candidates
    real, kind, fit = cl.is_real_posting(df), tx.field(df, "result_type"), tx.field(df, "location_fit")
    remote, state = tx.flag(df, "remote"), tx.field(df, "history_status")
    country, negative = tx.field(df, "country_restriction"), F.lower(tx.field(df, "negative_reason"))
    is_remote = (fit == "remote") | (remote & (fit != "allowed_local"))
    pages = {"search_page": "search_pages", "category_page": "category_pages", "career_page": "career_pages",
             "company_page": "company_pages", "article": "articles", "excluded_domain": "excluded_domains"}
    counts = {
        "after_cleaner": real, "real_jobs": real, "accepted_urls": real, "rejected_urls": ~real,
        "unknown_urls": ~real & ((kind == "unknown") | (tx.field(df, "url_result_type") == "unknown")),
        "allowed_local": real & (fit == "allowed_local"),
        "remote": real & is_remote,
        "excluded_far": real & ~is_remote & (fit == "excluded_far"),
        "unknown_location": real & ~is_remote & (fit == "unknown"),
        **{name: ~real & (kind == value) for value, name in pages.items()},
        "history_seen": real & (state == "SEEN"), "history_updated": real & (state == "UPDATED"),
        "history_new": real & (state == "NEW"), "history_seen_status": real & (state == "SEEN"),
        "history_resurfaced": real & (state == "RESURFACED"),
        "country_restricted": real & (country != ""), "worldwide_jobs": real & (country == "Worldwide"),
        "eu_jobs": real & country.isin("EU", "Europe", "EMEA", "Italy"),
        "rejected_by_country": real & F.contains(negative, F.lit("country")),
        "rejected_by_seniority": real & tx.has_any(negative, ("seniority", "excluded title")),
        "rejected_by_profile": real & (rs.score_of(df, "match_score") < fv.POOL_MATCH_THRESHOLD),
    }
    per_collector = df.groupBy(owner(df).alias("collector")).agg(*[count_if(t).alias(n) for n, t in counts.items()])
    mailed = selected.groupBy(owner(selected).alias("collector")).agg(F.count("*").alias("email_jobs"))
    joined = collected.join(per_collector, "collector", "full_outer").join(mailed, "collector", "full_outer")
    numbers = ["collected", *counts, "email_jobs"]
    filled = joined.select("collector", *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in numbers])
    urls_total = F.col("accepted_urls") + F.col("rejected_urls")
    out = filled.withColumns({
        "pattern_coverage": share_text(F.col("accepted_urls"), urls_total),
        "real_job_ratio": share_text(F.col("real_jobs"), urls_total),
    })
    return out.select(*COLLECTOR_FIELDS)


COLLECTOR_FIELDS = (
    "collector", "collected", "after_cleaner", "real_jobs", "pattern_coverage", "unknown_urls", "accepted_urls",
    "rejected_urls", "real_job_ratio", "allowed_local", "remote", "excluded_far", "unknown_location",
    "search_pages", "category_pages", "career_pages", "company_pages", "articles", "excluded_domains",
    "history_seen", "history_updated", "history_new", "history_seen_status", "history_resurfaced",
    "country_restricted", "worldwide_jobs", "eu_jobs", "rejected_by_country", "rejected_by_seniority",
    "rejected_by_profile", "email_jobs",
)


def pool_rotation_counts(pool: DataFrame) -> DataFrame:
    eligible = tx.flag(pool, "rotation_eligible")
    return pool.groupBy(owner(pool).alias("collector")).agg(
        F.count("*").alias("candidate_pool"),
        count_if(eligible).alias("rotation_eligible"),
        count_if(tx.field(pool, "selection_rejection_reason") == "seen_recently").alias("seen_recently"),
        count_if(tx.field(pool, "selection_reason") == "FALLBACK_ROTATION").alias("fallback_rotation"),
    )


HEALTH_FIELDS = {
    "raw_collected": "collected", "after_cleaner": "after_cleaner", "real_jobs": "real_jobs",
    "candidate_pool": "candidate_pool", "new": "history_new", "updated": "history_updated", "seen": "history_seen",
    "resurfaced": "history_resurfaced", "rotation_eligible": "rotation_eligible", "seen_recently": "seen_recently",
    "fallback_rotation": "fallback_rotation", "email": "email_jobs", "removed_by_history": "history_seen",
    "country_restrictions": "country_restricted", "worldwide_jobs": "worldwide_jobs", "eu_jobs": "eu_jobs",
    "rejected_by_country": "rejected_by_country", "rejected_by_seniority": "rejected_by_seniority",
    "rejected_by_profile": "rejected_by_profile",
}


def collector_health(stats: DataFrame, pool: DataFrame) -> DataFrame:
    """Status, score and advice per collector from its statistics and its pool rows."""
    joined = stats.join(pool_rotation_counts(pool), "collector", "left")
    joined = joined.fillna(0, ["candidate_pool", "rotation_eligible", "seen_recently", "fallback_rotation"])
    state = rs.health_status(joined)
    return joined.select(
        "collector",
        *[rs.score_of(joined, source).alias(name) for name, source in HEALTH_FIELDS.items()],
        rs.removed_by_cleaner(joined).alias("removed_by_cleaner"),
        rs.removed_by_location(joined).alias("removed_by_location"),
        state.alias("collector_health_status"),
        rs.health_score(joined, state).alias("collector_health_score"),
        rs.health_advice(joined, state).alias("recommendation"),
    )


def contribution(stats: DataFrame, health: DataFrame) -> DataFrame:
    """Short line per collector; the first non-zero of alternative fields wins."""
    right = health.select(
        F.lower("collector").alias("_key"),
        F.col("collector_health_status").alias("_status"), F.col("candidate_pool").alias("_pool"))
    joined = stats.withColumn("_key", F.lower("collector")).join(right, "_key", "left")
    some = lambda *values: F.coalesce(*[F.nullif(v, F.lit(0)) for v in values], F.lit(0))
    number = lambda name: rs.score_of(joined, name)
    return joined.select(
        "collector",
        some(number("collected"), number("raw_collected")).alias("collected"),
        number("real_jobs").alias("real_jobs"),
        some(number("candidate_pool"), tx.to_int(F.col("_pool"))).alias("candidate_pool"),
        some(number("email_jobs"), number("email")).alias("email_jobs"),
        tx.first_filled(tx.nz(F.col("_status")), tx.field(joined, "collector_health_status"), F.lit("unknown")).alias("reason"),
    )


def stats_rollup(stats: DataFrame) -> DataFrame:
    total = lambda name: F.coalesce(F.sum(rs.score_of(stats, name)), F.lit(0))
    return stats.agg(
        total("history_seen").alias("seen_jobs"), total("allowed_local").alias("allowed_local"),
        total("remote").alias("remote"), total("unknown_location").alias("unknown"),
        total("excluded_far").alias("excluded_far"))


def next_resurfacing(health: DataFrame, rotation_days: int) -> DataFrame:
    """Collectors whose seen rows come back after the rotation period."""
    seen = F.coalesce(F.nullif(rs.score_of(health, "seen"), F.lit(0)), rs.score_of(health, "removed_by_history"))
    return health.filter((seen > 0) & F.lit(rotation_days > 0)).select("collector", F.lit(rotation_days).alias("rotation_days"))


# --- URL debug statistics -------------------------------------------------------------

def pattern_usage(rows: DataFrame) -> DataFrame:
    return rows.groupBy(tx.first_filled(tx.field(rows, "matched_pattern"), F.lit("none")).alias("pattern")).agg(
        F.count("*").alias("n"))


def is_unknown_url(rows: DataFrame) -> Column:
    return (tx.field(rows, "detected_type") == "unknown") | (tx.field(rows, "rejection_reason") == "unknown_pattern")


def path_counts(rows: DataFrame, order: str = "seq") -> DataFrame:
    """Path prefixes of unknown URLs per collector, with their first appearance."""
    unknown = rows.filter(is_unknown_url(rows))
    exploded = unknown.select(
        tx.first_filled(tx.field(unknown, "collector"), F.lit("unknown")).alias("collector"), F.col(order),
        F.posexplode(urls.path_prefixes(tx.field(unknown, "url"))).alias("pos", "prefix"))
    first = F.min(F.struct(F.col(order).alias("s"), F.col("pos").alias("p")))
    return exploded.groupBy("collector", "prefix").agg(F.count("*").alias("n"), first.alias("f")).select(
        "collector", "prefix", "n", F.col("f.s").alias("first_seq"), F.col("f.p").alias("first_pos"))


def unknown_share(rows: DataFrame) -> DataFrame:
    name = tx.first_filled(tx.field(rows, "collector"), F.lit("unknown"))
    return rows.groupBy(name.alias("collector")).agg(
        F.count("*").alias("urls"), count_if(is_unknown_url(rows)).alias("unknown"))


# --- report -------------------------------------------------------------------------------

def selection_summary(df: DataFrame, rules: ReportRules) -> DataFrame:
    return df.agg(
        F.coalesce(F.max(rs.score_of(df, "match_score")), F.lit(0)).alias("top_match_score"),
        count_if(rs.recommendation_level(df, rules) == "apply_today").alias("recommended"))


def best_row(df: DataFrame, rules: ReportRules, order: str = "seq") -> DataFrame:
    """First reason of the row with the highest match score (first on ties)."""
    match = rs.score_of(df, "match_score")
    reason = F.coalesce(F.try_element_at(rs.fit_reasons(df, rules), F.lit(1)), F.lit(fv.BEST_MATCH_REASON))
    best = F.max_by(F.struct(F.col(order), F.col("title"), reason.alias("reason")), F.struct(match, -F.col(order)))
    return df.agg(best.alias("b")).select(
        F.col(f"b.{order}").alias(order), F.col("b.title").alias("title"),
        F.coalesce("b.reason", F.lit(fv.NO_SELECTION_REASON)).alias("main_reason"))


def action_plan(df: DataFrame, run_stats: DataFrame, rules: ReportRules) -> DataFrame:
    """Rows per action; skipped rows of the run are added from its one-row statistics."""
    level = rs.recommendation_level(df, rules)
    counts = df.agg(
        *[count_if(level == name).alias(name) for name in ("apply_today", "watch", "skip")],
        F.coalesce(F.max(rs.score_of(df, "match_score")), F.lit(0)).alias("best_match"))
    lost = run_stats.agg(F.coalesce(F.sum(
        sum((rs.score_of(run_stats, n) for n in ("seen_skipped", "removed_far", "removed_unknown")), F.lit(0))),
        F.lit(0)).alias("lost")).scalar()
    return counts.withColumn("skip", F.col("skip") + lost)


def rejection_of(df: DataFrame) -> Column:
    return F.lower(tx.first_filled(tx.field(df, "selection_rejection_reason"), tx.field(df, "rejection_reason")))


def block_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    spark = df.sparkSession
    return F.broadcast(spark.createDataFrame(list(enumerate(names)), "block_seq int, block string"))


def block_diagnostics(df: DataFrame, profile: str, rules: ReportRules) -> DataFrame:
    """Per report block: found rows and why they were not selected (overlapping counts)."""
    reason = rejection_of(df)
    far = tx.field(df, "location_fit").isin("excluded_far", "unknown") & ~tx.flag(df, "remote")
    counts = df.groupBy(cl.report_block(df, profile, rules).alias("block")).agg(
        F.count("*").alias("found"),
        count_if((rs.status(df) == "SEEN") | reason.isin(*fv.HISTORY_REASONS)).alias("already_seen"),
        count_if(reason.isin(*fv.HISTORY_REASONS)).alias("rejected_history"),
        count_if(reason.isin(*fv.PROFILE_REASONS)).alias("rejected_profile"),
        count_if(reason.isin(*fv.CLEANER_REASONS) | far).alias("rejected_cleaner_location"))
    names = fv.REMOTE_BLOCKS if profile == "remote" else fv.LOCAL_BLOCKS
    return block_rows(df, names).join(counts, "block", "left").fillna(0)


def block_groups(report: DataFrame, profile: str, rules: ReportRules, order: Sequence[Column]) -> DataFrame:
    """Titles of the (limited) report rows per block, blocks in fixed order, empty blocks kept.

    Rows are numbered by ranges of the order, without a global window; the list of a
    block holds the titles of its report rows, whose number the report's limit bounds.
    """
    from siftworks.operators.selection import rank_all
    ranked = rank_all(report.withColumn("block", cl.report_block(report, profile, rules)), list(order), ["block", "title"])
    grouped = ranked.groupBy("block").agg(
        F.count("*").alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "title"))), lambda r: r["title"]), " | ").alias("titles"))
    names = fv.REMOTE_BLOCKS if profile == "remote" else fv.LOCAL_BLOCKS
    return block_rows(report, names).join(grouped, "block", "left").fillna(0, ["n"]).fillna("", ["titles"])


def debug_summary(df: DataFrame) -> DataFrame:
    """Counts by result type and location fit; unlisted types count as unknown."""
    real, kind = cl.is_real_posting(df), tx.first_filled(tx.field(df, "result_type"), F.lit("unknown"))
    fit, listed = tx.field(df, "location_fit"), ("search_page", "category_page", "career_page", "company_page", "article")
    is_remote = (fit == "remote") | (tx.flag(df, "remote") & (fit != "allowed_local"))
    return df.groupBy(owner(df).alias("collector")).agg(
        F.count("*").alias("collected"), count_if(real).alias("real_job"),
        *[count_if(~real & (kind == name)).alias(name) for name in listed],
        count_if(~real & ~kind.isin(*listed)).alias("unknown"),
        count_if(fit == "allowed_local").alias("allowed_local"), count_if(is_remote).alias("remote"),
        count_if(~is_remote & (fit == "excluded_far")).alias("excluded_far"),
        count_if(~is_remote & (fit == "unknown")).alias("unknown_location"))


def mail_clean_stats(df: DataFrame, reason: Column) -> DataFrame:
    rejected, known = reason != "", ("search_page", "language_mismatch")
    return df.agg(
        count_if(rejected).alias("quality_rejected"),
        count_if(reason == known[0]).alias("rejected_search_pages"),
        count_if(reason == known[1]).alias("rejected_language_mismatch"),
        count_if(rejected & ~reason.isin(*known)).alias("rejected_low_quality"))


def strategy_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("recommended_strategy").agg(
        F.count("*").alias("sources"), count_if(F.col("reachable")).alias("reachable"))
