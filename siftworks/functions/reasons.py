"""Reason ladders, status labels and report texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siftworks.functions import classify as cl, text as tx
from siftworks.rules import ReportRules, fixed_values as fv

STATUSES = ("NEW", "UPDATED", "SEEN", "RESURFACED")


def ladder(steps: Sequence[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    """First matching step wins; null conditions count as false."""
    as_col = lambda value: value if isinstance(value, Column) else F.lit(value)
    result = F.when(F.coalesce(steps[0][0], tx.no()), as_col(steps[0][1]))
    for condition, value in steps[1:]:
        result = result.when(F.coalesce(condition, tx.no()), as_col(value))
    return result.otherwise(as_col(otherwise))


def position(value: Column, order: Sequence[str]) -> Column:
    """Rank of a value in a fixed order; unknown values come last."""
    return F.coalesce(*[F.when(value == name, F.lit(i)) for i, name in enumerate(order)], F.lit(len(order)))


# --- eligibility -------------------------------------------------------------

def score_of(df: DataFrame, name: str) -> Column:
    return tx.to_int(F.col(name)) if name in df.columns else F.lit(0)


def location_rejected(df: DataFrame) -> Column:
    fit = tx.field(df, "location_fit")
    return (fit == "excluded_far") | ((fit == "unknown") & ~tx.flag(df, "remote"))


def unwanted_title(df: DataFrame) -> Column:
    refused = F.coalesce(~df["profile_match"], tx.no()) if "profile_match" in df.columns else tx.no()
    by_reason = (F.lower(tx.field(df, "profile_reason")) == "unwanted_title") & refused
    return by_reason | (F.lower(tx.field(df, "selection_rejection_reason")) == "unwanted_title")


def profile_rejected(df: DataFrame) -> Column:
    negative = F.lower(tx.field(df, "negative_reason"))
    return unwanted_title(df) | tx.has_any(negative, ("country", "seniority", "excluded title"))


def selectable(df: DataFrame, min_match: int) -> Column:
    return (score_of(df, "match_score") >= min_match) & ~location_rejected(df) & ~profile_rejected(df)


def never_sent(df: DataFrame) -> Column:
    return (score_of(df, "sent_count") == 0) | (F.trim(tx.field(df, "last_sent")) == "")


def status(df: DataFrame) -> Column:
    return F.upper(tx.field(df, "history_status"))


def selection_buckets(df: DataFrame) -> dict[str, Column]:
    """Membership of the ordered selection buckets (they overlap)."""
    state, unsent = status(df), never_sent(df)
    return {
        "NEW": state == "NEW",
        "UPDATED": state == "UPDATED",
        "NEVER_SENT_FILL": unsent & ~state.isin("NEW", "UPDATED"),
        "RESURFACED": state == "RESURFACED",
        "FALLBACK_ROTATION": tx.flag(df, "rotation_eligible") & ~unsent & state.isin("SEEN", "RESURFACED"),
    }


# --- rejection ladders ----------------------------------------------------------

def selection_rejection(df: DataFrame, selected: Column, min_match: int, include_seen: bool = False) -> Column:
    buckets, seen = selection_buckets(df), status(df) == "SEEN"
    has_bucket = buckets["NEW"] | buckets["UPDATED"] | buckets["NEVER_SENT_FILL"] | buckets["RESURFACED"]
    kept_seen = seen if include_seen else tx.no()
    return ladder([
        (selected, "selected"),
        (location_rejected(df), "location_rejected"),
        (profile_rejected(df), "profile_rejected"),
        (score_of(df, "match_score") < min_match, "low_match"),
        (seen & ~kept_seen & ~never_sent(df), "seen_recently"),
        (~has_bucket & ~kept_seen, "no_selection_bucket"),
    ], "not_selected_due_to_limit")


def pool_selection_rejection(df: DataFrame, selected: Column, min_match: int) -> Column:
    """As above, without the unwanted-title test (pool rows)."""
    negative = F.lower(tx.field(df, "negative_reason"))
    state, unsent = status(df), never_sent(df)
    return ladder([
        (selected, "selected"),
        (location_rejected(df), "location_rejected"),
        (tx.has_any(negative, ("country", "seniority", "excluded title")), "profile_rejected"),
        (score_of(df, "match_score") < min_match, "low_match"),
        ((state == "SEEN") & ~unsent, "seen_recently"),
        (~(state.isin("NEW", "UPDATED", "RESURFACED") | unsent), "no_selection_bucket"),
    ], "not_selected_due_to_limit")


PAGE_TYPES = ("search_page", "category_page", "career_page", "company_page", "article", "excluded_domain")


def pool_rejection(df: DataFrame, selected: Column) -> Column:
    kind, fit = tx.field(df, "result_type"), tx.field(df, "location_fit")
    negative = F.lower(tx.field(df, "negative_reason"))
    return ladder([
        (kind.isin(*PAGE_TYPES), kind),
        (selected, "passed"),
        (fit == "excluded_far", "excluded_far"),
        ((fit == "unknown") & ~tx.flag(df, "remote"), "unknown_location"),
        (tx.field(df, "history_status") == "SEEN", "history_seen"),
        (F.contains(negative, F.lit("country")), "rejected_by_country"),
        (tx.has_any(negative, ("seniority", "excluded title")), "rejected_by_seniority"),
        (score_of(df, "match_score") < fv.POOL_MATCH_THRESHOLD, "low_match"),
    ], "email_limit")


def debug_rejection(df: DataFrame, duplicate: Column) -> Column:
    """Reason shown for a URL in the pattern debug table."""
    kind = tx.field(df, "result_type")
    score = score_of(df, "match_score")
    steps = [(duplicate, "duplicate")]
    steps += [(kind == name, reason) for name, reason in fv.MATCHED_REASON_BY_TYPE.items()]
    steps += [
        ((tx.field(df, "url_result_type") == "unknown") | (kind == "unknown"), "unknown_pattern"),
        (location_rejected(df), "excluded_location"),
        (tx.field(df, "history_status") == "SEEN", "history_seen"),
        ((score != 0) & (score < fv.POOL_MATCH_THRESHOLD), "low_score"),
    ]
    return ladder(steps, "")


def collector_debug_rejection(df: DataFrame) -> Column:
    kind, fit = tx.field(df, "result_type"), tx.field(df, "location_fit")
    return ladder([
        (kind.isin(*PAGE_TYPES, "unknown"), kind),
        (fit == "excluded_far", "excluded_far"),
        ((fit == "unknown") & ~tx.flag(df, "remote"), "unknown_location"),
    ], "passed")


def post_rejection(df: DataFrame, max_days: int = fv.POST_MAX_DAYS) -> Column:
    """First reason to drop a scored community post, '' to keep it."""
    some = lambda name: F.size(name) > 0
    strong = (
        df["remote"] & (df["category"] != "other") & some("payment_signals")
        & some("contact_signals") & (df["score"] >= 70)
    )
    return ladder([
        (some("scam_signals"), "scam_signal"),
        (some("non_job_signals"), "non_job_post"),
        (some("unpaid_signals"), "unpaid"),
        (some("commission_signals"), "commission_or_referral_only"),
        (df["vague_dm"], "vague_dm_only"),
        ((df["age_days"] > max_days) & ~strong, "too_old"),
        (~df["remote"], "not_remote"),
        (df["category"] == "other", "no_positive_category"),
        (df["score"] <= 0, "low_reddit_score"),
    ], "")


def issue_rejection(df: DataFrame) -> Column:
    some = lambda name: F.size(name) > 0
    return ladder([
        (some("non_job_signals"), "non_job_issue"),
        (df["help_wanted"] & ~(some("payment_signals") | some("contact_signals")), "help_wanted_without_job_signal"),
        (some("developer_signals"), "developer_heavy"),
        (~df["remote"], "not_remote"),
        (df["category"] == "other", "no_positive_category"),
        (df["score"] <= 0, "low_github_score"),
    ], "")


# --- debug status ------------------------------------------------------------------

def detected_type(df: DataFrame) -> Column:
    by_url, kind = tx.field(df, "url_result_type"), tx.field(df, "result_type")
    return ladder([
        ((by_url != "") & (by_url != "unknown"), by_url),
        (kind == "job", "real_job"),
    ], tx.first_filled(kind, by_url, F.lit("unknown")))


def final_status(df: DataFrame, exported: Column, duplicate: Column) -> Column:
    return ladder([
        (duplicate, "rejected"), (exported, "email"), (cl.is_real_posting(df), "candidate_pool"),
    ], "rejected")


def acceptance(final: Column) -> Column:
    return F.when(final.isin("email", "candidate_pool"), "accepted").otherwise("rejected")


# --- report ---------------------------------------------------------------------------

def recommendation_level(df: DataFrame, rules: ReportRules) -> Column:
    refusal = F.lower(tx.field(df, "selection_rejection_reason"))
    match, fit = score_of(df, "match_score"), F.lower(tx.field(df, "location_fit"))
    hard = (tx.field(df, "location_fit") == "excluded_far") | tx.has_any(cl.report_text(df), rules.hard_risk)
    return ladder([
        (~refusal.isin("", "selected"), "skip"),
        (status(df) == "SEEN", "skip"),
        ((match >= 75) & fit.isin("allowed_local", "remote") & ~hard, "apply_today"),
        (match >= 68, "good"),
        (match >= 58, "consider"),
        (match > 0, "watch"),
    ], "skip")


def lookup(value: Column, table, otherwise: str) -> Column:
    return F.coalesce(*[F.when(value == k, F.lit(v)) for k, v in table.items()], F.lit(otherwise))


def level_label(level: Column) -> Column:
    return lookup(level, fv.LEVEL_LABELS, fv.LEVEL_LABELS["watch"])


def status_label(value: Column) -> Column:
    return lookup(value, fv.STATUS_LABELS, "")


def match_label(score: Column) -> Column:
    (strong, top), (good, middle), (_, low) = fv.MATCH_LABELS
    return F.when(score >= strong, top).when(score >= good, middle).otherwise(low)


def _topics(df: DataFrame, rules: ReportRules) -> dict[str, Column]:
    text, kind = cl.report_text(df), F.lower(tx.field(df, "category"))
    topic = lambda categories, terms: kind.isin(*categories) | tx.has_any(text, terms)
    return {
        "ai": topic(fv.REPORT_AI_CATEGORIES, rules.ai),
        "entry": topic(fv.REPORT_ENTRY_CATEGORIES, rules.entry),
        "reception": topic(fv.REPORT_RECEPTION_CATEGORIES, rules.reception),
        "office": topic(fv.REPORT_OFFICE_CATEGORIES, rules.office),
        "stock": topic(fv.REPORT_STOCK_CATEGORIES, rules.stock),
        "hospitality": topic(fv.REPORT_HOSPITALITY_CATEGORIES, rules.hospitality),
        "retail": topic(fv.REPORT_RETAIL_CATEGORIES, rules.retail),
    }


def recommended_cv(df: DataFrame, rules: ReportRules) -> Column:
    t = _topics(df, rules)
    ai_label = F.lower(tx.field(df, "normalized_remote_category")).isin("ai training", "ai annotation")
    return ladder([
        (t["ai"] | ai_label, "AI / Data Annotation CV"),
        (t["entry"], "Data Entry CV"),
        (t["reception"], "Back Office / Reception CV"),
        (t["office"], "Back Office CV"),
        (t["stock"], "Logistics CV"),
        (t["hospitality"], "Hospitality CV"),
        (t["retail"], "Retail / GDO CV"),
    ], "Generic CV")


def recommended_letter(cv: Column) -> Column:
    return lookup(cv, fv.LETTER_BY_CV, fv.LETTER_BY_CV["Generic CV"])


def _items(df: DataFrame, names: Sequence[str]) -> Column:
    """Given reasons of a row; text columns become one-element arrays."""
    parts = [F.array().cast("array<string>")]
    for name in names:
        if name not in df.columns:
            continue
        if dict(df.dtypes)[name].startswith("array"):
            parts.append(F.coalesce(df[name], parts[0]))
        else:
            parts.append(F.array(tx.field(df, name)))
    return F.concat(*parts)


def _when_items(*items: tuple[Column, str | Column]) -> Column:
    return F.array_compact(F.array(*[
        F.when(condition, value if isinstance(value, Column) else F.lit(value)) for condition, value in items
    ]))


def fit_reasons(df: DataFrame, rules: ReportRules, limit: int = fv.REASON_LIMIT) -> Column:
    text, fit, t = cl.report_text(df), F.lower(tx.field(df, "location_fit")), _topics(df, rules)
    place = F.coalesce(*[F.when(F.contains(text, F.lit(term)), F.lit(label)) for term, label in rules.places],
                       F.lit(fv.REPORT_LOCAL_REASON))
    part_time = tx.flag(df, "part_time") | tx.has_any(text, rules.part_time)
    labels = fv.FIT_LABELS
    found = _when_items(
        (fit == "allowed_local", place),
        ((fit == "remote") | tx.flag(df, "remote"), labels["remote"]),
        (part_time, labels["part_time"]),
        (part_time, labels["study"]),
        (tx.has_any(text, rules.schedule), labels["schedule"]),
        (t["entry"], labels["entry"]),
        (t["office"], labels["office"]),
        (t["stock"], labels["stock"]),
        (t["hospitality"], labels["hospitality"]),
        (t["ai"], labels["ai"]),
        (~tx.has_any(text, rules.degree), labels["degree"]),
    )
    given = _items(df, ("fit_reasons", "student_reason", "candidate_reason", "positive_reason"))
    return F.slice(tx.distinct_items(F.concat(given, found)), 1, limit)


def risk_reasons(df: DataFrame, rules: ReportRules, limit: int = fv.REASON_LIMIT) -> Column:
    text, labels = cl.report_text(df), fv.RISK_LABELS
    filled = lambda name: tx.strip_space(tx.field(df, name))
    fit, negative = tx.field(df, "location_fit"), filled("negative_reason")
    part_time = tx.flag(df, "part_time") | tx.has_any(text, rules.part_time)
    found = _when_items(
        (~part_time, labels["hours"]),
        (tx.has_any(text, rules.language_risk), labels["language"]),
        (tx.has_any(text, rules.night), labels["night"]),
        (fit == "excluded_far", labels["far"]),
        (fit == "unknown", labels["unknown"]),
        ((filled("category") == "") | F.lower(tx.field(df, "category")).isin(*fv.GENERIC_CATEGORIES), labels["category"]),
        (filled("company") == "", labels["company"]),
        (filled("location") == "", labels["location"]),
        ((filled("salary_text") == "") & (filled("salary") == ""), labels["salary"]),
        (negative != "", negative),
    )
    return F.slice(tx.distinct_items(F.concat(_items(df, ("risk_reasons",)), found)), 1, limit)


# --- collector health ---------------------------------------------------------------------

def removed_by_location(df: DataFrame) -> Column:
    return score_of(df, "excluded_far") + score_of(df, "unknown_location")


def removed_by_cleaner(df: DataFrame) -> Column:
    return F.greatest(F.lit(0), score_of(df, "collected") - score_of(df, "after_cleaner"))


def health_status(df: DataFrame) -> Column:
    n = {name: score_of(df, name) for name in (
        "collected", "after_cleaner", "real_jobs", "candidate_pool", "email_jobs", "history_seen",
        "search_pages", "category_pages", "career_pages", "company_pages")}
    pages = (n["search_pages"] > 0) | (n["category_pages"] > 0) | (n["career_pages"] > 0) | (n["company_pages"] > 0)
    disorder = (
        (n["email_jobs"] > n["candidate_pool"]) | (n["candidate_pool"] > n["real_jobs"])
        | (n["real_jobs"] > n["after_cleaner"]) | (n["after_cleaner"] > n["collected"])
    )
    none_real = n["real_jobs"] <= 0
    return ladder([
        (disorder, "inconsistent"),
        (n["collected"] == 0, "no_results"),
        (none_real & pages, "needs_detail_extraction"),
        ((n["real_jobs"] == 0) & (removed_by_cleaner(df) > 0), "cleaner_removed"),
        (n["real_jobs"] == 0, "no_real_jobs"),
        ((n["email_jobs"] == 0) & (n["history_seen"] >= n["real_jobs"]), "history_only"),
    ], "healthy")


HEALTH_POINTS = {
    "inconsistent": 0, "error": 0, "needs_detail_extraction": 20, "no_results": 5,
    "no_real_jobs": 10, "cleaner_removed": 30, "history_only": 80,
}


def health_score(df: DataFrame, state: Column) -> Column:
    collected, real, mailed = (score_of(df, n) for n in ("collected", "real_jobs", "email_jobs"))
    share = lambda part, whole, points: F.when(
        whole != 0, F.rint(part / F.nullif(whole, F.lit(0)) * points).cast("int")).otherwise(0)
    score = (
        F.lit(85) + share(real, collected, 10) + share(mailed, real, 5)
        - F.least(F.lit(20), removed_by_location(df) * 2)
    )
    fixed = F.coalesce(*[F.when(state == name, F.lit(points)) for name, points in HEALTH_POINTS.items()])
    return F.coalesce(fixed, F.greatest(F.lit(0), F.least(F.lit(100), score)))


def health_advice(df: DataFrame, state: Column) -> Column:
    """One sentence per collector; the most telling count comes first."""
    name = tx.first_filled(tx.field(df, "collector"), F.lit("unknown"))
    count = lambda column: score_of(df, column)
    say = lambda *parts: F.concat(name, F.lit(": "), *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    num = lambda column: count(column).cast("string")
    healthy = ladder([
        (count("fallback_rotation") != 0, say("Healthy, ", num("fallback_rotation"), " jobs selected by FALLBACK_ROTATION")),
        (count("history_resurfaced") != 0, say("Healthy, ", num("history_resurfaced"), " RESURFACED jobs")),
        (count("rotation_eligible") != 0, say("Healthy, ", num("rotation_eligible"), " rotation_eligible jobs available")),
        (count("seen_recently") != 0, say("Healthy, ", num("seen_recently"), " jobs skipped as seen_recently")),
        (count("history_new") != 0, say("Healthy, ", num("history_new"), " NEW jobs")),
        (count("history_seen") != 0, say("Healthy, ", num("history_seen"), " jobs skipped by History")),
        (count("real_jobs") <= 1, say("Healthy, only ", num("real_jobs"), " real job; improve Detail Extraction")),
    ], say("Healthy, ", num("email_jobs"), " jobs in email"))
    lost = removed_by_location(df)
    return ladder([
        (state == "inconsistent", "Dashboard counts inconsistent: check source arrays"),
        (state == "healthy", healthy),
        (state == "history_only", say("Healthy, ", num("history_seen"), " jobs skipped by History")),
        (state.isin("needs_detail_extraction", "no_real_jobs"), say("0 real jobs; Recommendation: Detail Extraction")),
        (state == "cleaner_removed", say("Cleaner removed all jobs; inspect URL patterns and result cleaning")),
        (state == "no_results", say("collector returned no jobs; source may be blocked or temporarily unavailable")),
        (state == "error", say("collector returned no jobs or failed; inspect collector logs")),
        (lost != 0, say(lost.cast("string"), " jobs removed by location")),
    ], say("inspect collector health"))
