"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siftworks.functions import classify as cl, reasons as rs, scoring as sc, text as tx, urls
from siftworks.operators.selection import pool_order
from siftworks.rules import CleanRules, MailRules, PostingRules, RemoteRules, WeightedRules, fixed_values as fv


def community_phrases(df: DataFrame, keywords: Sequence[str], hiring: Sequence[str], excluded: Sequence[str],
                      fields=("title", "selftext")) -> DataFrame:
    """A keyword and a hiring phrase, and no excluded phrase (whole words)."""
    text = tx.join_fields(df, fields)
    return df.filter(tx.has_phrase(text, keywords) & tx.has_phrase(text, hiring) & ~tx.has_phrase(text, excluded))


def region_phrases(df: DataFrame, good: Sequence[str], strong: Sequence[str], bad: Sequence[str],
                   regions: Sequence[str]) -> DataFrame:
    """A good or strong phrase, no bad phrase, and an allowed region in the location."""
    text = tx.join_fields(df, ("title", "description"))
    wanted = tx.has_phrase(text, good) | tx.has_phrase(text, strong)
    return df.filter(wanted & ~tx.has_phrase(text, bad) & tx.has_phrase(F.lower(tx.field(df, "location")), regions))


def signal_or_category(df: DataFrame, rules: WeightedRules) -> DataFrame:
    found = df if "_matched" in df.columns else sc.add_matched(df, rules)
    kept = found.filter((tx.field(df, "normalized_remote_category") != "Other") | sc.has_signal(rules))
    return kept if "_matched" in df.columns else kept.drop("_matched")


def min_score_by_source(df: DataFrame, rules: WeightedRules, score: str = "job_score") -> DataFrame:
    """Score at or above the threshold of the row's source."""
    threshold = F.coalesce(
        *[F.when(tx.field(df, "source") == s, F.lit(n)) for s, n in rules.min_score_by_source.items()],
        F.lit(rules.default_min_score))
    return df.filter(F.col(score) >= threshold)


def without_bad_terms(df: DataFrame, rules: PostingRules, fields=("title", "snippet")) -> DataFrame:
    return df.filter(~cl.is_bad(tx.join_fields(df, fields), rules))


def block_and_mark_domains(df: DataFrame, blocked: Sequence[str] = fv.SEARCH_BAD_DOMAINS,
                           preferred: Sequence[str] = fv.SEARCH_GOOD_DOMAINS) -> DataFrame:
    """Drop blocked domains; mark preferred ones in the description."""
    url = tx.field(df, "url")
    place = F.lower(F.concat(urls.authority(url), urls.path(url)))
    marked = F.trim(F.concat(tx.field(df, "description"), F.lit(" " + fv.PREFERRED_MARK)))
    return df.filter(~tx.has_any(place, blocked)).withColumn(
        "description", F.when(tx.has_any(F.lower(url), preferred), marked).otherwise(tx.field(df, "description")))


def remote_only(df: DataFrame, rules: RemoteRules) -> DataFrame:
    text = tx.join_fields(df, sc.REMOTE_FIELDS)
    return df.filter(tx.has_any(text, rules.keywords) & ~tx.has_any(text, rules.blockers))


def drop_far(df: DataFrame) -> DataFrame:
    return df.filter(tx.field(df, "location_fit") != "excluded_far")


def drop_unknown_location(df: DataFrame) -> DataFrame:
    return df.filter((tx.field(df, "location_fit") != "unknown") | tx.flag(df, "remote"))


def cleaned(df: DataFrame, mode: str, rules: CleanRules) -> DataFrame:
    return df.filter(cl.keep_by_mode(df, mode, rules))


def eligible(df: DataFrame, min_match: int = fv.SELECTION_MIN_MATCH) -> DataFrame:
    return df.filter(rs.selectable(df, min_match))


def mail_clean(df: DataFrame, rules: MailRules) -> DataFrame:
    return df.filter(cl.mail_rejection(df, rules) == "")


def pool_view(df: DataFrame, source: str = "", location: str = "", reason: str = "",
              top: int | None = None, order: str = "seq") -> DataFrame:
    """Case-insensitive filters on a pool, then the first rows in pool order."""
    owner = tx.first_filled(tx.field(df, "source"), tx.field(df, "collector"))
    tests = [(source, owner), (location, tx.field(df, "location_fit")), (reason, tx.field(df, "rejection_reason"))]
    for wanted, value in tests:
        if wanted:
            df = df.filter(F.lower(value) == wanted.lower())
    return df if top is None else df.orderBy(*pool_order(df, order)).limit(top)


def selected_or_all(df: DataFrame) -> DataFrame:
    """Rows marked 'selected'; all rows when none is marked."""
    marked = F.lower(tx.field(df, "selection_rejection_reason")) == "selected"
    any_marked = df.agg(F.coalesce(F.bool_or(marked), F.lit(False))).scalar()
    return df.filter(marked | ~any_marked)
