"""Rule objects.

Rules are inputs.  Every object has the fixed values as defaults where the
pipeline has built-in terms, and a ``from_mapping`` constructor where the
terms come from a rule file (weights, URL patterns, profiles).  Rule objects
are plain Python data of a known, small size: they enter plans as literals or
as a literal table, never as something read from the big tables.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftworks.rules import fixed_values as fv

Terms = Sequence[str]
Labelled = Sequence[tuple[str, Terms]]

# A rule table this small is broadcast; a larger one is left to the optimizer.
MAX_BROADCAST_RULES = 10_000


def load_rules(path: str, label: str = "rules", required: bool = True) -> dict:
    """Read a rule file (JSON, or YAML when PyYAML is present)."""
    file = Path(path)
    if not file.exists():
        if required:
            raise FileNotFoundError(f"{label} rule file not found: {path}")
        return {}
    raw = file.read_text(encoding="utf-8")
    if file.suffix.lower() == ".json":
        data = json.loads(raw) if raw.strip() else None
    else:
        try:
            import yaml
        except ImportError as exc:
            raise RuntimeError("reading YAML rule files needs PyYAML; use JSON instead") from exc
        data = yaml.safe_load(raw)
    if data is None and not required:
        return {}
    if not isinstance(data, dict):
        raise ValueError(f"{label} rule file must hold a mapping: {path}")
    return data


def phrase_list(config: Mapping, *path: str) -> list[str]:
    """A list nested in a rule file, e.g. ``phrase_list(cfg, "filters", "x", "excluded")``."""
    node = config
    for step in path:
        node = (node or {}).get(step) or {}
    return [str(item) for item in node or []]


def rule_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rule rows as a DataFrame, broadcast only below a fixed row count."""
    frame = spark.createDataFrame([tuple(row) for row in rows], schema)
    return F.broadcast(frame) if len(rows) <= MAX_BROADCAST_RULES else frame


@dataclass(frozen=True)
class PostingRules:
    bad: Terms = fv.BAD_TERMS
    remote: Terms = fv.REMOTE_TERMS
    not_remote: Terms = fv.NEGATIVE_REMOTE_TERMS
    part_time: Terms = fv.PART_TIME_TERMS
    categories: Labelled = fv.CATEGORY_TERMS
    data: Terms = fv.DATA_TERMS
    data_guard: Terms = fv.DATA_GUARD_TERMS
    generic_office: Terms = fv.GENERIC_OFFICE_TERMS
    local: Terms = fv.LOCAL_TERMS
    ai: Terms = fv.AI_TERMS
    ecommerce: Terms = fv.ECOMMERCE_TERMS
    points: Mapping[str, int] = field(default_factory=lambda: dict(fv.BASE_POINTS))


@dataclass(frozen=True)
class CleanRules:
    article: Terms = fv.ARTICLE_TERMS
    listing_titles: Terms = fv.LISTING_TITLE_STARTS
    aggregator: Terms = fv.AGGREGATOR_TERMS
    soft_pages: Sequence[tuple[str, str]] = fv.SOFT_TRUSTED_PAGES
    seeks_work: Terms = fv.PERSON_SEEKS_WORK_TERMS
    roles: Terms = fv.EUROSPIN_ROLE_TERMS


@dataclass(frozen=True)
class QualityRules:
    categories: Labelled = fv.QUALITY_CATEGORIES
    countries: Labelled = fv.COUNTRY_LIMITS
    employment: Labelled = fv.EMPLOYMENT_TYPES
    country_points: Mapping[str, int] = field(default_factory=lambda: dict(fv.COUNTRY_POINTS))
    positive: Sequence[tuple[str, Terms, int]] = fv.QUALITY_POSITIVE
    negative: Sequence[tuple[str, Terms, int]] = fv.QUALITY_NEGATIVE


@dataclass(frozen=True)
class WeightedRules:
    positive: Sequence[tuple[str, int]] = ()
    combos: Sequence[tuple[Terms, int, str]] = ()
    negative: Sequence[tuple[str, int]] = ()
    excluded_titles: Terms = ()
    source_bonus: Mapping[str, int] = field(default_factory=dict)
    min_score_by_source: Mapping[str, int] = field(default_factory=dict)
    default_min_score: int = fv.DEFAULT_MIN_SCORE
    high: int = fv.PRIORITY_HIGH
    medium: int = fv.PRIORITY_MEDIUM
    top_min_score: int = fv.TOP_MIN_SCORE
    top_limit: int = fv.TOP_REPORT_LIMIT
    output_columns: Terms = ()

    @classmethod
    def from_mapping(cls, config: Mapping) -> "WeightedRules":
        export, priority = config.get("export") or {}, config.get("priority") or {}
        return cls(
            positive=tuple((config.get("positive_weights") or {}).items()),
            combos=tuple(
                (tuple(item["phrases"]), int(item["points"]), item["reason"])
                for item in config.get("combo_weights") or []
            ),
            negative=tuple((config.get("negative_weights") or {}).items()),
            excluded_titles=tuple(config.get("hard_exclude_title") or ()),
            source_bonus=dict(config.get("source_bonus") or {}),
            min_score_by_source=dict(config.get("min_score_by_source") or {}),
            high=int(priority.get("high_score", fv.PRIORITY_HIGH)),
            medium=int(priority.get("medium_score", fv.PRIORITY_MEDIUM)),
            top_min_score=int(export.get("top_jobs_min_score", fv.TOP_MIN_SCORE)),
            top_limit=int(export.get("top_report_limit", fv.TOP_REPORT_LIMIT)),
            output_columns=tuple(export.get("output_columns") or ()),
        )

    @property
    def signal_phrases(self) -> list[str]:
        """Positive phrases and combo parts, each once."""
        parts = [p for p, _ in self.positive] + [p for ps, _, _ in self.combos for p in ps]
        return list(dict.fromkeys(parts))

    def table(self, spark: SparkSession) -> DataFrame:
        """All rules as rows ``(rule_set, seq, phrase, points, label)``."""
        rows = [("positive", i, p, n, f"+{n} {p}") for i, (p, n) in enumerate(self.positive)]
        rows += [("combo", i, "|".join(ps), n, f"+{n} {r}") for i, (ps, n, r) in enumerate(self.combos)]
        rows += [("negative", i, p, n, f"{n} {p}") for i, (p, n) in enumerate(self.negative)]
        rows += [("excluded_title", i, p, fv.EXCLUDED_TITLE_SCORE, p) for i, p in enumerate(self.excluded_titles)]
        rows += [("source_bonus", i, s, n, s) for i, (s, n) in enumerate(self.source_bonus.items())]
        rows += [("min_score", i, s, n, s) for i, (s, n) in enumerate(self.min_score_by_source.items())]
        return rule_frame(spark, rows, "rule_set string, seq int, phrase string, points int, label string")


@dataclass(frozen=True)
class StudentRules:
    preferred_titles: Terms = ()
    unwanted_titles: Terms = ()
    allowed_locations: Terms = ()
    excluded_locations: Terms = ()
    location_points: Mapping[str, int] = field(default_factory=lambda: dict(fv.STUDENT_LOCATION_POINTS))
    category_points: Mapping[str, int] = field(default_factory=lambda: dict(fv.STUDENT_CATEGORY_POINTS))
    keyword_points: Mapping[str, int] = field(default_factory=lambda: dict(fv.STUDENT_KEYWORD_POINTS))
    category_terms: Mapping[str, Terms] = field(default_factory=lambda: dict(fv.STUDENT_CATEGORY_TERMS))
    aliases: Mapping[str, str] = field(default_factory=lambda: dict(fv.STUDENT_CATEGORY_ALIASES))

    @classmethod
    def from_mapping(cls, config: Mapping) -> "StudentRules":
        profile = config.get("profile") or config
        names = ("preferred_titles", "unwanted_titles", "allowed_locations", "excluded_locations")
        return cls(**{name: tuple(str(v) for v in profile.get(name) or ()) for name in names})


@dataclass(frozen=True)
class CandidateRules:
    groups: Sequence[tuple[Terms, int]] = fv.CANDIDATE_GROUPS
    category_points: Mapping[str, int] = field(default_factory=lambda: dict(fv.CANDIDATE_CATEGORY_POINTS))
    part_time: Terms = fv.CANDIDATE_PART_TIME_TERMS
    low_fit: Terms = fv.CANDIDATE_LOW_FIT
    specialist: Terms = fv.CANDIDATE_SPECIALIST_TERMS


@dataclass(frozen=True)
class RemoteRules:
    keywords: Terms = fv.REMOTE_KEYWORDS
    blockers: Terms = fv.REMOTE_BLOCKERS
    groups: Sequence[tuple[Terms, int]] = fv.REMOTE_GROUPS


@dataclass(frozen=True)
class MailRules:
    phrases: Terms = fv.LISTING_PHRASES
    title_prefixes: Terms = fv.LISTING_TITLE_PREFIX
    path_terms: Terms = fv.LISTING_PATH_TERMS
    root_paths: Terms = fv.LISTING_ROOT_PATHS
    query_keys: Terms = fv.LISTING_QUERY_KEYS
    host_marks: Terms = fv.LISTING_HOST_MARKS
    mismatch: Terms = fv.MISMATCH_LANGUAGES
    target: Terms = fv.TARGET_LANGUAGES
    summary: Labelled = fv.SUMMARY_LABELS


@dataclass(frozen=True)
class CommunityRules:
    remote: Terms = fv.POST_REMOTE_TERMS
    onsite: Terms = fv.POST_ONSITE_TERMS
    categories: Labelled = fv.POST_CATEGORIES
    ai: Terms = fv.POST_AI_TERMS
    tasks: Terms = fv.POST_TASK_TERMS
    language: Terms = fv.POST_LANGUAGE_TERMS
    scam: Terms = fv.POST_SCAM_TERMS
    non_job: Terms = fv.POST_NON_JOB_TERMS
    unpaid: Terms = fv.POST_UNPAID_TERMS
    commission: Terms = fv.POST_COMMISSION_TERMS
    payment: Terms = fv.POST_PAYMENT_TERMS
    contact: Terms = fv.POST_CONTACT_TERMS
    weak_contact: Terms = fv.POST_WEAK_CONTACT_TERMS
    old_days: int = fv.POST_OLD_DAYS
    max_days: int = fv.POST_MAX_DAYS


@dataclass(frozen=True)
class IssueRules:
    remote: Terms = fv.ISSUE_REMOTE_TERMS
    onsite: Terms = fv.ISSUE_ONSITE_TERMS
    categories: Labelled = fv.ISSUE_CATEGORIES
    developer: Terms = fv.ISSUE_DEVELOPER_TERMS
    non_job: Terms = fv.ISSUE_NON_JOB_TERMS
    help_term: str = fv.ISSUE_HELP_TERM
    unpaid: Terms = fv.ISSUE_UNPAID_TERMS
    payment: Terms = fv.ISSUE_PAYMENT_TERMS
    contact: Terms = fv.ISSUE_CONTACT_TERMS
    language: Terms = fv.ISSUE_LANGUAGE_TERMS
    old_days: int = fv.ISSUE_OLD_DAYS


@dataclass(frozen=True)
class ReportRules:
    local: Terms = fv.LOCAL_TERMS
    hospitality: Terms = fv.REPORT_HOSPITALITY_TERMS
    cleaning: Terms = fv.REPORT_CLEANING_TERMS
    maintenance: Terms = fv.REPORT_MAINTENANCE_TERMS
    warehouse: Terms = fv.REPORT_WAREHOUSE_TERMS
    remote: Terms = fv.REPORT_REMOTE_TERMS
    ai: Terms = fv.REPORT_AI_TERMS
    data: Terms = fv.REPORT_DATA_TERMS
    transcription: Terms = fv.REPORT_TRANSCRIPTION_TERMS
    assistant: Terms = fv.REPORT_ASSISTANT_TERMS
    logistics: Terms = fv.REPORT_LOGISTICS_TERMS
    reception: Terms = fv.REPORT_RECEPTION_TERMS
    entry: Terms = fv.REPORT_ENTRY_TERMS
    office: Terms = fv.REPORT_OFFICE_TERMS
    stock: Terms = fv.REPORT_STOCK_TERMS
    retail: Terms = fv.REPORT_RETAIL_TERMS
    part_time: Terms = fv.REPORT_PART_TIME_TERMS
    schedule: Terms = fv.REPORT_SCHEDULE_TERMS
    degree: Terms = fv.REPORT_DEGREE_TERMS
    language_risk: Terms = fv.REPORT_LANGUAGE_RISK_TERMS
    night: Terms = fv.REPORT_NIGHT_TERMS
    hard_risk: Terms = fv.REPORT_HARD_RISK_TERMS
    places: Sequence[tuple[str, str]] = fv.REPORT_PLACE_REASONS


@dataclass(frozen=True)
class UrlPatterns:
    """URL pattern rows in file order, plus domains that are never wanted."""

    sources: Sequence[Mapping] = ()
    excluded_domains: Terms = ()

    PATTERN_KEYS = ("job", "search", "category_page", "aggregator_page", "article", "profile", "company_page", "career_page")

    @classmethod
    def from_mapping(cls, config: Mapping) -> "UrlPatterns":
        sources = [
            {"source": name, **(body or {})}
            for name, body in config.items()
            if name != "general_exclude_domains"
        ]
        return cls(sources=tuple(sources), excluded_domains=tuple(config.get("general_exclude_domains") or ()))

    def rows(self) -> list[tuple]:
        """One row per host; the first source that lists a host owns it."""
        owned: dict[str, tuple] = {}
        for source in self.sources:
            for domain in source.get("domains") or ():
                host = str(domain).strip().lower().removeprefix("www.")
                lists = {k: [str(p).lower() for p in source.get(k) or ()] for k in (*self.PATTERN_KEYS, "job_all")}
                owned.setdefault(host, (
                    host, source["source"], bool(source.get("search_before_job")),
                    lists["job_all"], *(lists[key] for key in self.PATTERN_KEYS),
                ))
        return list(owned.values())

    def frame(self, spark: SparkSession) -> DataFrame:
        arrays = ", ".join(f"p_{key} array<string>" for key in ("job_all", *self.PATTERN_KEYS))
        return rule_frame(spark, self.rows(), f"p_host string, p_source string, p_search_first boolean, {arrays}")
