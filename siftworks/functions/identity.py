"""Identities, content hashes and times."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from siftworks.functions import text as tx, urls

CONTENT_FIELDS = (
    "title", "company", "location", "category", "description",
    "contract_type", "employment_type", "working_hours", "salary",
    "experience", "skills",
)
SENT_CONTENT_FIELDS = (
    "company", "description", "employment_type", "location",
    "negative_reason", "positive_reason", "salary_text", "score_reason",
    "title",
)
SENT_URL_FIELDS = ("url", "link", "apply_url", "job_url")


def _json_hash(texts: list[Column]) -> Column:
    return F.sha2(F.to_json(F.array(*texts)), 256)


def _plain(value: Column) -> Column:
    return F.lower(tx.strip_space(value))


def stable_hash(parts: list[Column]) -> Column:
    """SHA-256 of the compact JSON array of trimmed lower-case texts."""
    return _json_hash([_plain(p) for p in parts])


def dedup_key(df: DataFrame) -> Column:
    """Canonical URL, else title|company|location."""
    identity = F.concat_ws("|", *[F.lower(tx.strip_space(tx.field(df, n))) for n in ("title", "company", "location")])
    return F.when(tx.field(df, "url") != "", urls.canonical_url(tx.field(df, "url"))).otherwise(identity)


def query_dedup_key(df: DataFrame) -> Column:
    """Canonical URL, else title|query."""
    identity = F.concat_ws("|", *[F.lower(tx.strip_space(tx.field(df, n))) for n in ("title", "query")])
    return F.when(tx.field(df, "url") != "", urls.canonical_url(tx.field(df, "url"))).otherwise(identity)


def history_key(df: DataFrame, canonical: Column | None = None) -> Column:
    """Canonical URL, else source|title|company|location as stored; ``canonical``: the canonical URL, where it is at hand."""
    identity = F.concat_ws("|", *[tx.field(df, n) for n in ("source", "title", "company", "location")])
    return F.when(tx.field(df, "url") != "", urls.canonical_url(tx.field(df, "url")) if canonical is None else canonical).otherwise(identity)


def job_id(df: DataFrame, canonical: Column | None = None) -> Column:
    return stable_hash([history_key(df, canonical)])


def content_hash(df: DataFrame, lowered: Mapping[str, Column] | None = None, canonical: Column | None = None) -> Column:
    """``lowered``: columns with the lower-case forms of long fields, which are not lowered again; they have the same hash."""
    truth = [F.when(tx.flag(df, n), "true").otherwise("") for n in ("smart_working", "part_time", "full_time")]
    fields = [tx.strip_long(lowered[n]) if n in (lowered or {}) else _plain(tx.field(df, n)) for n in CONTENT_FIELDS]
    return _json_hash(fields + truth + [_plain(urls.canonical_url(tx.field(df, "url")) if canonical is None else canonical)])


def sent_key(df: DataFrame) -> Column:
    """Key of the small history: first usable link, else title|company|location."""
    links = [urls.canonical_url(tx.field(df, n), unwrap=False, nan_is_blank=True) for n in SENT_URL_FIELDS if n in df.columns]
    identity = F.concat_ws("|", *[F.lower(tx.strip_space(tx.field(df, n))) for n in ("title", "company", "location")])
    return F.coalesce(*[tx.blank_to_null(link) for link in links], identity)


def sent_content_hash(df: DataFrame) -> Column:
    """SHA-256 of a JSON object with sorted keys and ', ' / ': ' separators."""
    pieces: list[Column] = []
    for position, name in enumerate(SENT_CONTENT_FIELDS):
        # The JSON form of one text is the JSON array of it without brackets.
        quoted = F.to_json(F.array(tx.strip_space(tx.field(df, name))))
        quoted = F.substr(quoted, F.lit(2), F.length(quoted) - 2)
        pieces += [F.lit(("{" if position == 0 else ", ") + f'"{name}": '), quoted]
    return F.sha2(F.concat(*pieces, F.lit("}")), 256)


def url_key(df: DataFrame) -> Column:
    """Lower-case URL, else collector|title|company|location."""
    url = F.lower(tx.strip_space(tx.field(df, "url")))
    owner = tx.first_filled(tx.field(df, "collector"), tx.field(df, "source"))
    parts = [owner, *[tx.field(df, n) for n in ("title", "company", "location")]]
    return F.when(url != "", url).otherwise(F.concat_ws("|", *[F.lower(tx.strip_space(p)) for p in parts]))


def parse_time(value: Column) -> Column:
    """UTC timestamp from ISO 8601, RFC 2822 or epoch seconds; null when unreadable."""
    raw = F.trim(tx.nz(value))
    mail = F.regexp_replace(raw, r"^[A-Za-z]{3},\s*", "")
    epoch = F.when(raw.rlike(r"^\d{1,11}(\.\d+)?$"), F.timestamp_seconds(raw.try_cast("double")))
    iso = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(raw))
    rfc = F.when(
        mail.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4} "),
        F.coalesce(
            F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z")),
            F.try_to_timestamp(F.regexp_replace(mail, r" [A-Z]{1,5}$", " +0000"), F.lit("d MMM yyyy HH:mm:ss Z")),
        ),
    )
    return F.coalesce(iso, rfc, epoch)


def age_days(moment: Column, now: Column) -> Column:
    """Whole days from a moment to ``now``, not below 0; null when unknown."""
    seconds = F.unix_timestamp(now) - F.unix_timestamp(moment)
    return F.when(moment.isNotNull(), F.greatest(F.lit(0), F.floor(seconds / 86400).cast("int")))


def calendar_age_days(day: Column, now: Column, zone: str = "Europe/Rome") -> Column:
    """Calendar days between a date and the local date of ``now``."""
    return F.when(day.isNotNull(), F.greatest(F.lit(0), F.datediff(F.to_date(F.from_utc_timestamp(now, zone)), day)))
