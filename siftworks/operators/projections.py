"""Projections to the common posting record."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field as datafield

from pyspark.sql import Column, DataFrame, functions as F

from siftworks.functions import classify as cl, identity as ident, reasons as rs, scoring as sc, text as tx, urls
from siftworks.operators.joins import classify_results
from siftworks.rules import (
    CandidateRules, CleanRules, CommunityRules, IssueRules, MailRules, PostingRules,
    QualityRules, RemoteRules, ReportRules, StudentRules, UrlPatterns, WeightedRules,
)

LOCAL, REMOTE = "local_student", "remote"


@dataclass(frozen=True)
class RuleBook:
    """All rule objects of a run."""

    posting: PostingRules = datafield(default_factory=PostingRules)
    quality: QualityRules = datafield(default_factory=QualityRules)
    student: StudentRules = datafield(default_factory=StudentRules)
    candidate: CandidateRules = datafield(default_factory=CandidateRules)
    remote: RemoteRules = datafield(default_factory=RemoteRules)
    clean: CleanRules = datafield(default_factory=CleanRules)
    mail: MailRules = datafield(default_factory=MailRules)
    report: ReportRules = datafield(default_factory=ReportRules)
    weighted: WeightedRules = datafield(default_factory=WeightedRules)
    community: CommunityRules = datafield(default_factory=CommunityRules)
    issue: IssueRules = datafield(default_factory=IssueRules)
    patterns: UrlPatterns = datafield(default_factory=UrlPatterns)


# --- landed source tables ------------------------------------------------------

# Column of each landed table that feeds the common record (rule rows).
LANDED_SOURCES = {
    "reddit": {"title": ["title"], "company": ["subreddit"], "location": "remote", "description": ["selftext"], "source_score": "score"},
    "remotive": {"title": ["title"], "company": ["company_name"], "location": ["candidate_required_location"], "description": ["description"]},
    "arbeitnow": {},
    "himalayas": {},
    "remotejobs_org": {},
    "remotefirstjobs": {"description": ["query", "description"]},
    "jobicy": {},
    "workanywhere": {},
    "smartjobspa": {"description": ["sector", "role", "contract", "description"]},
    "attalgroup": {"description": ["sector", "role", "contract", "description"]},
    "direzionelavoro": {"description": ["sector", "role", "contract", "description"]},
    "duckduckgo": {"location_default": "Italy"},
}


def normalize_landed(df: DataFrame, source: str, text_limit: int | None = None) -> DataFrame:
    """Common seven columns of one landed table.

    ``text_limit`` cuts the last description part (the shipped setting of the
    scoring job is 6000); by default the whole text is used.
    """
    rule = LANDED_SOURCES[source]

    def column(name: str) -> Column:
        spec = rule.get(name, [name])
        if isinstance(spec, str):
            return F.lit(spec)
        parts = [tx.field(df, part) for part in spec]
        if name == "description" and text_limit is not None:
            parts[-1] = F.substring(parts[-1], 1, text_limit)
        return parts[0] if len(parts) == 1 else F.concat_ws(" ", *parts)

    location = column("location")
    if "location_default" in rule and "location" not in df.columns:
        location = F.lit(rule["location_default"])
    score = tx.to_int(tx.field(df, rule["source_score"])) if "source_score" in rule else F.lit(0)
    keep = [df[c] for c in ("seq",) if c in df.columns]
    return df.select(
        *keep, F.lit(source).alias("source"), column("title").alias("title"), column("company").alias("company"),
        location.alias("location"), column("url").alias("url"), column("description").alias("description"),
        score.alias("source_score"))


# --- enrichment --------------------------------------------------------------------

DETAIL_FIELDS = ("description", "contract_type", "employment_type", "working_hours", "salary", "experience", "skills")
SNIPPET_FIELDS = (*DETAIL_FIELDS, "snippet", "summary", "body", "company", "location", "url")


def long_text(book: RuleBook) -> tx.LongText:
    """The description, searched for all terms that labels, scores and result types look for."""
    return tx.LongText([*cl.posting_terms(book.posting), *sc.student_terms(book.student), *sc.candidate_terms(book.candidate),
                        *book.clean.article, *book.clean.aggregator], "description")


def add_labels(df: DataFrame, book: RuleBook, profile: str = LOCAL, final_url: str | None = None) -> DataFrame:
    """Remote flag, part-time, category, base score and (remote profile) quality labels.

    ``final_url`` names a column with the canonical URL, when the text is still
    to be built with the raw one; it replaces ``url``.
    """
    title, long = tx.field(df, "title"), long_text(book)
    base = long.add(df, tx.field(df, "description"))
    around = [tx.field(df, name) for name in SNIPPET_FIELDS if name != "description"]
    url = tx.field(df, final_url or "url")
    short = {"title": title, "location": tx.field(df, "location"), "url": url}
    base = tx.settle(base, {
        **{f"_low_{n}": F.lower(v) for n, v in short.items()},
        "_rest_body": tx.Joined(long, after=around).short(), "_rest_text": tx.Joined(long, [title], around).short()})
    text = tx.Joined(long, [title], around, "_rest_text")
    fields = [("title", F.col("_low_title")), ("description", tx.Joined(long)), ("snippet", tx.Joined(long, after=around, rest="_rest_body")),
              ("location", F.col("_low_location")), ("url", F.col("_low_url"))]
    remote, reason = cl.remote_flag(fields, book.posting, lowered=True)
    base = tx.settle(base, {
        "remote": remote, "remote_reason": reason,
        "part_time": cl.is_part_time(text, book.posting),
        "category": cl.category(text, book.posting),
        "score": cl.base_score(text, book.posting), "url": url,
    }).drop("_rest_body", "_rest_text", *[f"_low_{n}" for n in short], *[c for c in long.columns if c not in df.columns])
    kind = F.col("category")
    if profile == REMOTE:
        base = sc.add_quality(base, book.quality)
        label = F.col("normalized_remote_category")
        kind = F.when(~label.isin("", "Other"), label).otherwise(kind)
    return base.withColumns({"category": kind, "normalized_category": kind})


def add_location_fit(df: DataFrame, book: RuleBook) -> DataFrame:
    place = tx.join_fields(df, ("location", "title", "url"), lower=False)
    return tx.settle(df, {"location_fit": cl.location_fit(tx.flag(df, "remote"), place, book.student)})


def add_profile_scores(df: DataFrame, book: RuleBook, profile: str = LOCAL) -> DataFrame:
    """Student, candidate, remote and match score; an unwanted title zeroes all."""
    long, at = long_text(book), sc.PROFILE_FIELDS.index("description")
    texts = long.add(df, tx.field(df, "description"))
    before, after = ([tx.field(df, n) for n in names] for names in (sc.PROFILE_FIELDS[:at], sc.PROFILE_FIELDS[at + 1:]))
    texts = tx.settle(texts, {
        "_rest_profile": tx.Joined(long, before, after).short(), "_ntitle": tx.profile_text(tx.field(df, "title")),
        "_rtext": tx.join_fields(df, sc.REMOTE_FIELDS) if profile == REMOTE else F.lit("")})
    text = tx.Joined(long, before, after, "_rest_profile")
    student = tx.settle(texts, sc.student_score(texts, book.student, text))
    unwanted = F.col("profile_reason") == "unwanted_title"
    candidate = F.when(unwanted, 0).otherwise(sc.candidate_score(student, book.candidate, tx.Profile(text)))
    out = tx.settle(student, {"candidate_score": candidate})
    if profile == REMOTE:
        remote = sc.remote_score(out, F.col("candidate_score"), book.remote)
        out = out.withColumn("remote_score", F.when(unwanted, tx.to_int(tx.field(df, "remote_score"))).otherwise(remote))
        match = sc.remote_match_score(F.col("candidate_score"), F.col("remote_score"))
    else:
        out = out.withColumn("remote_score", tx.to_int(tx.field(df, "remote_score")))
        match = sc.match_score(F.col("student_score"), F.col("candidate_score"))
    return out.withColumns({
        "match_score": F.when(unwanted, 0).otherwise(match),
        "negative_reason": F.when(unwanted, "excluded title unwanted_title").otherwise(tx.field(df, "negative_reason")),
        "selection_rejection_reason": F.when(unwanted, "unwanted_title").otherwise(tx.field(df, "selection_rejection_reason")),
    }).drop("_rest_profile", "_ntitle", "_rtext", *[c for c in long.columns if c not in df.columns])


def normalize_posting(df: DataFrame, book: RuleBook, profile: str = LOCAL, with_scores: bool = True,
                      now: Column | None = None, typed: bool = False, hashed: bool = False, searched: bool = False) -> DataFrame:
    """Full enrichment of raw postings.

    ``typed`` also adds the columns of :func:`classify_results`, ``hashed`` job_id and
    content_hash: both read the texts, which are at hand here. ``searched`` keeps what the
    descriptions hold, for :func:`rescore`.
    """
    raw_url, raw_category, title, long = tx.field(df, "url"), tx.field(df, "category"), tx.field(df, "title"), long_text(book)
    around = [*[tx.field(df, name) for name in SNIPPET_FIELDS if name != "description"], raw_category]
    base = tx.settle(long.add(df, tx.field(df, "description")), {
        "_rest_search": tx.Joined(long, [title], around).short(), "_url": urls.canonical_url(raw_url),
        "company": tx.field(df, "company"), "location": tx.field(df, "location")})
    # The snippet contains the raw URL, the remote test the canonical one.
    labelled = add_labels(base, book, profile, final_url="_url").drop("_url")
    fitted = add_location_fit(labelled, book).withColumn("search_profile", F.lit(profile))
    scored = add_profile_scores(fitted, book, profile) if with_scores else fitted.withColumn(
        "remote_score", tx.to_int(tx.field(df, "remote_score")))
    # Settled above with the raw URL and category, which the labels have replaced.
    search = tx.Joined(long, [title], around, "_rest_search")
    bucket = cl.priority_bucket(search, F.col("part_time"), F.col("remote"), book.posting)
    found = tx.field(df, "found_at")
    if now is not None:
        found = tx.first_filled(found, F.date_format(now, "yyyy-MM-dd'T'HH:mm:ssXXX"))
    out = tx.settle(scored, {"priority_bucket": bucket, "found_at": found}).drop("_rest_search")
    if typed:
        out = classify_results(out, book.patterns, book.clean, long)
    if hashed:
        out = tx.settle(out, {"_canonical": urls.canonical_url(tx.field(out, "url"))})
        out = tx.settle(out, {"job_id": ident.job_id(out, F.col("_canonical")), "content_hash": ident.content_hash(
            out, {"description": F.col(long.text)}, F.col("_canonical"))}).drop("_canonical")
    return out.drop(*[c for c in long.columns if c not in df.columns and not (searched and c in (long.ends, long.found))])


def rescore(df: DataFrame, book: RuleBook, profile: str = LOCAL) -> DataFrame:
    """Second scoring pass, run on the rows that survived cleaning; descriptions that were searched in the first pass are not searched again."""
    long = long_text(book)
    base = long.add(df, tx.field(df, "description"))
    return add_profile_scores(add_location_fit(add_labels(base, book, profile), book), book, profile).drop(*long.columns)


# --- site hits ------------------------------------------------------------------------

QUERY_SITES = ("indeed", "subito", "adecco", "talent", "jooble", "duckduckgo")
FULL_REMOTE_SITES = ("talent", "jooble", "gigroup", "randstad")
DETAIL_SITES = ("gigroup", "randstad")


def normalize_site_hits(df: DataFrame, book: RuleBook) -> DataFrame:
    """Posting record of extracted links and search hits (column ``site``).

    Most sites add the query to the part-time test and the score; the two detail
    sites test their detail fields instead, and the query only counts for the
    priority bucket.
    """
    site, title, query = df["site"], tx.field(df, "title"), tx.field(df, "query")
    hit_url = tx.first_filled(*[tx.field(df, n) for n in ("url", "href", "link")])
    engine_url = tx.first_filled(*[tx.field(df, n) for n in ("href", "url", "link", "source")])
    url = urls.canonical_url(F.when(site == "duckduckgo", engine_url).otherwise(hit_url))
    pick = lambda *names: tx.first_filled(*[tx.field(df, n) for n in names])
    snippet = (
        F.when(site.isin(*DETAIL_SITES), tx.join_fields(df, (*DETAIL_FIELDS, "snippet", "body", "source"), lower=False))
        .when(site.isin("talent", "jooble"), pick("description", "snippet", "body"))
        .when(site == "duckduckgo", pick("body", "snippet", "source"))
        .otherwise(pick("snippet", "body", "source"))
    )
    company = F.when(site == "duckduckgo", "").when(site == "gigroup", tx.first_filled(tx.field(df, "company"), F.lit("Gi Group"))).otherwise(tx.field(df, "company"))
    location = F.when(site == "duckduckgo", "").otherwise(tx.field(df, "location"))
    base = tx.settle(df, {"url": url, "title": title, "company": company, "location": location, "_snip": snippet})
    wide = site.isin(*FULL_REMOTE_SITES)
    where = lambda value: F.when(wide, value).otherwise("")
    description = F.when(site.isin("talent", "jooble"), F.col("_snip")).otherwise(tx.field(df, "description"))
    fields = {"title": F.col("title"), "description": where(description), "snippet": F.col("_snip"),
              "location": where(F.col("location")), "url": where(F.col("url"))}
    asked = F.when(site.isin(*QUERY_SITES), query).otherwise("")
    everything = cl.either(F.col("title"), F.col("_snip"), F.col("company"), F.col("location"), query)
    base = tx.settle(base, {
        **{f"_low_{n}": F.lower(v) for n, v in fields.items()}, "_text": cl.either(F.col("title"), F.col("_snip")),
        "_asked": cl.either(F.col("title"), F.col("_snip"), asked), "_everything": everything, "description": description})
    remote, reason = cl.remote_flag([(n, F.col(f"_low_{n}")) for n in fields], book.posting, lowered=True)
    labelled = tx.settle(base, {
        "remote": remote, "remote_reason": reason, "part_time": cl.is_part_time(F.col("_asked"), book.posting),
        "category": cl.category(F.col("_text"), book.posting), "score": cl.base_score(F.col("_asked"), book.posting), "source": site,
    }).drop("_text", "_asked", *[f"_low_{n}" for n in fields])
    return labelled.withColumns({
        "normalized_category": F.col("category"),
        "smart_working": tx.flag(df, "smart_working") | (site.isin(*DETAIL_SITES) & F.col("remote")),
        "full_time": tx.flag(df, "full_time"),
        "priority_bucket": cl.priority_bucket(F.col("_everything"), F.col("part_time"), F.col("remote"), book.posting),
    }).drop("_snip", "_everything")


def merge_details(listing: DataFrame, detail: DataFrame, key: str = "url") -> DataFrame:
    """Overlay detail fields on listing rows.

    Non-empty detail values win; location and company only fill blanks; the two
    flags are always taken from the detail row when there is one.  Of several detail
    rows of a URL the smallest counts, so a listing row stays one row.
    """
    names = [c for c in detail.columns if c != key]
    right = detail.filter(tx.nz(F.col(key)) != "").groupBy(key).agg(F.min(F.struct(*names)).alias("_d")).withColumnRenamed(key, "_key")
    # Rows without a key match nothing; spread by their content they do not meet in one task.
    spread = F.concat(F.lit("\0"), F.xxhash64(*[c for c in listing.columns]).cast("string"))
    joined = listing.join(right, F.when(tx.nz(F.col(key)) != "", F.col(key)).otherwise(spread) == F.col("_key"), "left").drop("_key")
    known = F.col("_d").isNotNull()
    out = {}
    for name in names:
        new = F.col(f"_d.{name}")
        if name in ("smart_working", "full_time"):
            out[name] = F.when(known, F.coalesce(new, tx.no())).otherwise(tx.flag(listing, name))
        elif name in ("location", "company"):
            out[name] = tx.first_filled(tx.field(listing, name), tx.nz(new))
        else:
            out[name] = tx.first_filled(tx.nz(new), tx.field(listing, name))
    return joined.withColumns(out).drop("_d")


# --- community -----------------------------------------------------------------------------

SIGNALS = ("language_signals", "payment_signals", "contact_signals", "negative_signals")


def normalize_posts(df: DataFrame) -> DataFrame:
    """Posting record of scored community posts."""
    body = tx.first_filled(tx.field(df, "body"), tx.field(df, "summary"))
    snippet = tx.cut_at_word(tx.plain_text(body), 500)
    when = tx.first_filled(tx.field(df, "created_at"), tx.field(df, "published_at"))
    return df.select(
        df["seq"], tx.field(df, "title").alias("title"),
        tx.first_filled(tx.field(df, "subreddit"), tx.field(df, "author")).alias("company"),
        F.when(df["remote"], "Remote").otherwise("").alias("location"),
        tx.field(df, "url").alias("url"), F.lit("reddit").alias("source"), snippet.alias("snippet"),
        tx.plain_text(body).alias("description"), when.alias("created_at"), tx.field(df, "query").alias("query"),
        tx.field(df, "subreddit").alias("subreddit"), tx.field(df, "author").alias("author"),
        df["remote"], df["category"], df["category"].alias("normalized_category"),
        F.lit("remote_reddit_post").alias("job_type"),
        *[F.array_join(df[n], ", ").alias(n) for n in SIGNALS],
        F.array_join(df["contact_signals"], ", ").alias("application_signals"),
        df["score"], df["score"].alias("remote_score_delta"), df["score_reason"],
        F.lit("job").alias("result_type"), F.lit("real_job").alias("url_result_type"))


def repository_owner(df: DataFrame) -> Column:
    owner = F.regexp_extract(tx.field(df, "repository_url"), "/repos/([^/]+)/", 1)
    login = tx.nz(df["user"]["login"]) if "user" in df.columns else F.lit("")
    return tx.first_filled(owner, login)


def normalize_issues(df: DataFrame) -> DataFrame:
    """Posting record of scored issues."""
    snippet = tx.cut_at_word(tx.field(df, "body"), 500)
    return df.select(
        df["seq"], tx.field(df, "title").alias("title"), repository_owner(df).alias("company"),
        F.when(df["remote"], "Remote").otherwise("").alias("location"),
        tx.field(df, "html_url").alias("url"), F.lit("github").alias("source"), snippet.alias("snippet"),
        tx.first_filled(tx.field(df, "body"), snippet).alias("description"),
        tx.field(df, "created_at").alias("created_at"), tx.field(df, "query").alias("query"),
        df["remote"], df["category"], df["category"].alias("normalized_category"),
        F.lit("remote_github_issue").alias("job_type"),
        *[F.array_join(df[n], ", ").alias(n) for n in SIGNALS],
        df["score"], df["score"].alias("remote_score_delta"), df["score_reason"],
        tx.field(df, "state").alias("issue_state"),
        F.lit("job").alias("result_type"), F.lit("real_job").alias("url_result_type"))


# --- pool columns ------------------------------------------------------------------------------

POOL_NUMBERS = ("match_score", "student_score", "candidate_score", "remote_score", "score", "sent_count", "days_since_last_sent")
# Label of each pool column (fixed output format).
POOL_COLUMNS = (
    ("Match Score", "match_score"), ("Student Score", "student_score"), ("Candidate Score", "candidate_score"),
    ("Remote Score", "remote_score"), ("Base Score", "score"), ("Search Profile", "search_profile"),
    ("Title", "title"), ("Company", "company"), ("Location", "location"), ("Description", "description"),
    ("Contract Type", "contract_type"), ("Employment Type", "employment_type"), ("Working Hours", "working_hours"),
    ("Salary", "salary"), ("Experience", "experience"), ("Skills", "skills"), ("Smart Working", "smart_working"),
    ("Full Time", "full_time"), ("Country Restriction", "country_restriction"),
    ("Remote Employment Type", "employment_type"), ("Salary Min", "salary_min"), ("Salary Max", "salary_max"),
    ("Currency", "currency"), ("Salary Text", "salary_text"), ("Remote Category", "normalized_remote_category"),
    ("Positive Reason", "positive_reason"), ("Negative Reason", "negative_reason"), ("Location Fit", "location_fit"),
    ("Remote", "remote"), ("Remote Reason", "remote_reason"), ("Source", "source"), ("Collector", "collector"),
    ("Category", "category"), ("Normalized Category", "normalized_category"), ("Score Reason", "score_reason"),
    ("Payment Signal", "payment_signals"), ("Subreddit", "subreddit"), ("Author", "author"),
    ("Priority Bucket", "priority_bucket"), ("URL", "url"), ("History Status", "history_status"),
    ("Selection Reason", "selection_reason"), ("Selection Rejection Reason", "selection_rejection_reason"),
    ("Rejection Reason", "rejection_reason"), ("First Seen", "first_seen"), ("Last Seen", "last_seen"),
    ("Last Sent", "last_sent"), ("Sent Count", "sent_count"), ("Days Since Last Sent", "days_since_last_sent"),
    ("Rotation Eligible", "rotation_eligible"), ("Job ID", "job_id"), ("Content Hash", "content_hash"), ("Action", "action"),
)


def pool_columns(df: DataFrame) -> DataFrame:
    """The labelled pool table: numbers coerced, everything else as text."""
    value = lambda name: rs.score_of(df, name) if name in POOL_NUMBERS else tx.field(df, name)
    return df.select(*[value(name).alias(label) for label, name in POOL_COLUMNS])


def mail_columns(df: DataFrame, rules: MailRules) -> DataFrame:
    """Mail cleaning labels of a row."""
    reason = cl.mail_rejection(df, rules)
    return df.withColumns({
        "remote_email_result_type": F.when(reason == "", "job").otherwise(reason),
        "remote_email_rejection_reason": reason,
        "remote_email_quality_flags": F.when(reason == "search_page", F.array(F.lit("search_or_listing_page")))
        .when(reason == "language_mismatch", F.array(F.lit("title_language_mismatch")))
        .otherwise(F.array().cast("array<string>")),
        "remote_match_summary": cl.match_summary(df, rules),
    })


def report_columns(df: DataFrame, rules: ReportRules) -> DataFrame:
    """Recommendation, reasons and document hints; values already on the row win."""
    df = cl.with_report_text(df)
    level = tx.first_filled(tx.field(df, "recommendation_level"), rs.recommendation_level(df, rules))
    cv = tx.first_filled(tx.field(df, "recommended_cv"), rs.recommended_cv(df, rules))
    out = df.withColumns({
        "recommendation_level": level, "fit_reasons": rs.fit_reasons(df, rules),
        "risk_reasons": rs.risk_reasons(df, rules), "recommended_cv": cv})
    letter = tx.first_filled(tx.field(df, "recommended_cover_letter"), rs.recommended_letter(rs.recommended_cv(df, rules)))
    return out.withColumn("recommended_cover_letter", letter).drop("_rtext")
