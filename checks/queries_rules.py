"""Labels, scores and filters over postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as s, sql_run as r
from checks.corpus import BOOK
from checks.registry import query
from checks.views import normalized, now, postings, table
from siftworks.functions import classify as cl, reasons as rs, scoring as sc, text as tx, urls
from siftworks.operators import filters as fl, joins as jn, projections as pj
from siftworks.rules import fixed_values as fv

P = s.with_postings
NORM = r.run(r.norm_ctes(), "")
CLS = r.run(r.classified_ctes(), "")


@query("text_assembly", P() + f"""
SELECT seq, {s.squeeze("lower(concat_ws(' ', title, company, location, description))")} AS squeezed,
 lower(concat_ws(' ', title, company, location, '', description, query, source)) AS report_text,
 {s.profile_text("concat_ws(' ', title, company, location)")} AS profile FROM postings""")
def text_assembly(spark, folder):
    df = postings(spark, folder)
    return df.select(
        "seq", tx.squeeze(tx.join_fields(df, ("title", "company", "location", "description"))).alias("squeezed"),
        tx.join_fields(df, ("title", "company", "location", "category", "description", "query", "source")).alias("report_text"),
        tx.profile_text(tx.join_fields(df, ("title", "company", "location"))).alias("profile"))


PHRASES = [p for p, _ in BOOK.weighted.positive]
TOKENS = ("the", "der die", "que la", "license", "$/hour", "mit")


@query("phrase_match", "SELECT doc_id, " + s.any_word("lower(text)", PHRASES) + " AS any_word, array_to_string(" +
       s.token_list("lower(text)", TOKENS) + ", ',') AS tokens, " + s.any_of(s.profile_text("text"), ["the the", "der die"]) + " AS profile_hit FROM documents")
def phrase_match(spark, folder):
    df = table(spark, folder, "documents").select("doc_id", "text", F.lower("text").alias("low"))
    return df.select("doc_id", tx.has_phrase(F.col("low"), PHRASES).alias("any_word"),
                     F.array_join(tx.token_terms(F.col("low"), TOKENS), ",").alias("tokens"),
                     tx.has_any(tx.profile_text(F.col("text")), ["the the", "der die"]).alias("profile_hit"))


@query("rule_theta_join", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN {s.has_word('lower(text)', p)} THEN {s.q(p)} END" for p in PHRASES) + "], lambda x: x IS NOT NULL), ',') AS phrases FROM documents")
def rule_theta_join(spark, folder):
    df = tx.settle(table(spark, folder, "documents").select("doc_id", "text"), {"low": F.lower("text")})
    return tx.find_phrases(df, "low", PHRASES, "found").select("doc_id", F.array_join("found", ",").alias("phrases"))


FLAG, REASON = r.remote_sql([("title", "title"), ("description", "description"), ("location", "location"), ("url", "url"), ("query", "query")])


@query("remote_flag_reason", P() + f"SELECT seq, {FLAG} AS remote, {REASON} AS remote_reason FROM postings")
def remote_flag_reason(spark, folder):
    df = postings(spark, folder)
    names = ("title", "description", "location", "url", "query")
    flag, reason = cl.remote_flag([(n, tx.field(df, n)) for n in names], BOOK.posting)
    return df.select("seq", flag.alias("remote"), reason.alias("remote_reason"))


LTEXT = "t AS (SELECT *, lower(concat_ws(' ', title, description)) AS lt FROM postings)"


def with_text(spark, folder):
    df = postings(spark, folder)
    return tx.settle(df, {"lt": cl.either(df["title"], df["description"])})


@query("category_rule", P(LTEXT) + f"SELECT seq, {r.category_sql('lt')} AS category, {s.any_of('lt', BOOK.posting.part_time)} AS part_time FROM t")
def category_rule(spark, folder):
    lt = F.col("lt")
    return with_text(spark, folder).select("seq", cl.category(lt, BOOK.posting).alias("category"), cl.is_part_time(lt, BOOK.posting).alias("part_time"))


@query("base_score", P(LTEXT) + f"SELECT seq, {r.base_score_sql('lt')} AS score FROM t")
def base_score(spark, folder):
    return with_text(spark, folder).select("seq", cl.base_score(F.col("lt"), BOOK.posting).alias("score"))


@query("priority_bucket", P(LTEXT, f"f AS (SELECT seq, lt, {s.any_of('lt', BOOK.posting.part_time)} AS part_time, contains(lt, 'license') AS remote FROM t)")
       + f"SELECT seq, {r.bucket_sql('lt')} AS priority_bucket FROM f")
def priority_bucket(spark, folder):
    lt = F.col("lt")
    return with_text(spark, folder).select("seq", cl.priority_bucket(
        lt, cl.is_part_time(lt, BOOK.posting), F.contains(lt, F.lit("license")), BOOK.posting).alias("priority_bucket"))


@query("location_fit", P() + f"SELECT seq, {r.location_sql('concat_ws(chr(32), location, title, url)', 'contains(description, chr(108) || chr(105) || chr(99) || chr(101) || chr(110))')} AS location_fit FROM postings")
def location_fit(spark, folder):
    df = postings(spark, folder)
    place = tx.join_fields(df, ("location", "title", "url"), lower=False)
    return df.select("seq", cl.location_fit(F.contains("description", F.lit("licen")), place, BOOK.student).alias("location_fit"))


@query("result_type", CLS + "SELECT seq, utype AS url_result_type, upattern AS matched_pattern, rtype AS result_type FROM cls")
def result_type(spark, folder):
    df = jn.classify_results(normalized(spark, folder), BOOK.patterns, BOOK.clean)
    return df.select("seq", "url_result_type", "matched_pattern", "result_type")


QUALITY = P("base AS (SELECT *, '' AS category FROM postings)", *r.quality_ctes("base", "ql"))
QUALITY_COLS = ("remote_score_delta", "normalized_remote_category", "country_restriction", "employment_type", "salary_min", "salary_max",
                "currency", "salary_text", "positive_reason", "negative_reason")


def quality(spark, folder):
    return sc.add_quality(postings(spark, folder), BOOK.quality)


@query("remote_quality", QUALITY + "SELECT seq, " + ", ".join(QUALITY_COLS) + " FROM ql")
def remote_quality(spark, folder):
    return quality(spark, folder).select("seq", *QUALITY_COLS)


@query("first_match_label", QUALITY + "SELECT seq, normalized_remote_category, country_restriction, employment_type FROM ql")
def first_match_label(spark, folder):
    df = postings(spark, folder)
    df = tx.settle(df, {"q": sc.quality_text(df)})
    text, rules = F.col("q"), BOOK.quality
    return df.select(
        "seq", tx.first_label(text, rules.categories, "Other").alias("normalized_remote_category"),
        cl.country_limit(text, F.col("location"), rules).alias("country_restriction"),
        tx.first_label(text, rules.employment, "").alias("employment_type"))


@query("salary_extract", QUALITY + "SELECT seq, salary_min, salary_max, currency, salary_text FROM ql")
def salary_extract(spark, folder):
    df = postings(spark, folder)
    df = tx.settle(df, {"q": sc.quality_text(df)})
    df = tx.settle(df, {"span": sc.money_span(F.col("q"))})
    return df.select("seq", *[c.alias(n) for n, c in sc.salary(df, F.col("span")).items()])


@query("student_score", NORM + "SELECT seq, student_score, profile_reason, matched_keyword FROM norm")
def student_score(spark, folder):
    return normalized(spark, folder).select("seq", "student_score", "profile_reason", "matched_keyword")


@query("candidate_score", NORM + f"SELECT seq, {r.candidate_sql()} AS candidate_score FROM n5")
def candidate_score(spark, folder):
    df = normalized(spark, folder)
    df = df.withColumn("_ntext", tx.profile_text(tx.join_fields(df, sc.PROFILE_FIELDS)))
    return df.select("seq", sc.candidate_score(df, BOOK.candidate).alias("candidate_score"))


@query("match_score", NORM + "SELECT seq, student_score, candidate_score, match_score FROM norm")
def match_score(spark, folder):
    return normalized(spark, folder).select("seq", "student_score", "candidate_score", "match_score")


REMOTE_NORM = r.run(r.norm_ctes("remote"), "")


@query("remote_score", REMOTE_NORM + "SELECT seq, category, remote_score_delta, candidate_score, remote_score, match_score FROM norm")
def remote_score(spark, folder):
    return normalized(spark, folder, "remote").select("seq", "category", "remote_score_delta", "candidate_score", "remote_score", "match_score")


@query("normalize_posting", NORM + """
SELECT seq, source, title, company, location, query, url, description, remote, remote_reason, part_time, category, score, location_fit, student_score, candidate_score,
 match_score, priority_bucket, found_at, neg AS negative_reason FROM norm""")
def normalize_posting(spark, folder):
    return normalized(spark, folder).select(
        "seq", "source", "title", "company", "location", "query", "url", "description", "remote", "remote_reason", "part_time", "category", "score",
        "location_fit", "student_score", "candidate_score", "match_score", "priority_bucket", "found_at", "negative_reason")


@query("rescore_postings", CLS + "SELECT seq, rtype AS result_type, student_score, candidate_score, match_score, remote FROM cls WHERE rtype = 'job'")
def rescore_postings(spark, folder):
    df = pj.normalize_posting(postings(spark, folder), BOOK, with_scores=False, now=now())
    survivors = fl.cleaned(jn.classify_results(df, BOOK.patterns, BOOK.clean), "strict", BOOK.clean)
    return pj.rescore(survivors, BOOK).select("seq", "result_type", "student_score", "candidate_score", "match_score", "remote")


@query("apply_priority", QUALITY + f"SELECT seq, CASE WHEN remote_score_delta >= 40 THEN 'HIGH' WHEN remote_score_delta >= 0 THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM ql")
def apply_priority(spark, folder):
    return quality(spark, folder).select("seq", cl.apply_priority(F.col("remote_score_delta"), 40, 0).alias("priority"))


@query("int_coerce", """
SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k, coalesce(TRY_CAST(event_type AS INTEGER), 0) AS bad,
 lower(trim(CASE WHEN event_type = 'view' THEN ' True' ELSE event_type END)) = 'true' AS flag FROM events""")
def int_coerce(spark, folder):
    df = table(spark, folder, "events")
    return df.select(
        "event_id", tx.to_int(F.get_json_object("props", "$.k")).alias("k"), tx.to_int(F.col("event_type")).alias("bad"),
        tx.to_flag(F.when(F.col("event_type") == "view", " True").otherwise(F.col("event_type"))).alias("flag"))


# --- weighted score --------------------------------------------------------------------------------

W = BOOK.weighted
TITLE, TEXT = "lower(title)", "lower(concat_ws(' ', title, company, location, description))"
_hit = lambda cond, n, reason: f"CASE WHEN {cond} THEN {{'n': {n}, 't': {s.q(reason)}}} END"
HITS = ", ".join(
    [_hit(s.has_word("wtext", p), n, f"+{n} {p}") for p, n in W.positive]
    + [_hit(" AND ".join(s.has_word("wtext", p) for p in ps), n, f"+{n} {reason}") for ps, n, reason in W.combos]
    + [_hit(s.has_word("wtext", p), n, f"{n} {p}") for p, n in W.negative])
BANNED = "list_filter([" + ", ".join(f"CASE WHEN {s.has_word(TITLE, p)} THEN {s.q(p)} END" for p in W.excluded_titles) + "], lambda x: x IS NOT NULL)"
BONUS = "CASE source " + " ".join(f"WHEN {s.q(k)} THEN {n}" for k, n in W.source_bonus.items()) + " ELSE 0 END"
_some = lambda c: f"CASE WHEN {c} <> '' THEN [{c}] ELSE CAST([] AS VARCHAR[]) END"
_texts = lambda c: f"list_transform({c}, lambda x: x['t'])"


def weighted_ctes(source: str) -> list[str]:
    return [
        f"w1 AS MATERIALIZED (SELECT *, {TEXT} AS wtext, {BANNED} AS banned FROM {source})",
        f"w2 AS MATERIALIZED (SELECT *, list_filter([{HITS}], lambda x: x IS NOT NULL) AS hits FROM w1)",
        f"""weighted AS MATERIALIZED (SELECT * EXCLUDE (hits, banned, wtext, positive_reason, negative_reason),
 CAST(CASE WHEN len(banned) > 0 THEN -100 ELSE {BONUS} + coalesce(list_sum(list_transform(hits, lambda x: x['n'])), 0) + remote_score_delta END AS INTEGER) AS job_score,
 CASE WHEN len(banned) > 0 THEN concat('excluded title: ', array_to_string(banned, ', ')) ELSE
  array_to_string(list_concat({_texts('hits')}, {_some('positive_reason')}, {_some('negative_reason')}), ', ') END AS score_reason,
 CASE WHEN len(banned) > 0 THEN positive_reason ELSE array_to_string(list_concat({_texts("list_filter(hits, lambda x: x['n'] >= 0)")}, {_some('positive_reason')}), '; ') END AS positive_reason,
 CASE WHEN len(banned) > 0 THEN concat('excluded title: ', array_to_string(banned, ', ')) ELSE
  array_to_string(list_concat({_texts("list_filter(hits, lambda x: x['n'] < 0)")}, {_some('negative_reason')}), '; ') END AS negative_reason FROM w2)""",
    ]


WEIGHTED = P("base AS (SELECT *, '' AS category FROM postings)", *r.quality_ctes("base", "ql"), *weighted_ctes("ql"))
WEIGHT_COLS = ("job_score", "score_reason", "positive_reason", "negative_reason")


def weighted(spark, folder):
    return sc.add_weighted_score(quality(spark, folder), W)


@query("weighted_keyword_score", WEIGHTED + "SELECT seq, " + ", ".join(
    f"coalesce({c}, '') AS {c}" if c != "job_score" else c for c in WEIGHT_COLS) + " FROM weighted")
def weighted_keyword_score(spark, folder):
    return weighted(spark, folder).select("seq", *WEIGHT_COLS)


MIN_SCORE = "CASE source " + " ".join(f"WHEN {s.q(k)} THEN {n}" for k, n in W.min_score_by_source.items()) + f" ELSE {W.default_min_score} END"


@query("min_score_by_source", WEIGHTED + f"SELECT seq, source, job_score FROM weighted WHERE job_score >= {MIN_SCORE}")
def min_score_by_source(spark, folder):
    return fl.min_score_by_source(weighted(spark, folder), W).select("seq", "source", "job_score")


@query("signal_or_category_filter", QUALITY + f"SELECT seq, normalized_remote_category FROM ql WHERE normalized_remote_category <> 'Other' OR {s.any_word(TEXT, W.signal_phrases)}")
def signal_or_category_filter(spark, folder):
    return fl.signal_or_category(quality(spark, folder), W).select("seq", "normalized_remote_category")


# --- filters --------------------------------------------------------------------------------------------

@query("community_phrase_filter", "SELECT doc_id FROM documents WHERE " + s.any_word("lower(text)", ["license", "the", "und der"]) + " AND " +
       s.any_word("lower(text)", ["mit", "only", "thing"]) + " AND NOT " + s.any_word("lower(text)", ["worthless", "of of", "[for hire]"]))
def community_phrase_filter(spark, folder):
    df = table(spark, folder, "documents")
    return fl.community_phrases(df, ["license", "the", "und der"], ["mit", "only", "thing"], ["worthless", "of of", "[for hire]"], ("text",)).select("doc_id")


RTEXT = "lower(concat_ws(' ', title, description))"


@query("region_phrase_filter", P() + f"SELECT seq FROM postings WHERE ({s.any_word(RTEXT, ['license', 'und'])} OR {s.any_word(RTEXT, ['free', 'para los'])}) "
       f"AND NOT {s.any_word(RTEXT, ['worthless', 'der die'])} AND {s.any_word('lower(location)', ['napoli', 'remote'])}")
def region_phrase_filter(spark, folder):
    return fl.region_phrases(postings(spark, folder), ["license", "und"], ["free", "para los"], ["worthless", "der die"], ["napoli", "remote"]).select("seq")


@query("bad_term_filter", P() + f"SELECT seq FROM postings WHERE NOT {s.any_of('lower(concat_ws(chr(32), title, description))', BOOK.posting.bad)}")
def bad_term_filter(spark, folder):
    return fl.without_bad_terms(postings(spark, folder), BOOK.posting, ("title", "description")).select("seq")


BLOCKED, PREFERRED = ("comune.napoli", "linkedin.com/jobs", "/q-"), ("indeed.", "talent.com", "src1")


@query("domain_block_and_tag", P() + f"""SELECT seq, url, CASE WHEN {s.any_of('lower(url)', PREFERRED)} THEN trim(concat(description, ' preferred_domain')) ELSE description END AS description
FROM postings WHERE NOT {s.any_of(f"lower(concat({s.part('url', 2)}, {s.part('url', 3)}))", BLOCKED)}""")
def domain_block_and_tag(spark, folder):
    return fl.block_and_mark_domains(postings(spark, folder), BLOCKED, PREFERRED).select("seq", "url", "description")


FTEXT = "lower(concat_ws(' ', title, company, location, description, query, url, source))"


@query("remote_only_filter", P() + f"SELECT seq FROM postings WHERE {s.any_of(FTEXT, BOOK.remote.keywords)} AND NOT {s.any_of(FTEXT, BOOK.remote.blockers)}")
def remote_only_filter(spark, folder):
    return fl.remote_only(postings(spark, folder), BOOK.remote).select("seq")


@query("location_fit_filter", NORM + "SELECT seq, location_fit FROM norm WHERE location_fit <> 'excluded_far' AND (location_fit <> 'unknown' OR remote)")
def location_fit_filter(spark, folder):
    return fl.drop_unknown_location(fl.drop_far(normalized(spark, folder))).select("seq", "location_fit")


C = BOOK.clean
HOST, LPATH, LTITLE = s.host("url"), f"lower({s.part('url', 3)})", "lower(trim(title))"
SOFT = "(" + " OR ".join(f"({HOST} = {s.q(h)} AND contains({LPATH}, {s.q(p)}))" for h, p in C.soft_pages) + ")"
SEEKS = s.any_of(f"lower(concat_ws(' ', {HOST}, {s.part('url', 3)}, title, '', description, '', ''))", C.seeks_work)
RAND = f"(prefix({LPATH}, '/offerte-lavoro/') AND NOT {s.any_of(LPATH, fv.RANDSTAD_SEARCH_PARTS)} AND len(list_filter(str_split({LPATH}, '/'), lambda x: x <> '')) >= 2)"
TRUST = (f"((utype = 'real_job' AND rtype = 'job') OR ({HOST} = 'lavoro.lidl.it' AND contains({LPATH}, '/punti-vendita/')) OR ({HOST} = 'randstad.it' AND {RAND}))")
MODES = f"""(utype = 'real_job' AND rtype = 'job') AS strict, (NOT {SEEKS} AND {TRUST}) AS email,
 (rtype = 'job' OR (rtype NOT IN ('article', 'profile', 'excluded_domain', 'unknown') AND {SOFT})) AS soft"""


def classified(spark, folder):
    return jn.classify_results(normalized(spark, folder), BOOK.patterns, BOOK.clean)


@query("clean_mode_filter", CLS + f", m AS (SELECT seq, {MODES} FROM cls) SELECT seq, strict, email, soft FROM m WHERE strict OR email OR soft")
def clean_mode_filter(spark, folder):
    df = classified(spark, folder)
    modes = df.select("seq", *[cl.keep_by_mode(df, m, C).alias(m) for m in ("strict", "email", "soft")])
    return modes.filter("strict or email or soft")


@query("trusted_page_predicates", CLS + f"SELECT seq, {SOFT} AS soft_page, {SEEKS} AS seeks_work, {TRUST} AS mail_page, {RAND} AS vacancy_path FROM cls")
def trusted_page_predicates(spark, folder):
    df = classified(spark, folder)
    return df.select("seq", cl.soft_trusted(df, C).alias("soft_page"), cl.seeks_work_page(df, C).alias("seeks_work"),
                     cl.mail_trusted(df, C).alias("mail_page"), cl.vacancy_page_rules(df, C)["randstad.it"].alias("vacancy_path"))


SITE = "CASE WHEN contains(url, 'indeed') THEN 'indeed' WHEN contains(url, 'randstad') THEN 'randstad' WHEN contains(url, 'talent') THEN 'talent' WHEN contains(url, 'gigroup') THEN 'gigroup' WHEN contains(url, 'subito') THEN 'subito' WHEN contains(url, 'jooble') THEN 'jooble' WHEN contains(url, 'adecco') THEN 'adecco' ELSE 'none' END"
DETAIL = f"""CASE site WHEN 'indeed' THEN contains(url, 'it.indeed.com') AND {s.any_of('url', ['/viewjob', '/rc/clk', 'jk='])}
 WHEN 'subito' THEN contains(url, 'subito.it') AND contains(url, '/offerte-lavoro/') AND suffix(url, '.htm')
 WHEN 'randstad' THEN contains(url, 'randstad.it') AND contains(url, '/offerte-lavoro/') AND NOT {s.any_of('url', fv.RANDSTAD_SEARCH_PARTS)} AND contains({s.part('url', 3)}, '_')
   AND len(list_filter(str_split({s.part('url', 3)}, '/'), lambda x: x <> '')) >= 2
 WHEN 'adecco' THEN contains(url, 'adecco.it') AND rtrim({LPATH}, '/') NOT IN ('', '/lavoro', '/lavora-con-noi') AND NOT regexp_matches({LPATH}, '^/(offerte-lavoro|jobs)')
   AND ({s.any_of(LPATH, ['/offerta/', '/job-offer/'])} OR (contains({LPATH}, '/lavoro/') AND (contains({LPATH}, '_') OR regexp_matches({LPATH}, '/[0-9]+/?$'))))
 WHEN 'jooble' THEN {HOST} IN ('jooble.org', 'it.jooble.org') AND contains({LPATH}, '/jdp/')
 WHEN 'talent' THEN {HOST} IN ('talent.com', 'it.talent.com') AND rtrim({s.part('url', 3)}, '/') = '/view' AND contains(lower({s.part('url', 4)}), 'id=')
 WHEN 'gigroup' THEN contains(url, 'gigroup.it') AND (regexp_matches({LPATH}, '^/offerte-lavoro-dettaglio/[^/]+/([0-9]+|a[0-9]+)/?$') OR contains({LPATH}, '/annunci/'))
 ELSE false END"""


@query("detail_url_predicates", P(s.canon_ctes(), f"u AS (SELECT seq, curl AS url, {SITE.replace('url', 'curl')} AS site FROM canon)") + f"SELECT seq, site, {DETAIL} AS is_detail FROM u")
def detail_url_predicates(spark, folder):
    df = postings(spark, folder).select("seq", urls.canonical_url(F.col("url")).alias("url"))
    site = F.expr(SITE)
    typed = df.withColumn("site", site)
    return typed.select("seq", "site", cl.detail_url(F.col("site"), F.col("url")).alias("is_detail"))


# --- mail cleaning ---------------------------------------------------------------------------------------

M = BOOK.mail
MTEXT = "concat_ws(' ', " + ", ".join(s.squeeze(f"lower({c})") for c in ("title", "company", "location", "description", "''", "url", "source")) + ")"
MTITLE, MPATH, MKEYS = s.squeeze("lower(title)"), f"rtrim({LPATH}, '/')", s.query_keys("url")
SEARCHING = f"list_has_any({MKEYS}, {s.arr(M.query_keys)})"
LISTING = f"""({s.any_of(MPATH, M.path_terms)} OR ((""" + " OR ".join(f"{MPATH} = {s.q(p)} OR prefix({MPATH}, {s.q(p + '/')})" for p in M.root_paths) + f""") AND ({SEARCHING} OR len({MKEYS}) >= 3))
 OR contains({MPATH}, '/q-') OR ({SEARCHING} AND {s.any_of(HOST, M.host_marks)}))"""
MAIL_REASON = f"""CASE WHEN ((""" + " OR ".join(f"prefix({MTITLE}, {s.q(p)})" for p in M.title_prefixes) + f""") AND contains({MTITLE}, ' job')) OR {s.any_of(MTEXT, M.phrases)}
 OR {s.any_of(MTITLE, ['remote jobs', 'jobs in '])} OR {LISTING} THEN 'search_page'
 WHEN {s.any_of(MTITLE, M.mismatch)} AND NOT {s.any_of(MTITLE, M.target)} THEN 'language_mismatch' ELSE '' END"""


@query("listing_page_rejection", P() + f"SELECT seq, {MAIL_REASON} AS reason FROM postings")
def listing_page_rejection(spark, folder):
    df = postings(spark, folder)
    return df.select("seq", cl.mail_rejection(df, M).alias("reason"))


SUMMARY = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {s.any_of('mt', t)} THEN {s.q(n)} END" for n, t in M.summary) + "], lambda x: x IS NOT NULL), ', ')"


@query("remote_match_summary", P(f"m AS (SELECT seq, {MTEXT} AS mt FROM postings)") + f"SELECT seq, {SUMMARY} AS summary FROM m")
def remote_match_summary(spark, folder):
    df = postings(spark, folder)
    return df.select("seq", F.array_join(cl.match_summary(df, M), ", ").alias("summary"))


@query("email_clean_stats", P(f"m AS (SELECT {MAIL_REASON} AS reason FROM postings)") + """
SELECT CAST(count(*) FILTER (reason <> '') AS BIGINT) AS quality_rejected, CAST(count(*) FILTER (reason = 'search_page') AS BIGINT) AS rejected_search_pages,
 CAST(count(*) FILTER (reason = 'language_mismatch') AS BIGINT) AS rejected_language_mismatch, CAST(0 AS BIGINT) AS rejected_low_quality FROM m""")
def email_clean_stats(spark, folder):
    from siftworks.operators import aggregates as ag
    df = postings(spark, folder)
    reasoned = df.select(cl.mail_rejection(df, M).alias("reason"))
    return ag.mail_clean_stats(reasoned, F.col("reason"))
