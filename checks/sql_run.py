"""SQL of the labelled, classified and history-annotated postings."""

from __future__ import annotations

from checks import sql as s
from checks.corpus import BOOK, NOW
from siftworks.rules import fixed_values as fv

B = BOOK
EMPTY10 = ", ".join(["''"] * 9)
SNIPPET = f"concat_ws(' ', description, {EMPTY10}, company, location, url)"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def remote_sql(fields) -> tuple[str, str]:
    blocked = "coalesce(" + ", ".join(s.first_of(f"lower({v})", B.posting.not_remote) for _, v in fields) + ")"
    found = "coalesce(" + ", ".join(
        
        f"CASE WHEN {s.first_of(f'lower({v})', B.posting.remote)} IS NOT NULL THEN concat({s.q(n + ': ')}, {s.first_of(f'lower({v})', B.posting.remote)}) END"
        for n, v in fields) + ")"
    flag = f"({blocked} IS NULL AND {found} IS NOT NULL)"
    reason = f"CASE WHEN {blocked} IS NOT NULL THEN concat('negative: ', {blocked}) WHEN {found} IS NOT NULL THEN {found} ELSE 'none' END"
    return flag, reason


def category_sql(text: str) -> str:
    p = B.posting
    rest = s.label_of(text, [*p.categories, ("ecommerce", p.ecommerce), ("remote_data", p.remote), ("part_time", p.part_time)], "'other'")
    return (f"CASE WHEN {s.any_of(text, p.ai)} THEN 'ai_annotation' WHEN {s.any_of(text, p.data)} AND "
            f"({s.any_of(text, p.data_guard)} OR NOT {s.any_of(text, p.generic_office)}) THEN 'data_entry' ELSE {rest} END")


def base_score_sql(text: str) -> str:
    p = B.posting
    groups = dict(part_time=p.part_time, local=p.local, data=p.data, remote=p.remote, ai=p.ai, ecommerce=p.ecommerce, bad=p.bad)
    return s.points_of(text, [(groups[k], n) for k, n in p.points.items()])


def bucket_sql(text: str) -> str:
    local = s.any_of(text, B.posting.local)
    return (f"CASE WHEN part_time AND {local} THEN 'campania_part_time' WHEN remote THEN 'remote_data' "
            f"WHEN {local} THEN 'local_general' ELSE 'other' END")


def location_sql(place: str, remote: str = "remote") -> str:
    t = s.profile_text(place)
    return (f"CASE WHEN {remote} THEN 'remote' WHEN {s.any_of(t, s.profile_terms(B.student.allowed_locations))} THEN 'allowed_local' "
            f"WHEN {s.any_of(t, s.profile_terms(B.student.excluded_locations))} THEN 'excluded_far' ELSE 'unknown' END")


def student_sql() -> dict[str, str]:
    """Columns over a table with ptext, title, category, remote, part_time, location_fit."""
    r, title = B.student, s.profile_text("title")
    first = lambda terms: "CASE " + " ".join(f"WHEN contains({title}, {s.q(n)}) THEN {s.q(t)}" for t, n in zip(terms, s.profile_terms(terms))) + " END"
    kind = "CASE lower(category) " + " ".join(f"WHEN {s.q(a)} THEN {s.q(b)}" for a, b in r.aliases.items()) + " ELSE lower(category) END"
    cats = " + ".join(
        f"CASE WHEN {kind} = {s.q(c)} OR {s.any_of('ptext', r.category_terms.get(c, ()))} THEN {n} ELSE 0 END" for c, n in r.category_points.items())
    score = (f"(50 + CASE WHEN remote THEN 30 ELSE 0 END + CASE WHEN remote AND contains(ptext, 'full remote') THEN 30 ELSE 0 END "
             f"+ CASE WHEN part_time OR contains(ptext, 'part time') OR contains(ptext, 'part-time') THEN 25 ELSE 0 END "
             f"+ {s.points_of('ptext', [((k,), n) for k, n in r.location_points.items()])} "
             f"+ {s.points_of('ptext', [((k,), n) for k, n in r.keyword_points.items()])} + {cats} "
             f"+ CASE WHEN preferred IS NOT NULL THEN 7 ELSE 0 END)")
    capped = f"CASE location_fit WHEN 'excluded_far' THEN least({score}, 40) WHEN 'unknown' THEN least({score}, 70) ELSE {score} END"
    return {"unwanted": first(r.unwanted_titles), "preferred": first(r.preferred_titles),
            "student_score": f"CAST(CASE WHEN unwanted IS NOT NULL THEN 0 ELSE greatest(0, least(100, {capped})) END AS INTEGER)"}


def candidate_sql() -> str:
    r = B.candidate
    kind = "CASE lower(category) " + " ".join(f"WHEN {s.q(c)} THEN {n}" for c, n in r.category_points.items()) + " ELSE 0 END"
    score = (f"(50 + {kind} + {s.points_of('ntext', [(s.profile_terms(t), n) for t, n in r.groups])} "
             f"+ CASE WHEN part_time OR {s.any_of('ntext', s.profile_terms(r.part_time))} THEN 10 ELSE 0 END)")
    low = f"list_contains({s.arr(r.low_fit)}, lower(category)) AND NOT (lower(category) = 'technical' AND NOT {s.any_of('ntext', s.profile_terms(r.specialist))})"
    return f"CAST(greatest(0, least(100, CASE WHEN {low} THEN least({score}, 60) ELSE {score} END)) AS INTEGER)"


# --- quality labels -------------------------------------------------------------------------

SALARY_RX = (r"(?i)(€|\$|£|eur|usd|gbp)\s*(\d[\d,\. ]{2,})"
             r"(?:\s*(?:-|–|to|/)\s*(?:€|\$|£|eur|usd|gbp)?\s*(\d[\d,\. ]{2,}))?")


def quality_ctes(source: str, name: str) -> list[str]:
    """CTEs adding the quality columns to a table with title, company, location, description, category, query."""
    r = B.quality
    q1 = (f"{name}_q1 AS MATERIALIZED (SELECT *, {s.squeeze(chr(10).join(['lower(concat_ws(chr(32), title, company, location, description, category, query))']))} AS qtext FROM {source})")
    money = lambda g: f"nullif(CAST(floor(TRY_CAST(regexp_replace(regexp_extract(qtext, {s.q(SALARY_RX)}, {g}), '[, ]', '', 'g') AS DOUBLE)) AS INTEGER), 0)"
    country = "CASE " + " ".join(
        f"WHEN {s.any_of('qtext', t)} OR {s.any_of('lower(location)', t)} THEN {s.q(c)}" for c, t in r.countries) + \
        " WHEN lower(location) IN ('remote', 'worldwide', 'anywhere') THEN 'Worldwide' ELSE '' END"
    points = "CASE country_restriction " + " ".join(f"WHEN {s.q(c)} THEN {n}" for c, n in r.country_points.items()) + " ELSE 0 END"
    q2 = (f"{name}_q2 AS MATERIALIZED (SELECT *, {country} AS country_restriction, {money(2)} AS salary_min, coalesce({money(3)}, {money(2)}) AS salary_max, "
          f"lower(regexp_extract(qtext, {s.q(SALARY_RX)}, 1)) AS sym, regexp_extract(qtext, {s.q(SALARY_RX)}, 0) AS salary_text FROM {name}_q1)")

    def hits(rules):
        rows = []
        for label, terms, n in rules:
            found = s.matched("qtext", terms)
            sign = "+" if n >= 0 else ""
            rows.append(f"CASE WHEN len({found}) > 0 THEN {{'n': {n}, 't': concat({s.q(f'{sign}{n} {label}: ')}, array_to_string({found}[1:3], ', '))}} END")
        return "[" + ", ".join(rows) + "]"
    note = "concat(CASE WHEN cpoints > 0 THEN '+' ELSE '' END, cpoints, ' country: ', country_restriction)"
    q3 = f"{name}_q3 AS MATERIALIZED (SELECT *, {points} AS cpoints FROM {name}_q2)"
    plus = f"list_concat({hits(r.positive)}, [CASE WHEN cpoints > 0 THEN {{'n': cpoints, 't': {note}}} END, CASE WHEN salary_min IS NOT NULL THEN {{'n': 5, 't': '+5 salary present'}} END])"
    minus = f"list_concat([CASE WHEN cpoints < 0 THEN {{'n': cpoints, 't': {note}}} END], {hits(r.negative)})"
    q4 = (f"{name}_q4 AS MATERIALIZED (SELECT *, list_filter({plus}, lambda x: x IS NOT NULL) AS plus, list_filter({minus}, lambda x: x IS NOT NULL) AS minus FROM {name}_q3)")
    text = lambda c: f"coalesce(array_to_string(list_transform({c}, lambda x: x['t']), '; '), '')"
    total = lambda c: f"coalesce(list_sum(list_transform({c}, lambda x: x['n'])), 0)"
    currency = "CASE sym " + " ".join(f"WHEN {s.q(a)} THEN {s.q(b)}" for a, b in fv.CURRENCY_CODES.items()) + " ELSE upper(sym) END"
    q5 = (f"{name} AS MATERIALIZED (SELECT * EXCLUDE (qtext, sym, cpoints, plus, minus, salary_text), CAST({total('plus')} + {total('minus')} AS INTEGER) AS remote_score_delta, "
          f"{s.label_of('qtext', r.categories, chr(39) + 'Other' + chr(39))} AS normalized_remote_category, "
          f"{s.label_of('qtext', r.employment, chr(39) * 2)} AS employment_type, {currency} AS currency, salary_text, "
          f"{text('plus')} AS positive_reason, {text('minus')} AS negative_reason FROM {name}_q4)")
    return [q1, q2, q3, q4, q5]


# --- normalised postings -------------------------------------------------------------------------

def norm_ctes(profile: str = "local_student") -> list[str]:
    """CTEs ending in ``norm``: postings with canonical URL, labels and scores."""
    flag, reason = remote_sql([("title", "title"), ("description", "description"), ("snippet", "body"), ("location", "location"), ("url", "curl")])
    ctes = [
        s.canon_ctes(),
        f"n1 AS MATERIALIZED (SELECT *, {SNIPPET} AS body, lower(concat_ws(' ', title, {SNIPPET})) AS ltext FROM canon)",
        f"n2 AS MATERIALIZED (SELECT *, lower(concat_ws(' ', title, body, '')) AS search, {flag} AS remote, {reason} AS remote_reason, {s.any_of('ltext', B.posting.part_time)} AS part_time, "
        f"{category_sql('ltext')} AS category, CAST({base_score_sql('ltext')} AS INTEGER) AS score FROM n1)",
        "n3 AS MATERIALIZED (SELECT * EXCLUDE (url, curl, body, ltext), curl AS url FROM n2)",
    ]
    last = "n3"
    if profile == "remote":
        ctes += quality_ctes("n3", "n3q")
        ctes.append("n3r AS MATERIALIZED (SELECT * EXCLUDE (category), CASE WHEN normalized_remote_category NOT IN ('', 'Other') THEN normalized_remote_category ELSE category END AS category FROM n3q)")
        last = "n3r"
    student = student_sql()
    negative = "negative_reason" if profile == "remote" else "''"
    exclude = " EXCLUDE (negative_reason)" if profile == "remote" else ""
    remote_text = "lower(concat_ws(' ', title, company, location, description, query, url, source))"
    if profile == "remote":
        remote_score = f"CAST(CASE WHEN unwanted IS NOT NULL THEN 0 ELSE candidate_score + {s.points_of(remote_text, B.remote.groups)} + remote_score_delta END AS INTEGER)"
        match = "CAST(round_even(0.8::DOUBLE * candidate_score + 0.2::DOUBLE * remote_score, 0) AS INTEGER)"
    else:
        remote_score, match = "0", "CAST(round_even(0.45::DOUBLE * student_score + 0.55::DOUBLE * candidate_score, 0) AS INTEGER)"
    ctes += [
        f"n4 AS MATERIALIZED (SELECT *, {location_sql('concat_ws(chr(32), location, title, url)')} AS location_fit, "
        f"lower(concat_ws(' ', title, company, location, url, category, description, '', '')) AS ptext FROM {last})",
        f"n5 AS MATERIALIZED (SELECT *, {s.profile_text('ptext')} AS ntext, {student['unwanted']} AS unwanted, {student['preferred']} AS preferred FROM n4)",
        f"n6 AS MATERIALIZED (SELECT *, {student['student_score']} AS student_score, "
        f"CASE WHEN unwanted IS NOT NULL THEN 0 ELSE {candidate_sql()} END AS candidate_score FROM n5)",
        f"n7 AS MATERIALIZED (SELECT *, {remote_score} AS remote_score FROM n6)",
        f"norm AS MATERIALIZED (SELECT * EXCLUDE (ptext, ntext, search){'' if profile != 'remote' else ''}, CASE WHEN unwanted IS NOT NULL THEN 0 ELSE {match} END AS match_score, "
        f"CASE WHEN unwanted IS NOT NULL THEN 'unwanted_title' WHEN preferred IS NOT NULL THEN 'preferred_title' ELSE '' END AS profile_reason, "
        f"coalesce(unwanted, preferred, '') AS matched_keyword, "
        f"CASE WHEN unwanted IS NOT NULL THEN 'excluded title unwanted_title' ELSE {negative} END AS neg, "
        f"CASE WHEN unwanted IS NOT NULL THEN 'unwanted_title' ELSE '' END AS selection_rejection_reason, "
        f"{bucket_sql('search')} AS priority_bucket FROM n7)",
    ]
    return ctes


# --- result type ----------------------------------------------------------------------------------

def result_type_sql() -> str:
    """Over a table with utype, url, title, description."""
    r, title, body, path = B.clean, "lower(trim(title))", "lower(concat_ws(' ', '', description, '', ''))", f"lower({s.part('url', 3)})"
    article = s.any_of("lower(concat_ws(' ', title, '', description, '', ''))", r.article)
    searching = (f"(list_contains({s.query_keys('url')}, 'q') OR contains({path}, '/search') OR "
                 f"({s.part('url', 4)} <> '' AND (suffix({path}, '/jobs') OR suffix({path}, '/offerte'))))")
    starts = "(" + " OR ".join(f"prefix({title}, {s.q(p)})" for p in r.listing_titles) + ")"
    return (f"CASE WHEN {article} THEN 'article' WHEN utype = 'real_job' THEN 'job' WHEN utype IN ({', '.join(s.q(t) for t in fv.REMOVED_URL_TYPES)}) THEN utype "
            f"WHEN {searching} THEN 'search_page' WHEN contains({path}, '/cerca') THEN 'category_page' WHEN {starts} THEN 'aggregator_page' "
            f"WHEN {s.any_of(body, r.aggregator)} THEN 'aggregator_page' ELSE 'unknown' END")


def classified_ctes(profile: str = "local_student") -> list[str]:
    """norm plus utype, upattern, rtype in ``cls``."""
    return norm_ctes(profile) + [s.url_type_ctes(B.patterns, "norm", "cls_t"),
                                 f"cls AS MATERIALIZED (SELECT *, {result_type_sql()} AS rtype FROM cls_t)"]


# --- identity and history ------------------------------------------------------------------------------

def json_list(parts) -> str:
    return "CAST(to_json([" + ", ".join(f"lower({strip(p)})" for p in parts) + "]) AS VARCHAR)"


JOB_ID = "sha256(" + json_list(["CASE WHEN url <> '' THEN url ELSE concat_ws('|', source, title, company, location) END"]) + ")"
CONTENT = "sha256(" + json_list(["title", "company", "location", "category", "description", "''", "''", "''", "''", "''", "''", "''",
                                  "CASE WHEN part_time THEN 'true' ELSE '' END", "''", "url"]) + ")"
DEDUP_KEY = "CASE WHEN url <> '' THEN url ELSE concat_ws('|', lower(trim(title)), lower(trim(company)), lower(trim(location))) END"


def identity_ctes(source: str = "cls") -> list[str]:
    return [f"ids AS MATERIALIZED (SELECT *, {JOB_ID} AS job_id, {CONTENT} AS content_hash, {DEDUP_KEY} AS dkey FROM {source})"]


def history_ctes(source: str = "ids") -> list[str]:
    return [
        "marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id)",
        f"history AS MATERIALIZED (SELECT job_id, url, title, source, '2026-05-01T00:00:00Z' AS first_seen, "
        f"strftime(DATE '{NOW[:10]}' - CAST(n_chars % 20 AS INTEGER), '%Y-%m-%dT06:00:00Z') AS last_seen, "
        f"CASE WHEN quality = 0 THEN '' ELSE strftime(DATE '{NOW[:10]}' - CAST(n_chars % 20 AS INTEGER), '%Y-%m-%dT06:00:00Z') END AS last_sent, "
        f"CAST(CASE WHEN quality = 0 THEN 0 ELSE 1 + n_chars % 3 END AS INTEGER) AS sent_count, "
        f"CASE WHEN toxic = 1 THEN 'changed' ELSE content_hash END AS content_hash, match_score, n_chars % 20 AS age "
        f"FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY seq) AS rn FROM {source} JOIN marks ON seq = doc_id) WHERE rn = 1)",
    ]


# now is 12:00 and rows were sent at 06:00, so a row sent n calendar days ago is n days old.
ANNOTATE = """SELECT d.*, h.job_id IS NOT NULL AS known, coalesce(h.last_sent, '') AS last_sent, coalesce(h.sent_count, 0) AS sent_count,
 CASE WHEN h.job_id IS NOT NULL THEN h.first_seen ELSE d.found_at END AS first_seen,
 CASE WHEN h.job_id IS NOT NULL THEN h.last_seen ELSE d.found_at END AS last_seen,
 CASE WHEN coalesce(h.last_sent, '') <> '' THEN CAST(h.age AS INTEGER) END AS days_since_last_sent,
 CASE WHEN h.job_id IS NULL THEN 'NEW' WHEN h.content_hash <> d.content_hash THEN 'UPDATED'
      WHEN h.last_sent <> '' AND h.age >= 7 THEN 'RESURFACED' ELSE 'SEEN' END AS history_status,
 coalesce(h.sent_count > 0 AND h.last_sent <> '' AND h.age >= 7, false) AS rotation_eligible
 FROM {source} d LEFT JOIN history h USING (job_id)"""


def annotated_ctes() -> list[str]:
    """Deduplicated, classified, history-annotated postings in ``ann``."""
    return classified_ctes() + identity_ctes() + history_ctes() + [
        "uniq AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dkey ORDER BY seq) AS drn FROM ids) WHERE drn = 1)",
        "ann_1 AS MATERIALIZED (" + ANNOTATE.format(source="uniq") + ")",
        "ann AS MATERIALIZED (SELECT *, (location_fit = 'excluded_far' OR (location_fit = 'unknown' AND NOT remote)) AS loc_rej, "
        "(unwanted IS NOT NULL OR contains(neg, 'country') OR contains(neg, 'seniority') OR contains(neg, 'excluded title')) AS prof_rej, "
        "(sent_count = 0 OR last_sent = '') AS never_sent FROM ann_1)",
    ]


def run(ctes: list[str], select: str) -> str:
    return s.with_postings(*ctes) + select


STATUS_RANK = "CASE history_status WHEN 'NEW' THEN 0 WHEN 'UPDATED' THEN 1 WHEN 'RESURFACED' THEN 2 WHEN 'SEEN' THEN 3 ELSE 4 END"
SCORE_ORDER = "match_score DESC, student_score DESC, candidate_score DESC, score DESC, seq"
BUCKET = ("CASE WHEN history_status = 'NEW' THEN 0 WHEN history_status = 'UPDATED' THEN 1 WHEN never_sent THEN 2 "
          "WHEN history_status = 'RESURFACED' THEN 3 END")


def selected_ctes(target: int = 50, min_match: int = 50) -> list[str]:
    """Bucketed selection in ``sel`` (with selection_reason)."""
    return annotated_ctes() + [
        f"sel_1 AS (SELECT *, {BUCKET} AS bucket FROM ann WHERE match_score >= {min_match} AND NOT loc_rej AND NOT prof_rej)",
        f"sel_2 AS (SELECT *, row_number() OVER (PARTITION BY dkey ORDER BY bucket, {STATUS_RANK}, {SCORE_ORDER}) AS krn FROM sel_1 WHERE bucket IS NOT NULL)",
        f"sel AS MATERIALIZED (SELECT *, (['NEW','UPDATED','NEVER_SENT_FILL','RESURFACED'])[bucket + 1] AS selection_reason FROM sel_2 WHERE krn = 1 "
        f"ORDER BY bucket, {STATUS_RANK}, {SCORE_ORDER} LIMIT {target})",
    ]


REJECTION = ("CASE WHEN {selected} THEN 'selected' WHEN loc_rej THEN 'location_rejected' WHEN prof_rej THEN 'profile_rejected' "
             "WHEN match_score < {min_match} THEN 'low_match' WHEN history_status = 'SEEN' AND NOT never_sent THEN 'seen_recently' "
             "WHEN NOT (history_status IN ('NEW', 'UPDATED', 'RESURFACED') OR never_sent) THEN 'no_selection_bucket' "
             "ELSE 'not_selected_due_to_limit' END")


def marked_ctes(target: int = 50, min_match: int = 50) -> list[str]:
    """Selection written back to all rows in ``marked``."""
    return selected_ctes(target, min_match) + [
        "marked AS MATERIALIZED (SELECT a.* EXCLUDE (selection_rejection_reason), coalesce(x.selection_reason, '') AS selection_reason, "
        + REJECTION.format(selected="x.dkey IS NOT NULL", min_match=min_match) + " AS selection_rejection_reason, x.dkey IS NOT NULL AS picked "
        "FROM ann a LEFT JOIN (SELECT DISTINCT dkey, selection_reason FROM sel) x USING (dkey))"]
