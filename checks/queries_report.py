"""Score report, report data and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as s, sql_run as r
from checks.corpus import BOOK, NOW
from checks.queries_rules import MAIL_REASON, MIN_SCORE, TEXT, W, weighted_ctes
from checks.queries_state import RANKED, SMALL, small_history, stats_tables
from checks.registry import query
from checks.views import annotated, history, normalized, now, postings, table
from siftworks.functions import classify as cl, reasons as rs, text as tx
from siftworks.operators import aggregates as ag, projections as pj, selection as sel
from siftworks.plans import curation, score_report as plan
from siftworks.rules import fixed_values as fv
from siftworks.session import cut

# --- weighted report ----------------------------------------------------------

PRIORITY = f"CASE WHEN job_score >= {W.high} THEN 'HIGH' WHEN job_score >= {W.medium} THEN 'MEDIUM' ELSE 'LOW' END"
SCORED = [
    "u1 AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS r1 FROM postings)",
    "u2 AS MATERIALIZED (SELECT *, '' AS category FROM (SELECT *, row_number() OVER (PARTITION BY source, title, company ORDER BY seq) AS r2 FROM u1 WHERE r1 = 1) WHERE r2 = 1)",
    *r.quality_ctes("u2", "ql"),
    f"sg AS MATERIALIZED (SELECT *, (normalized_remote_category <> 'Other' OR {s.any_word(TEXT, W.signal_phrases)}) AS signal FROM ql)",
    *weighted_ctes("sg"),
    f"scored AS MATERIALIZED (SELECT *, {PRIORITY} AS apply_priority FROM weighted WHERE signal AND job_score >= {MIN_SCORE})",
    f"top AS MATERIALIZED (SELECT *, {RANKED.format(o='job_score DESC, seq')} FROM scored WHERE job_score >= {W.top_min_score} ORDER BY job_score DESC, seq LIMIT {W.top_limit})",
]
SC = s.with_postings(*SCORED)


@query("score_report", SC + "SELECT rank, seq, source, title, company, location, url, job_score, apply_priority, score_reason FROM top")
def score_report(spark, folder):
    return plan.score_report(postings(spark, folder), BOOK).select(
        "rank", "seq", "source", "title", "company", "location", "url", "job_score", "apply_priority", "score_reason")


@query("score_sort", SC + "SELECT seq, job_score, apply_priority FROM scored")
def score_sort(spark, folder):
    rows = plan.scored_rows(postings(spark, folder), BOOK)
    return rows.orderBy(F.col("job_score").desc(), "seq").select("seq", "job_score", "apply_priority")


@query("top_report", SC + "SELECT rank, seq, job_score FROM top")
def top_report(spark, folder):
    top = sel.top_report(plan.scored_rows(postings(spark, folder), BOOK), W)
    return sel.rank_rows(top, [F.col("job_score").desc(), F.col("seq")]).select("rank", "seq", "job_score")


@query("priority_counts", SC + "SELECT l.apply_priority, count(t.seq) AS n FROM (SELECT unnest(['HIGH', 'MEDIUM', 'LOW']) AS apply_priority) l LEFT JOIN top t USING (apply_priority) GROUP BY l.apply_priority")
def priority_counts(spark, folder):
    return ag.priority_counts(plan.score_report(postings(spark, folder), BOOK))


@query("top_score_stats", SC + "SELECT coalesce(min(job_score), 0) AS min, coalesce(max(job_score), 0) AS max, coalesce(round_even(avg(job_score), 2), 0.0) AS average FROM top")
def top_score_stats(spark, folder):
    return ag.score_stats(plan.score_report(postings(spark, folder), BOOK))


# --- report data -------------------------------------------------------------------

R = BOOK.report
RT = "lower(concat_ws(' ', title, company, location, category, '', description, query, source))"
KIND = "lower(category)"
topic = lambda cats, terms: f"(list_contains({s.arr(cats)}, {KIND}) OR {s.any_of('rt', terms)})"
BLOCK = f"""CASE WHEN priority_bucket = 'campania_part_time' OR (part_time AND {s.any_of('rt', R.local)}) THEN 'Campania part-time' WHEN {topic(fv.REPORT_HOSPITALITY_CATEGORIES, R.hospitality)} THEN 'Hospitality / Hotel / Restaurant'
 WHEN {topic(('cleaning', 'pulizie'), R.cleaning)} THEN 'Cleaning / Pulizie' WHEN {topic(('maintenance', 'manutenzione'), R.maintenance)} THEN 'Maintenance / Manutenzione' WHEN {topic(('warehouse', 'gdo', 'logistics'), R.warehouse)} THEN 'Warehouse / GDO'
 WHEN priority_bucket = 'remote_data' OR remote OR {topic(('ai_data', 'data_entry', 'remote'), R.remote)} THEN 'Remote / Data / AI' ELSE 'Other' END"""
REMOTE_BLOCK = s.label_of("rt", [("AI Training", R.ai), ("Data", R.data), ("Logistics", R.logistics), ("Transcription", R.transcription), ("Virtual Assistant", R.assistant)], "'Other'")
LEVEL = f"""CASE WHEN selection_rejection_reason NOT IN ('', 'selected') THEN 'skip' WHEN history_status = 'SEEN' THEN 'skip'
 WHEN match_score >= 75 AND location_fit IN ('allowed_local', 'remote') AND NOT (location_fit = 'excluded_far' OR {s.any_of('rt', R.hard_risk)}) THEN 'apply_today'
 WHEN match_score >= 68 THEN 'good' WHEN match_score >= 58 THEN 'consider' WHEN match_score > 0 THEN 'watch' ELSE 'skip' END"""
CV = f"""CASE WHEN {topic(fv.REPORT_AI_CATEGORIES, R.ai)} THEN 'AI / Data Annotation CV' WHEN {topic(fv.REPORT_ENTRY_CATEGORIES, R.entry)} THEN 'Data Entry CV' WHEN {topic(fv.REPORT_RECEPTION_CATEGORIES, R.reception)} THEN 'Back Office / Reception CV'
 WHEN {topic(fv.REPORT_OFFICE_CATEGORIES, R.office)} THEN 'Back Office CV' WHEN {topic(fv.REPORT_STOCK_CATEGORIES, R.stock)} THEN 'Logistics CV' WHEN {topic(fv.REPORT_HOSPITALITY_CATEGORIES, R.hospitality)} THEN 'Hospitality CV'
 WHEN {topic(fv.REPORT_RETAIL_CATEGORIES, R.retail)} THEN 'Retail / GDO CV' ELSE 'Generic CV' END"""
LETTER = "CASE cv " + " ".join(f"WHEN {s.q(a)} THEN {s.q(b)}" for a, b in fv.LETTER_BY_CV.items()) + " END"
PT = f"(part_time OR {s.any_of('rt', R.part_time)})"
L, K = fv.FIT_LABELS, fv.RISK_LABELS
PLACE = "CASE " + " ".join(f"WHEN contains(rt, {s.q(t)}) THEN {s.q(v)}" for t, v in R.places) + f" ELSE {s.q(fv.REPORT_LOCAL_REASON)} END"
_items = lambda pairs: "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {v} END" for c, v in pairs) + "], lambda x: x IS NOT NULL)"
FITS = _items([("location_fit = 'allowed_local'", PLACE), ("location_fit = 'remote' OR remote", s.q(L["remote"])), (PT, s.q(L["part_time"])), (PT, s.q(L["study"])), (s.any_of("rt", R.schedule), s.q(L["schedule"])),
               (topic(fv.REPORT_ENTRY_CATEGORIES, R.entry), s.q(L["entry"])), (topic(fv.REPORT_OFFICE_CATEGORIES, R.office), s.q(L["office"])), (topic(fv.REPORT_STOCK_CATEGORIES, R.stock), s.q(L["stock"])),
               (topic(fv.REPORT_HOSPITALITY_CATEGORIES, R.hospitality), s.q(L["hospitality"])), (topic(fv.REPORT_AI_CATEGORIES, R.ai), s.q(L["ai"])), (f"NOT {s.any_of('rt', R.degree)}", s.q(L["degree"]))])
RISKS = _items([(f"NOT {PT}", s.q(K["hours"])), (s.any_of("rt", R.language_risk), s.q(K["language"])), (s.any_of("rt", R.night), s.q(K["night"])), ("location_fit = 'excluded_far'", s.q(K["far"])), ("location_fit = 'unknown'", s.q(K["unknown"])),
                ("category IN ('', 'general', 'other', 'unknown')", s.q(K["category"])), ("company = ''", s.q(K["company"])), ("location = ''", s.q(K["location"])), ("true", s.q(K["salary"])), ("neg <> ''", "neg")])
REP = r.marked_ctes() + [f"rep AS MATERIALIZED (SELECT *, {RT} AS rt FROM marked)"]
NREP = r.norm_ctes() + [f"rep AS MATERIALIZED (SELECT *, {RT} AS rt, '' AS history_status FROM norm)"]
REPORT, NORMREP = r.run(REP, ""), r.run(NREP, "")


def marked(spark, folder):
    rows = annotated(spark, folder, texts=True)
    return sel.write_back_selection(rows, sel.select_by_buckets(rows))


def with_text(df):
    return tx.settle(df, {"_rtext": tx.join_fields(df, cl.REPORT_FIELDS)})


@query("report_block", NORMREP + f"SELECT seq, {BLOCK} AS local_block, {REMOTE_BLOCK} AS remote_block FROM rep")
def report_block(spark, folder):
    df = with_text(normalized(spark, folder))
    return df.select("seq", cl.report_block(df, "local_student", R).alias("local_block"), cl.report_block(df, "remote", R).alias("remote_block"))


@query("recommendation", REPORT + f""", lv AS (SELECT *, {LEVEL} AS level, {CV} AS cv FROM rep) SELECT seq, level, CASE level """ + " ".join(f"WHEN {s.q(a)} THEN {s.q(b)}" for a, b in fv.LEVEL_LABELS.items()) + f""" END AS label, cv, {LETTER} AS letter,
 CASE WHEN match_score >= 90 THEN '★★★★★ Strong match' WHEN match_score >= 80 THEN '★★★★ Good match' ELSE '★★★ Consider' END AS match_label, CASE history_status """ + " ".join(f"WHEN {s.q(a)} THEN {s.q(b)}" for a, b in fv.STATUS_LABELS.items()) + " ELSE '' END AS status_label FROM lv")
def recommendation(spark, folder):
    df = with_text(marked(spark, folder))
    out = tx.settle(df, {"level": rs.recommendation_level(df, R), "cv": rs.recommended_cv(df, R)})
    return out.select("seq", "level", rs.level_label(F.col("level")).alias("label"), "cv", rs.recommended_letter(F.col("cv")).alias("letter"),
                      rs.match_label(F.col("match_score")).alias("match_label"), rs.status_label(F.col("history_status")).alias("status_label"))


@query("fit_and_risk_reasons", NORMREP + f"SELECT seq, array_to_string(({FITS})[1:7], ' | ') AS fits, array_to_string(({RISKS})[1:7], ' | ') AS risks FROM rep")
def fit_and_risk_reasons(spark, folder):
    df = with_text(normalized(spark, folder))
    return df.select("seq", F.array_join(rs.fit_reasons(df, R), " | ").alias("fits"), F.array_join(rs.risk_reasons(df, R), " | ").alias("risks"))


WORDS = "list_filter(list_transform(str_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"


@query("ordered_unique_items", f"""WITH w AS (SELECT doc_id, {WORDS} AS items FROM documents), e AS (SELECT doc_id, unnest(items) AS item, generate_subscripts(items, 1) AS pos FROM w),
 f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(item) ORDER BY pos) AS rn FROM e), g AS (SELECT doc_id, string_agg(item, chr(10) ORDER BY pos) AS items FROM f WHERE rn = 1 GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.items, '') AS items FROM documents d LEFT JOIN g USING (doc_id)""")
def ordered_unique_items(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.array_join(tx.distinct_items(F.split("text", "\n")), "\n").alias("items"))


@query("reason_cap", f"SELECT doc_id, array_to_string(({s.matched('lower(text)', [p for p, _ in W.positive])})[1:7], ', ') AS reasons, array_to_string(({s.matched('lower(text)', [p for p, _ in W.positive])})[1:3], ', ') AS terms FROM documents")
def reason_cap(spark, folder):
    df = tx.settle(table(spark, folder, "documents").select("doc_id", "text"), {"low": F.lower("text")})
    found = tx.settle(df, {"found": tx.matched_terms(F.col("low"), [p for p, _ in W.positive])})
    return found.select("doc_id", F.array_join(F.slice("found", 1, fv.REASON_LIMIT), ", ").alias("reasons"), F.array_join(F.slice("found", 1, 3), ", ").alias("terms"))


_c = lambda cond: f"CAST(count(*) FILTER ({cond}) AS BIGINT)"


@query("selection_summary", REPORT + f"SELECT coalesce(max(match_score), 0) AS top_match_score, {_c(LEVEL + ' = ' + s.q('apply_today'))} AS recommended FROM rep")
def selection_summary(spark, folder):
    return ag.selection_summary(marked(spark, folder), R)


@query("best_row", REPORT + f"SELECT seq, title, ({FITS})[1] AS main_reason FROM rep ORDER BY match_score DESC, seq LIMIT 1")
def best_row(spark, folder):
    return ag.best_row(marked(spark, folder), R)


@query("action_plan", REPORT + f""", lv AS (SELECT *, {LEVEL} AS level FROM rep) SELECT {_c("level = 'apply_today'")} AS apply_today, {_c("level = 'watch'")} AS watch,
 {_c("level = 'skip'")} + {_c("history_status = 'SEEN' AND NOT picked")} AS skip, coalesce(max(match_score), 0) AS best_match FROM lv""")
def action_plan(spark, folder):
    df = marked(spark, folder)
    stats = ag.status_counts(df, F.col("selection_rejection_reason") != "selected")
    return ag.action_plan(df, stats, R)


@query("block_diagnostics", REPORT + f""", b AS (SELECT *, {BLOCK} AS block FROM rep) SELECT CAST(list_position({s.arr(fv.LOCAL_BLOCKS)}, l.block) - 1 AS INTEGER) AS block_seq, l.block, count(b.seq) AS found,
 {_c("b.history_status = 'SEEN' OR b.selection_rejection_reason IN ('history_seen', 'seen_recently')")} AS already_seen, {_c("b.selection_rejection_reason IN ('history_seen', 'seen_recently')")} AS rejected_history,
 {_c("b.selection_rejection_reason IN ('profile_rejected', 'low_match')")} AS rejected_profile, {_c("b.selection_rejection_reason = 'location_rejected' OR (b.location_fit IN ('excluded_far', 'unknown') AND NOT b.remote)")} AS rejected_cleaner_location
FROM (SELECT unnest({s.arr(fv.LOCAL_BLOCKS)}) AS block) l LEFT JOIN b USING (block) GROUP BY l.block""")
def block_diagnostics(spark, folder):
    return ag.block_diagnostics(with_text(marked(spark, folder)), "local_student", R)


REPORT_ORDER = "CASE selection_reason WHEN 'NEW' THEN 0 WHEN 'UPDATED' THEN 1 WHEN 'NEVER_SENT_FILL' THEN 2 WHEN 'RESURFACED' THEN 3 ELSE 6 END, " + r.SCORE_ORDER
TOPREP = REP + [f"rows AS MATERIALIZED (SELECT *, {BLOCK} AS block, {LEVEL} AS level, {CV} AS cv, {RANKED.format(o=REPORT_ORDER)} FROM rep WHERE picked)"]


@query("block_groups", r.run(TOPREP, "") + f""", g AS (SELECT block, count(*) AS n, string_agg(title, ' | ' ORDER BY rank) AS titles FROM rows WHERE rank <= 100 GROUP BY block)
SELECT CAST(list_position({s.arr(fv.LOCAL_BLOCKS)}, l.block) - 1 AS INTEGER) AS block_seq, l.block, coalesce(n, 0) AS n, coalesce(titles, '') AS titles FROM (SELECT unnest({s.arr(fv.LOCAL_BLOCKS)}) AS block) l LEFT JOIN g USING (block)""")
def block_groups(spark, folder):
    rows = cut(curation.report_rows(marked(spark, folder), BOOK).drop("rank"))
    return ag.block_groups(rows, "local_student", R, sel.report_order(rows))


@query("report_dataset", r.run(TOPREP, "") + f"SELECT rank, seq, block, level AS recommendation_level, cv AS recommended_cv, {LETTER} AS recommended_cover_letter, array_to_string(({FITS})[1:7], ' | ') AS fits FROM rows WHERE rank <= 100")
def report_dataset(spark, folder):
    rows = curation.report_rows(marked(spark, folder), BOOK)
    typed = with_text(rows)
    return typed.select("rank", "seq", cl.report_block(typed, "local_student", R).alias("block"), "recommendation_level", "recommended_cv", "recommended_cover_letter",
                        F.array_join("fit_reasons", " | ").alias("fits"))


# --- whole jobs ------------------------------------------------------------------------

@query("aggregate_select_export")
def aggregate_select_export(spark, folder):
    options = curation.RunOptions(clean_mode="soft", drop_far=True, drop_unknown=True, fallback=True, top=150)
    tables = curation.run(postings(spark, folder), history(spark, folder), BOOK, options, now())
    return tables.exported.select("seq", "url", "category", "match_score", "history_status", "selection_reason", "selection_rejection_reason")


# Scored rows against the small history, then the rotation and the mail labels. The hash covers the scored fields.
_HASHED = ("company", "description", "employment_type", "location", "negative_reason", "positive_reason", "salary_text", "score_reason", "title")
FULL_HASH = "sha256(concat('{', array_to_string([" + ", ".join(f"concat('\"{n}\": ', CAST(to_json({r.strip(n)}) AS VARCHAR))" for n in _HASHED) + "], ', '), '}'))"
UNSENT = SCORED + SMALL + [
    f"keyed AS (SELECT c.*, p.hkey, {FULL_HASH} AS full_hash FROM scored c JOIN (SELECT seq, hkey FROM plain) p USING (seq))",
    f"""compared AS (SELECT k.*, CASE WHEN m.hkey IS NULL THEN 'NEW' WHEN m.content_hash NOT IN (full_hash, '') THEN 'UPDATED'
 WHEN DATE '{NOW[:10]}' - m.sent_at >= 7 THEN 'RESURFACED' ELSE 'SEEN' END AS history_status
 FROM (SELECT *, row_number() OVER (PARTITION BY hkey ORDER BY seq) AS krn FROM keyed) k LEFT JOIN small m USING (hkey) WHERE krn = 1)""",
    """placed AS (SELECT seq, row_number() OVER (ORDER BY CASE history_status WHEN 'NEW' THEN 0 WHEN 'UPDATED' THEN 1 ELSE 2 END, job_score DESC, seq) AS place
 FROM compared WHERE history_status <> 'SEEN')""",
]


@query("unsent_selection", s.with_postings(*UNSENT) + f"""SELECT seq, job_score, history_status, CASE WHEN history_status = 'SEEN' THEN '' ELSE history_status END AS selection_reason,
 CASE WHEN history_status = 'SEEN' THEN 'not_rotation_eligible' WHEN place <= {fv.SENT_KEY_LIMIT} THEN 'selected' ELSE 'not_selected_due_to_limit' END AS selection_rejection_reason,
 {MAIL_REASON} AS remote_email_rejection_reason FROM compared LEFT JOIN placed USING (seq)""")
def unsent_selection(spark, folder):
    scored = plan.scored_rows(postings(spark, folder), BOOK)
    sent = small_history(spark, folder, postings(spark, folder))
    out = curation.unsent_rows(scored, sent, now(), BOOK)
    return out.select("seq", "job_score", "history_status", "selection_reason", "selection_rejection_reason", "remote_email_rejection_reason")
