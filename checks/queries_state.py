"""History, selection and statistics over postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as s, sql_run as r
from checks.corpus import BOOK, NOW
from checks.registry import query
from checks.views import annotated, classified, history, normalized, now, postings, table
from siftworks.functions import classify as cl, identity as ident, reasons as rs, text as tx
from siftworks.operators import aggregates as ag, dedup, filters as fl, history as hs, joins as jn, selection as sel
from siftworks.operators import projections as pj
from siftworks.rules import fixed_values as fv
from siftworks.session import cut, scratch_path
from siftworks.sources import files

CLS = r.run(r.classified_ctes(), "")
IDS = r.run(r.classified_ctes() + r.identity_ctes() + r.history_ctes(), "")
ANN = r.run(r.annotated_ctes(), "")
SEL = r.run(r.selected_ctes(), "")
MARK = r.run(r.marked_ctes(), "")
SCORES = "match_score, student_score, candidate_score, score"


# --- identity and time ------------------------------------------------------------

SENT_HASH = "sha256(concat('{', array_to_string([" + ", ".join(
    f"concat('\"{n}\": ', CAST(to_json({r.strip(v)}) AS VARCHAR))" for n, v in (
        ("company", "company"), ("description", "description"), ("employment_type", "''"), ("location", "location"),
        ("negative_reason", "''"), ("positive_reason", "''"), ("salary_text", "''"), ("score_reason", "''"), ("title", "title"))) + "], ', '), '}'))"


@query("identity_hashes", IDS + f"SELECT seq, job_id, content_hash, {SENT_HASH} AS sent_hash FROM ids")
def identity_hashes(spark, folder):
    df = normalized(spark, folder)
    bare = df.select("seq", "title", "company", "location", "description")
    hashed = df.select("seq", ident.job_id(df).alias("job_id"), ident.content_hash(df).alias("content_hash"))
    return hashed.join(bare.select("seq", ident.sent_content_hash(bare).alias("sent_hash")), "seq")


TIMES = """CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S +0200')
 WHEN 2 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) ELSE concat('on ', event_type) END"""


def event_times(spark, folder):
    df = table(spark, folder, "events")
    ts = F.col("ts").cast("timestamp")
    day = F.element_at(F.array(*[F.lit(d) for d in ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")]), F.dayofweek(ts))
    raw = (F.when(F.col("event_id") % 4 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
           .when(F.col("event_id") % 4 == 1, F.concat(day, F.lit(", "), F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" +0200")))
           .when(F.col("event_id") % 4 == 2, F.unix_timestamp(ts).cast("string")).otherwise(F.concat(F.lit("on "), "event_type")))
    return df.select("event_id", raw.alias("raw"))


EPOCH = "CASE event_id % 4 WHEN 0 THEN CAST(floor(epoch(ts)) AS BIGINT) WHEN 1 THEN CAST(floor(epoch(ts)) AS BIGINT) - 7200 WHEN 2 THEN CAST(floor(epoch(ts)) AS BIGINT) END"


@query("timestamps", f"SELECT event_id, {EPOCH} AS seconds FROM events")
def timestamps(spark, folder):
    return event_times(spark, folder).select("event_id", F.unix_timestamp(ident.parse_time(F.col("raw"))).alias("seconds"))


@query("age_days", f"SELECT event_id, CASE WHEN event_id % 4 <> 3 THEN CAST(greatest(0, floor((epoch(TIMESTAMP '{NOW}') - ({EPOCH})) / 86400)) AS INTEGER) END AS days, "
       f"CAST(greatest(0, DATE '{NOW[:10]}' - CAST(ts AS DATE)) AS INTEGER) AS calendar_days FROM events")
def age_days(spark, folder):
    parsed = event_times(spark, folder).select("event_id", ident.age_days(ident.parse_time(F.col("raw")), now()).alias("days"))
    dates = table(spark, folder, "events").select("event_id", ident.calendar_age_days(F.col("ts").cast("date"), now()).alias("calendar_days"))
    return parsed.join(dates, "event_id")


# --- history state -------------------------------------------------------------------

REC = "struct<job_id:string,url:string,title:string,source:string,sent_count:int,match_score:int>"


@query("sent_history_scan", s.with_postings() + """
SELECT job_id, title, sent_count FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY pos DESC) AS rn FROM (
 SELECT CASE WHEN seq % 7 = 0 THEN '' ELSE concat('j', seq // 3) END AS job_id, title, CAST(seq % 5 AS INTEGER) AS sent_count, seq AS pos FROM postings)
 WHERE job_id <> '') WHERE rn = 1""")
def sent_history_scan(spark, folder):
    # Landed state files: one JSON list or mapping per line, each holding the records of one posting.
    df = postings(spark, folder)
    number = F.expr("seq div 3")
    record = F.struct(
        F.when(F.col("seq") % 7 == 0, "").otherwise(F.concat(F.lit("j"), number)).alias("job_id"), "title",
        (F.col("seq") % 5).cast("int").alias("sent_count"))
    as_list, as_map = F.to_json(F.array(record)), F.to_json(F.create_map(F.concat(F.lit("k"), "seq"), record))
    path = scratch_path(spark, "state")
    df.select("seq", F.when(F.col("seq") % 2 == 0, as_list).otherwise(as_map).alias("value")).write.parquet(path)
    raw = spark.read.parquet(path)
    return files.history_rows(raw, order="seq").select("job_id", "title", "sent_count")


@query("sent_history_ttl_scan", s.with_postings() + f"""
SELECT key, strftime(sent_at, '%Y-%m-%d') AS sent_at, content_hash FROM (
 SELECT concat('https://x.example/', seq) AS key, CASE WHEN seq % 9 = 0 THEN NULL ELSE DATE '{NOW[:10]}' - CAST(n_chars % 120 AS INTEGER) END AS sent_at,
  CASE WHEN seq % 2 = 0 THEN sha256(title) ELSE '' END AS content_hash FROM postings WHERE seq % 11 <> 10) WHERE sent_at >= DATE '{NOW[:10]}' - 90""")
def sent_history_ttl_scan(spark, folder):
    df = postings(spark, folder)
    day = F.when(F.col("seq") % 9 == 0, "soon").otherwise(F.date_format(F.date_sub(F.to_date(now()), (F.col("n_chars") % 120).cast("int")), "yyyy-MM-dd"))
    key = F.concat(F.lit("https://x.example/"), "seq")
    rich = F.to_json(F.create_map(key, F.struct(day.alias("sent_at"), F.sha2("title", 256).alias("content_hash"))))
    plain = F.to_json(F.create_map(key, day))
    value = F.when(F.col("seq") % 11 == 10, "{broken").when(F.col("seq") % 2 == 0, rich).otherwise(plain)
    rows = files.sent_key_rows(df.select(value.alias("value")), now(), fv.SENT_KEY_TTL_DAYS)
    return rows.select("key", F.date_format("sent_at", "yyyy-MM-dd").alias("sent_at"), "content_hash")


HIST_COLS = "history_status, days_since_last_sent, rotation_eligible, sent_count, last_sent, first_seen"


@query("history_annotate_join", IDS + "SELECT seq, " + HIST_COLS + " FROM (" + r.ANNOTATE.format(source="ids") + ")")
def history_annotate_join(spark, folder):
    rows = cut(normalized(spark, folder))
    out = hs.annotate_history(rows, history(spark, folder, rows), now(), spread=True)
    return out.select("seq", *HIST_COLS.split(", "))


@query("pool_history_join", IDS + """
SELECT d.seq, coalesce(h.first_seen, d.found_at) AS first_seen, coalesce(h.last_sent, '') AS last_sent, coalesce(h.sent_count, 0) AS sent_count,
 CASE WHEN coalesce(h.last_sent, '') <> '' THEN CAST(h.age AS INTEGER) END AS days_since_last_sent,
 coalesce(h.sent_count > 0 AND h.last_sent <> '' AND h.age >= 7, false) AS rotation_eligible FROM ids d LEFT JOIN history h USING (job_id)""")
def pool_history_join(spark, folder):
    rows = cut(normalized(spark, folder))
    keyed = rows.withColumn("job_id", ident.job_id(rows))
    out = hs.attach_pool_history(keyed, history(spark, folder, rows), now())
    return out.select("seq", "first_seen", "last_sent", "sent_count", "days_since_last_sent", "rotation_eligible")


# Small history: labelled postings, keyed by their own URL or identity.
SMALL = [
    f"plain AS MATERIALIZED (SELECT *, CASE WHEN url <> '' THEN {s.canonical('url')} ELSE concat_ws('|', lower(trim(title)), lower(trim(company)), lower(trim(location))) END AS hkey, {SENT_HASH} AS row_hash FROM postings)",
    "marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id)",
    f"small AS MATERIALIZED (SELECT hkey, DATE '{NOW[:10]}' - CAST(n_chars % 14 AS INTEGER) AS sent_at, CASE WHEN toxic = 1 THEN 'changed' WHEN quality = 0 THEN '' ELSE row_hash END AS content_hash "
    "FROM (SELECT *, row_number() OVER (PARTITION BY hkey ORDER BY seq) AS rn FROM plain JOIN marks ON seq = doc_id) WHERE rn = 1)",
]
SENT = SMALL + [f"""sent AS (SELECT p.*, CAST(DATE '{NOW[:10]}' - m.sent_at AS INTEGER) AS days_since_last_sent, coalesce(DATE '{NOW[:10]}' - m.sent_at >= 7, false) AS rotation_eligible,
 CASE WHEN m.hkey IS NULL THEN 'NEW' WHEN m.content_hash NOT IN (row_hash, '') THEN 'UPDATED' WHEN DATE '{NOW[:10]}' - m.sent_at >= 7 THEN 'RESURFACED' ELSE 'SEEN' END AS history_status
 FROM plain p LEFT JOIN small m USING (hkey))"""]


def small_history(spark, folder, df):
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = tx.settle(df, {"key": ident.sent_key(df), "row_hash": ident.sent_content_hash(df)}).join(labels, F.col("seq") == F.col("doc_id"))
    first = dedup.keep_first(rows, ["key"], ["seq"])
    return first.select("key", F.date_sub(F.to_date(now()), (F.col("n_chars") % 14).cast("int")).alias("sent_at"),
                        F.when(F.col("toxic") == 1, "changed").when(F.col("quality") == 0, "").otherwise(F.col("row_hash")).alias("content_hash"))


@query("sent_key_join", s.with_postings(*SENT) + """
SELECT seq, days_since_last_sent, rotation_eligible, history_status, CASE WHEN history_status = 'SEEN' THEN '' ELSE history_status END AS selection_reason FROM sent""")
def sent_key_join(spark, folder):
    df = postings(spark, folder)
    out = hs.annotate_sent_keys(df, small_history(spark, folder, df), now(), spread=True)
    return out.select("seq", "days_since_last_sent", "rotation_eligible", "history_status", "selection_reason")


ROTATION = SENT + [
    "uniq AS (SELECT *, (n_chars % 400) AS job_score FROM (SELECT *, row_number() OVER (PARTITION BY hkey ORDER BY seq) AS rn FROM sent) WHERE rn = 1)",
    """ranked AS (SELECT *, row_number() OVER (ORDER BY CASE history_status WHEN 'NEW' THEN 0 WHEN 'UPDATED' THEN 1 ELSE 2 END, job_score DESC, seq) AS place FROM uniq WHERE history_status <> 'SEEN')""",
]


@query("rotation_topk", s.with_postings(*ROTATION) + """
SELECT u.seq, u.history_status, CASE WHEN u.history_status = 'SEEN' THEN 'not_rotation_eligible' WHEN r.place <= 20 THEN 'selected' ELSE 'not_selected_due_to_limit' END AS selection_rejection_reason
FROM uniq u LEFT JOIN ranked r USING (seq)""")
def rotation_topk(spark, folder):
    df = postings(spark, folder).withColumn("job_score", F.col("n_chars") % 400)
    unique = dedup.keep_first(df.withColumn("_k", ident.sent_key(df)), ["_k"], ["seq"]).drop("_k")
    known = hs.annotate_sent_keys(unique, small_history(spark, folder, df), now())
    return sel.rotation_top(known, 20).select("seq", "history_status", "selection_rejection_reason")


@query("history_upsert", ANN + f"""
, fresh AS (SELECT * FROM ann WHERE history_status <> 'SEEN')
SELECT coalesce(h.job_id, f.job_id) AS job_id, coalesce(f.title, h.title) AS title,
 CASE WHEN f.job_id IS NULL THEN h.first_seen ELSE coalesce(h.first_seen, f.found_at) END AS first_seen,
 CASE WHEN f.job_id IS NULL THEN h.last_sent ELSE '{NOW[:10]}T12:00:00Z' END AS last_sent,
 CAST(CASE WHEN f.job_id IS NULL THEN h.sent_count ELSE coalesce(h.sent_count, 0) + 1 END AS INTEGER) AS sent_count,
 coalesce(f.content_hash, h.content_hash) AS content_hash, CAST(coalesce(f.match_score, h.match_score) AS INTEGER) AS match_score
FROM history h FULL OUTER JOIN fresh f USING (job_id)""")
def history_upsert(spark, folder):
    labelled = classified(spark, folder, texts=False)
    rows = annotated(spark, folder, labelled)
    out = hs.upsert_history(history(spark, folder, labelled), rows.filter("history_status <> 'SEEN'"), now())
    return out.select("job_id", "title", "first_seen", "last_sent", "sent_count", "content_hash", "match_score")


@query("history_state_sink", IDS + "SELECT job_id, last_sent, sent_count FROM history")
def history_state_sink(spark, folder):
    path = scratch_path(spark, "history")
    files.write_history(history(spark, folder), path)
    return spark.read.parquet(path).select("job_id", "last_sent", "sent_count")


@query("action_preserve_join", IDS + """
SELECT i.seq, coalesce(p.action, '') AS action FROM ids i LEFT JOIN (
 SELECT job_id, CASE WHEN quality = 1 THEN 'applied' ELSE 'skip' END AS action FROM (SELECT job_id, quality, toxic, row_number() OVER (PARTITION BY job_id ORDER BY seq DESC) AS rn
 FROM ids JOIN marks ON seq = doc_id WHERE toxic = 0) WHERE rn = 1) p USING (job_id)""")
def action_preserve_join(spark, folder):
    rows = normalized(spark, folder)
    keyed = rows.withColumn("job_id", ident.job_id(rows))
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    previous = keyed.join(labels, F.col("seq") == F.col("doc_id")).select(
        "seq", "job_id", F.when(F.col("toxic") != 0, "").when(F.col("quality") == 1, "applied").otherwise("skip").alias("action"))
    return hs.preserve_actions(keyed, previous).select("seq", "action")


# --- eligibility and selection -------------------------------------------------------------

@query("candidate_eligibility", ANN + "SELECT seq, match_score FROM ann WHERE match_score >= 50 AND NOT loc_rej AND NOT prof_rej")
def candidate_eligibility(spark, folder):
    return fl.eligible(annotated(spark, folder), 50).select("seq", "match_score")


@query("history_repeat_filter", ANN + """
SELECT seq, history_status FROM ann WHERE history_status <> 'SEEN' OR seq <= (SELECT max(seq) FROM (SELECT seq FROM ann WHERE history_status = 'SEEN' ORDER BY seq LIMIT 3))""")
def history_repeat_filter(spark, folder):
    return fl_rows(spark, folder)


def fl_rows(spark, folder):
    return sel.repeat_filter(annotated(spark, folder), include_seen=True, repeat=3).select("seq", "history_status")


@query("bucketed_selection", SEL + f"SELECT seq, selection_reason, match_score, CAST(row_number() OVER (ORDER BY bucket, {r.STATUS_RANK}, {r.SCORE_ORDER}) AS INTEGER) AS rank FROM sel")
def bucketed_selection(spark, folder):
    chosen = sel.select_by_buckets(annotated(spark, folder))
    return sel.rank_rows(chosen, sel.status_order(chosen)).select("seq", "selection_reason", "match_score", "rank")


@query("selection_writeback_join", MARK + "SELECT seq, selection_reason, selection_rejection_reason FROM marked")
def selection_writeback_join(spark, folder):
    rows = annotated(spark, folder)
    return sel.write_back_selection(rows, sel.select_by_buckets(rows)).select("seq", "selection_reason", "selection_rejection_reason")


_c = lambda cond: f"CAST(count(*) FILTER ({cond}) AS BIGINT)"
OK = "(match_score >= 50 AND NOT loc_rej AND NOT prof_rej)"
ROT = f"{OK} AND rotation_eligible AND NOT never_sent AND history_status IN ('SEEN', 'RESURFACED') AND NOT picked"


@query("selection_debug", MARK + f"""
SELECT count(*) AS candidate_pool_total, count(*) AS candidates_total, {_c(OK + " AND history_status = 'NEW'")} AS eligible_new, {_c(OK + " AND history_status = 'UPDATED'")} AS eligible_updated,
 {_c(OK + " AND never_sent AND history_status NOT IN ('NEW', 'UPDATED')")} AS eligible_never_sent_fill, {_c(OK + " AND never_sent")} AS eligible_never_sent,
 {_c(OK + " AND history_status = 'RESURFACED'")} AS eligible_resurfaced, {_c(ROT)} AS eligible_fallback, {_c(ROT)} AS eligible_fallback_rotation,
 {_c("selection_rejection_reason = 'low_match'")} AS rejected_low_match, {_c("selection_rejection_reason = 'profile_rejected'")} AS rejected_profile,
 {_c("selection_rejection_reason = 'location_rejected'")} AS rejected_location, {_c("selection_rejection_reason = 'seen_recently'")} AS rejected_seen_recently,
 {_c("selection_rejection_reason = 'seen_recently'")} AS rejected_seen, {_c("selection_rejection_reason = 'no_selection_bucket'")} AS rejected_no_selection_bucket,
 {_c("selection_rejection_reason = 'not_selected_due_to_limit'")} AS rejected_not_selected_due_to_limit, {_c("picked")} AS rows_of_selected_keys FROM marked""")
def selection_debug(spark, folder):
    rows = annotated(spark, folder)
    marked = sel.write_back_selection(rows, sel.select_by_buckets(rows))
    return ag.selection_debug(marked.drop("selection_rejection_reason"), F.col("selection_reason") != "")


@query("history_status_counts", MARK + f"""SELECT {_c("history_status = 'NEW'")} AS new_jobs, {_c("history_status = 'UPDATED'")} AS updated_jobs, {_c("history_status = 'SEEN'")} AS seen_jobs,
 {_c("history_status = 'RESURFACED'")} AS resurfaced_jobs, {_c("history_status = 'SEEN' AND NOT picked")} AS seen_skipped FROM marked""")
def history_status_counts(spark, folder):
    rows = annotated(spark, folder)
    marked = sel.write_back_selection(rows, sel.select_by_buckets(rows))
    return ag.status_counts(marked, F.col("selection_rejection_reason") != "selected")


@query("quota_anti_join", SEL + "SELECT seq FROM ann WHERE dkey NOT IN (SELECT dkey FROM sel)")
def quota_anti_join(spark, folder):
    rows = annotated(spark, folder)
    return jn.not_yet_selected(rows, sel.select_by_buckets(rows), ident.dedup_key(rows)).select("seq")


def quota_tests(df):
    kind = F.col("category")
    return {"remote": tx.flag(df, "remote"), "data_office": kind.isin("data_entry", "alpha"), "hospitality": kind.isin("gamma", "alpha"),
            "cleaning": kind == "beta", "maintenance": kind == "technical"}


def quota_sql(top: int) -> str:
    """Claims in turn, one anti join and limit per group; the rest by score."""
    tests = {"remote": "remote", "data_office": "category IN ('data_entry', 'alpha')", "hospitality": "category IN ('gamma', 'alpha')", "cleaning": "category = 'beta'",
             "maintenance": "category = 'technical'"}
    order, ctes, claimed = f"{r.STATUS_RANK}, {r.SCORE_ORDER}", [], []
    for stage, (test, size) in enumerate([(f"location_fit <> 'excluded_far' AND {tests[n]}", fv.QUOTA_SIZES[n]) for n in fv.QUOTA_SIZES] + [("true", top)]):
        free = "".join(f" AND dkey NOT IN (SELECT dkey FROM {c})" for c in claimed)
        ctes.append(f"claim{stage} AS MATERIALIZED (SELECT {stage} AS stage, * FROM ann WHERE {test}{free} ORDER BY {order} LIMIT {size})")
        claimed.append(f"claim{stage}")
    union = " UNION ALL ".join(f"SELECT * FROM {c}" for c in claimed)
    return (ANN + ", " + ", ".join(ctes) + f", chosen AS (SELECT * FROM ({union}) ORDER BY stage, {order} LIMIT {top})"
            f" SELECT seq, category, remote, match_score, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank FROM chosen")


@query("balanced_quota_topk", quota_sql(120))
def balanced_quota_topk(spark, folder):
    df = annotated(spark, folder)
    top = sel.quota_top(df, 120, groups=quota_tests(df))
    return sel.rank_rows(top, sel.status_order(top)).select("seq", "category", "remote", "match_score", "rank")


# --- sorts and limits -----------------------------------------------------------------------------

RANKED = "CAST(row_number() OVER (ORDER BY {o}) AS INTEGER) AS rank"


@query("status_score_sort", ANN + f"SELECT * FROM (SELECT seq, history_status, match_score, {RANKED.format(o=r.STATUS_RANK + ', ' + r.SCORE_ORDER)} FROM ann)")
def status_score_sort(spark, folder):
    df = annotated(spark, folder)
    return sel.rank_all(df, sel.status_order(df), ["seq", "history_status", "match_score"])


PART_FIRST = "(priority_bucket = 'campania_part_time') DESC, remote DESC, match_score DESC, student_score DESC, score DESC, seq"
NORM = r.run(r.norm_ctes(), "")


@query("local_part_time_first", NORM + f"SELECT * FROM (SELECT seq, priority_bucket, remote, {RANKED.format(o=PART_FIRST)} FROM norm) WHERE rank <= 50")
def local_part_time_first(spark, folder):
    top = sel.collector_top(normalized(spark, folder), 50, part_time_first=True)
    return sel.rank_rows(top, sel.local_part_time_order(top)).select("seq", "priority_bucket", "remote", "rank")


@query("pool_sort", NORM + f"SELECT * FROM (SELECT seq, {SCORES}, {RANKED.format(o=r.SCORE_ORDER)} FROM norm)")
def pool_sort(spark, folder):
    df = normalized(spark, folder)
    return sel.rank_all(df, sel.pool_order(df), ["seq", *SCORES.split(", ")])


@query("report_sort_top", MARK + f"""SELECT * FROM (SELECT seq, selection_reason, match_score,
 {RANKED.format(o="CASE selection_reason WHEN 'NEW' THEN 0 WHEN 'UPDATED' THEN 1 WHEN 'NEVER_SENT_FILL' THEN 2 WHEN 'RESURFACED' THEN 3 ELSE 6 END, " + r.SCORE_ORDER)} FROM marked) WHERE rank <= 100""")
def report_sort_top(spark, folder):
    rows = annotated(spark, folder)
    df = sel.write_back_selection(rows, sel.select_by_buckets(rows))
    return sel.rank_top(df, sel.report_order, 100).select("seq", "selection_reason", "match_score", "rank")


@query("selected_or_all", MARK + "SELECT seq, selection_reason FROM marked WHERE picked")
def selected_or_all(spark, folder):
    rows = annotated(spark, folder)
    return fl.selected_or_all(sel.write_back_selection(rows, sel.select_by_buckets(rows))).select("seq", "selection_reason")


@query("membership_flag", CLS + "SELECT seq, CASE WHEN url <> '' THEN lower(url) ELSE concat('#', seq) END IN (SELECT lower(url) FROM cls WHERE rtype = 'job' AND url <> '') AS member FROM cls")
def membership_flag(spark, folder):
    rows = jn.classify_results(normalized(spark, folder), BOOK.patterns, BOOK.clean)
    keyed = rows.withColumn("k", F.when(F.col("url") != "", F.lower("url")).otherwise(F.concat(F.lit("#"), "seq")))
    jobs = keyed.filter("result_type = 'job' and url <> ''").select("k")
    return jn.mark_members(keyed, jobs, "k", "member").select("seq", "member")


# --- pool ---------------------------------------------------------------------------------------------

POOL_BASE = r.selected_ctes() + [
    "pool AS MATERIALIZED (SELECT a.*, x.job_id IS NOT NULL AS chosen, coalesce(x.selection_reason, '') AS selection_reason FROM (SELECT * EXCLUDE (selection_rejection_reason) FROM ann WHERE utype = 'real_job' AND rtype = 'job') a "
    "LEFT JOIN (SELECT job_id, selection_reason FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY seq DESC) AS jrn FROM sel) WHERE jrn = 1) x USING (job_id))",
    "pool_r AS MATERIALIZED (SELECT *, CASE WHEN chosen THEN 'selected' WHEN loc_rej THEN 'location_rejected' "
    "WHEN contains(neg, 'country') OR contains(neg, 'seniority') OR contains(neg, 'excluded title') THEN 'profile_rejected' WHEN match_score < 50 THEN 'low_match' "
    "WHEN history_status = 'SEEN' AND NOT never_sent THEN 'seen_recently' WHEN NOT (history_status IN ('NEW', 'UPDATED', 'RESURFACED') OR never_sent) THEN 'no_selection_bucket' "
    "ELSE 'not_selected_due_to_limit' END AS selection_rejection_reason, "
    "CASE WHEN chosen THEN 'passed' WHEN location_fit = 'excluded_far' THEN 'excluded_far' WHEN location_fit = 'unknown' AND NOT remote THEN 'unknown_location' "
    "WHEN history_status = 'SEEN' THEN 'history_seen' WHEN contains(neg, 'country') THEN 'rejected_by_country' WHEN contains(neg, 'seniority') OR contains(neg, 'excluded title') THEN 'rejected_by_seniority' "
    "WHEN match_score < 70 THEN 'low_match' ELSE 'email_limit' END AS rejection_reason FROM pool)",
]
POOL = r.run(POOL_BASE, "")
POOL_COLS = ("seq", "selection_reason", "selection_rejection_reason", "rejection_reason")


def pool(spark, folder):
    from siftworks.plans.curation import candidate_pool
    labelled = classified(spark, folder, texts=False)
    rows = annotated(spark, folder, labelled)
    return candidate_pool(rows, sel.select_by_buckets(rows), history(spark, folder, labelled), now())


@query("pool_build", POOL + "SELECT seq, selection_reason, selection_rejection_reason, rejection_reason, history_status, sent_count FROM pool_r")
def pool_build(spark, folder):
    return pool(spark, folder).select(*POOL_COLS, "history_status", "sent_count")


@query("pool_selection_join", POOL + "SELECT seq, selection_reason, selection_rejection_reason, rejection_reason FROM pool_r")
def pool_selection_join(spark, folder):
    rows = annotated(spark, folder)
    return jn.attach_selection(rows.filter(cl.is_real_posting(rows)), sel.select_by_buckets(rows)).select(*POOL_COLS)


@query("pool_filter", POOL + f"SELECT * FROM (SELECT seq, match_score, {RANKED.format(o=r.SCORE_ORDER)} FROM pool_r WHERE location_fit = 'allowed_local' AND rejection_reason = 'low_match') WHERE rank <= 25")
def pool_filter(spark, folder):
    top = fl.pool_view(pool(spark, folder), location="Allowed_Local", reason="LOW_MATCH", top=25)
    return sel.rank_rows(top, sel.pool_order(top)).select("seq", "match_score", "rank")


@query("rejection_reason", MARK + """
SELECT seq, selection_rejection_reason AS selection,
 CASE WHEN rtype IN ('search_page', 'category_page', 'career_page', 'company_page', 'article', 'excluded_domain') THEN rtype WHEN picked THEN 'passed' WHEN location_fit = 'excluded_far' THEN 'excluded_far'
  WHEN location_fit = 'unknown' AND NOT remote THEN 'unknown_location' WHEN history_status = 'SEEN' THEN 'history_seen' WHEN contains(neg, 'country') THEN 'rejected_by_country'
  WHEN contains(neg, 'seniority') OR contains(neg, 'excluded title') THEN 'rejected_by_seniority' WHEN match_score < 70 THEN 'low_match' ELSE 'email_limit' END AS pool,
 CASE WHEN rtype IN ('search_page', 'profile', 'article', 'excluded_domain') THEN concat('matched_', rtype) WHEN rtype IN ('category_page', 'aggregator_page') THEN 'matched_category_page'
  WHEN rtype IN ('company_page', 'career_page') THEN 'matched_company_page' WHEN utype = 'unknown' OR rtype = 'unknown' THEN 'unknown_pattern' WHEN loc_rej THEN 'excluded_location'
  WHEN history_status = 'SEEN' THEN 'history_seen' WHEN match_score <> 0 AND match_score < 70 THEN 'low_score' ELSE '' END AS debug,
 CASE WHEN rtype IN ('search_page', 'category_page', 'career_page', 'company_page', 'article', 'excluded_domain', 'unknown') THEN rtype WHEN location_fit = 'excluded_far' THEN 'excluded_far'
  WHEN location_fit = 'unknown' AND NOT remote THEN 'unknown_location' ELSE 'passed' END AS collector FROM marked""")
def rejection_reason(spark, folder):
    rows = annotated(spark, folder)
    df = sel.write_back_selection(rows, sel.select_by_buckets(rows))
    picked = F.col("selection_rejection_reason") == "selected"
    return df.select("seq", F.col("selection_rejection_reason").alias("selection"), rs.pool_rejection(df, picked).alias("pool"),
                     rs.debug_rejection(df, tx.no()).alias("debug"), rs.collector_debug_rejection(df).alias("collector"))


@query("final_status", MARK + """
SELECT seq, CASE WHEN utype <> 'unknown' THEN utype WHEN rtype = 'job' THEN 'real_job' ELSE rtype END AS detected_type,
 CASE WHEN picked THEN 'email' WHEN rtype = 'job' AND utype = 'real_job' THEN 'candidate_pool' ELSE 'rejected' END AS final_status,
 CASE WHEN picked OR (rtype = 'job' AND utype = 'real_job') THEN 'accepted' ELSE 'rejected' END AS classification FROM marked""")
def final_status(spark, folder):
    rows = annotated(spark, folder)
    df = sel.write_back_selection(rows, sel.select_by_buckets(rows))
    final = rs.final_status(df, F.col("selection_rejection_reason") == "selected", tx.no())
    return df.select("seq", rs.detected_type(df).alias("detected_type"), final.alias("final_status"), rs.acceptance(final).alias("classification"))


# --- collector statistics --------------------------------------------------------------------------------

REAL = "(rtype = 'job' AND utype = 'real_job')"
ISREM = "(location_fit = 'remote' OR (remote AND location_fit <> 'allowed_local'))"
STATS = {
    "after_cleaner": REAL, "real_jobs": REAL, "accepted_urls": REAL, "rejected_urls": f"NOT {REAL}",
    "unknown_urls": f"NOT {REAL} AND (rtype = 'unknown' OR utype = 'unknown')",
    "allowed_local": f"{REAL} AND location_fit = 'allowed_local'", "remote": f"{REAL} AND {ISREM}",
    "excluded_far": f"{REAL} AND NOT {ISREM} AND location_fit = 'excluded_far'", "unknown_location": f"{REAL} AND NOT {ISREM} AND location_fit = 'unknown'",
    **{name: f"NOT {REAL} AND rtype = '{kind}'" for kind, name in (("search_page", "search_pages"), ("category_page", "category_pages"), ("career_page", "career_pages"),
                                                                    ("company_page", "company_pages"), ("article", "articles"), ("excluded_domain", "excluded_domains"))},
    "history_seen": f"{REAL} AND history_status = 'SEEN'", "history_updated": f"{REAL} AND history_status = 'UPDATED'", "history_new": f"{REAL} AND history_status = 'NEW'",
    "history_seen_status": f"{REAL} AND history_status = 'SEEN'", "history_resurfaced": f"{REAL} AND history_status = 'RESURFACED'",
    "country_restricted": "false", "worldwide_jobs": "false", "eu_jobs": "false", "rejected_by_country": f"{REAL} AND contains(neg, 'country')",
    "rejected_by_seniority": f"{REAL} AND (contains(neg, 'seniority') OR contains(neg, 'excluded title'))", "rejected_by_profile": f"{REAL} AND match_score < 70",
}
PCT = lambda part: f"CASE WHEN accepted_urls + rejected_urls = 0 THEN '0%' ELSE printf('%.1f%%', round_even({part} / (accepted_urls + rejected_urls) * 100, 1)) END"
STATS_CTES = POOL_BASE + [
    "raw_n AS (SELECT collector, count(*) AS collected FROM postings GROUP BY collector)",
    "ann_n AS (SELECT collector, " + ", ".join(f"{_c(cond)} AS {name}" for name, cond in STATS.items()) + " FROM ann GROUP BY collector)",
    "sel_n AS (SELECT collector, count(*) AS email_jobs FROM sel GROUP BY collector)",
    "st_1 AS (SELECT collector, coalesce(collected, 0) AS collected, " + ", ".join(f"coalesce({n}, 0) AS {n}" for n in STATS) +
    ", coalesce(email_jobs, 0) AS email_jobs FROM raw_n FULL OUTER JOIN ann_n USING (collector) FULL OUTER JOIN sel_n USING (collector))",
    f"stats AS MATERIALIZED (SELECT *, {PCT('accepted_urls')} AS pattern_coverage, {PCT('real_jobs')} AS real_job_ratio FROM st_1)",
    f"pool_n AS (SELECT collector, count(*) AS candidate_pool, {_c('rotation_eligible')} AS rotation_eligible, {_c(chr(115) + 'election_rejection_reason = ' + chr(39) + 'seen_recently' + chr(39))} AS seen_recently, "
    f"{_c('selection_reason = ' + chr(39) + 'FALLBACK_ROTATION' + chr(39))} AS fallback_rotation FROM pool_r GROUP BY collector)",
]
STATS_SQL = r.run(STATS_CTES, "")


def stats_tables(spark, folder, labelled=None):
    rows = annotated(spark, folder, labelled)
    selected = sel.select_by_buckets(rows)
    collected = ag.source_counts(postings(spark, folder), "collector").withColumnRenamed("n", "collected")
    return rows, selected, ag.collector_stats(collected, rows, selected)


@query("collector_stats", STATS_SQL + "SELECT " + ", ".join(ag.COLLECTOR_FIELDS) + " FROM stats")
def collector_stats(spark, folder):
    return stats_tables(spark, folder)[2]


@query("pool_rotation_counts", STATS_SQL + "SELECT * FROM pool_n")
def pool_rotation_counts(spark, folder):
    return ag.pool_rotation_counts(pool(spark, folder))


HEALTH = STATS_CTES + [
    "hj AS (SELECT s.*, CAST(coalesce(candidate_pool, 0) AS INTEGER) AS candidate_pool, CAST(coalesce(rotation_eligible, 0) AS INTEGER) AS rotation_eligible, CAST(coalesce(seen_recently, 0) AS INTEGER) AS seen_recently, "
    "CAST(coalesce(fallback_rotation, 0) AS INTEGER) AS fallback_rotation FROM stats s LEFT JOIN pool_n USING (collector))",
    "hs AS (SELECT *, CASE WHEN email_jobs > candidate_pool OR candidate_pool > real_jobs OR real_jobs > after_cleaner OR after_cleaner > collected THEN 'inconsistent' WHEN collected = 0 THEN 'no_results' "
    "WHEN real_jobs = 0 AND search_pages + category_pages + career_pages + company_pages > 0 THEN 'needs_detail_extraction' WHEN real_jobs = 0 AND collected > after_cleaner THEN 'cleaner_removed' "
    "WHEN real_jobs = 0 THEN 'no_real_jobs' WHEN email_jobs = 0 AND history_seen >= real_jobs THEN 'history_only' ELSE 'healthy' END AS collector_health_status FROM hj)",
    "health AS MATERIALIZED (SELECT *, CAST(CASE collector_health_status WHEN 'inconsistent' THEN 0 WHEN 'needs_detail_extraction' THEN 20 WHEN 'no_results' THEN 5 WHEN 'no_real_jobs' THEN 10 WHEN 'cleaner_removed' THEN 30 WHEN 'history_only' THEN 80 "
    "ELSE greatest(0, least(100, 85 + round_even(real_jobs / collected * 10, 0) + round_even(email_jobs / real_jobs * 5, 0) - least(20, (excluded_far + unknown_location) * 2))) END AS INTEGER) AS collector_health_score, "
    "CASE collector_health_status WHEN 'inconsistent' THEN 'Dashboard counts inconsistent: check source arrays' WHEN 'healthy' THEN concat(collector, ': Healthy, ', CASE WHEN fallback_rotation <> 0 THEN concat(fallback_rotation, ' jobs selected by FALLBACK_ROTATION') "
    "WHEN history_resurfaced <> 0 THEN concat(history_resurfaced, ' RESURFACED jobs') WHEN rotation_eligible <> 0 THEN concat(rotation_eligible, ' rotation_eligible jobs available') WHEN seen_recently <> 0 THEN concat(seen_recently, ' jobs skipped as seen_recently') "
    "WHEN history_new <> 0 THEN concat(history_new, ' NEW jobs') ELSE '?' END) ELSE '?' END AS recommendation FROM hs)",
]
HEALTH_SQL = r.run(HEALTH, "")


def health(spark, folder):
    labelled = classified(spark, folder, texts=False)
    rows, selected, stats = stats_tables(spark, folder, labelled)
    from siftworks.plans.curation import candidate_pool
    return stats, ag.collector_health(stats, candidate_pool(rows, selected, history(spark, folder, labelled), now()))


@query("stats_health_join", HEALTH_SQL + "SELECT collector, candidate_pool, rotation_eligible, seen_recently, fallback_rotation, CAST(email_jobs AS INTEGER) AS email FROM health")
def stats_health_join(spark, folder):
    return health(spark, folder)[1].select("collector", "candidate_pool", "rotation_eligible", "seen_recently", "fallback_rotation", "email")


@query("health_status_score", HEALTH_SQL + "SELECT collector, collector_health_status, collector_health_score, recommendation FROM health")
def health_status_score(spark, folder):
    return health(spark, folder)[1].select("collector", "collector_health_status", "collector_health_score", "recommendation")


@query("contribution_join", HEALTH_SQL + """SELECT collector, CAST(collected AS INTEGER) AS collected, CAST(real_jobs AS INTEGER) AS real_jobs, CAST(candidate_pool AS INTEGER) AS candidate_pool,
 CAST(email_jobs AS INTEGER) AS email_jobs, collector_health_status AS reason FROM health""")
def contribution_join(spark, folder):
    return ag.contribution(*health(spark, folder))


@query("stats_rollup", STATS_SQL + """SELECT CAST(sum(history_seen) AS BIGINT) AS seen_jobs, CAST(sum(allowed_local) AS BIGINT) AS allowed_local, CAST(sum(remote) AS BIGINT) AS remote,
 CAST(sum(unknown_location) AS BIGINT) AS unknown, CAST(sum(excluded_far) AS BIGINT) AS excluded_far FROM stats""")
def stats_rollup(spark, folder):
    return ag.stats_rollup(stats_tables(spark, folder)[2])


@query("next_resurfacing", STATS_SQL + "SELECT collector, 7 AS rotation_days FROM stats WHERE history_seen > 0")
def next_resurfacing(spark, folder):
    return ag.next_resurfacing(health(spark, folder)[1], 7)


@query("source_counts", s.with_postings() + "SELECT source, count(*) AS n FROM postings GROUP BY source")
def source_counts(spark, folder):
    return ag.source_counts(postings(spark, folder))


REMOVED = [t for t in fv.RESULT_TYPES if t != "job"]


@query("clean_summary", CLS + f"SELECT count(*) AS total_before, {_c('utype = ' + s.q('real_job') + ' AND rtype = ' + s.q('job'))} AS total_after, " + ", ".join(
    f"{_c(f'NOT {REAL} AND rtype = ' + s.q(t))} AS removed_{t}" for t in REMOVED) + " FROM cls")
def clean_summary(spark, folder):
    rows = jn.classify_results(normalized(spark, folder), BOOK.patterns, BOOK.clean)
    return ag.clean_summary(rows, cl.keep_by_mode(rows, "strict", BOOK.clean))


DEBUG_TYPES = ("search_page", "category_page", "career_page", "company_page", "article")
DEBUG_SUM = f"""SELECT collector, count(*) AS collected, {_c(REAL)} AS real_job, """ + ", ".join(f"{_c(f'NOT {REAL} AND rtype = ' + s.q(t))} AS {t}" for t in DEBUG_TYPES) + f""",
 {_c(f"NOT {REAL} AND rtype NOT IN ('search_page', 'category_page', 'career_page', 'company_page', 'article')")} AS unknown, {_c("location_fit = 'allowed_local'")} AS allowed_local, {_c(ISREM)} AS remote,
 {_c(f"NOT {ISREM} AND location_fit = 'excluded_far'")} AS excluded_far, {_c(f"NOT {ISREM} AND location_fit = 'unknown'")} AS unknown_location FROM cls GROUP BY collector"""


@query("debug_summary", CLS + DEBUG_SUM)
def debug_summary(spark, folder):
    return ag.debug_summary(jn.classify_results(normalized(spark, folder), BOOK.patterns, BOOK.clean))


@query("collector_debug", CLS + """SELECT seq, collector, rtype AS result_type, CASE WHEN rtype IN ('search_page', 'category_page', 'career_page', 'company_page', 'article', 'excluded_domain', 'unknown') THEN rtype
 WHEN location_fit = 'excluded_far' THEN 'excluded_far' WHEN location_fit = 'unknown' AND NOT remote THEN 'unknown_location' ELSE 'passed' END AS rejection_reason FROM cls""")
def collector_debug(spark, folder):
    from siftworks.plans.curation import collector_debug as plan
    return plan(postings(spark, folder), BOOK, now()).select("seq", "collector", "result_type", "rejection_reason")


URL_KEY = "CASE WHEN {u} <> '' THEN lower(trim({u})) ELSE concat_ws('|', collector, lower(trim(title)), lower(trim(company)), lower(trim(location))) END"


@query("debug_classification_join", MARK + f""", raw AS (SELECT *, {URL_KEY.format(u='url')} AS k, row_number() OVER (PARTITION BY {URL_KEY.format(u='url')} ORDER BY seq) > 1 AS dup FROM norm),
 last AS (SELECT * FROM (SELECT {URL_KEY.format(u='url')} AS k, utype, rtype, location_fit, remote, history_status, match_score, row_number() OVER (PARTITION BY {URL_KEY.format(u='url')} ORDER BY seq DESC) AS rn FROM ann) WHERE rn = 1),
 mailed AS (SELECT DISTINCT {URL_KEY.format(u='url')} AS k FROM sel),
 own AS (SELECT seq, utype AS own_utype, rtype AS own_rtype, upattern FROM cls),
 j AS (SELECT raw.seq, raw.dup, own.upattern, coalesce(last.utype, own.own_utype) AS utype, coalesce(last.rtype, own.own_rtype) AS rtype, coalesce(last.location_fit, raw.location_fit) AS fit, coalesce(last.remote, raw.remote) AS rem,
  coalesce(last.history_status, '') AS hst, coalesce(last.match_score, raw.match_score) AS ms, mailed.k IS NOT NULL AS sent FROM raw JOIN own USING (seq) LEFT JOIN last USING (k) LEFT JOIN mailed USING (k))
SELECT seq, upattern AS matched_pattern, CASE WHEN utype <> 'unknown' THEN utype WHEN rtype = 'job' THEN 'real_job' ELSE rtype END AS detected_type,
 CASE WHEN dup THEN 'rejected' WHEN sent THEN 'email' WHEN rtype = 'job' AND utype = 'real_job' THEN 'candidate_pool' ELSE 'rejected' END AS final_status,
 CASE WHEN dup THEN 'duplicate' WHEN rtype IN ('search_page', 'profile', 'article', 'excluded_domain') THEN concat('matched_', rtype) WHEN rtype IN ('category_page', 'aggregator_page') THEN 'matched_category_page'
  WHEN rtype IN ('company_page', 'career_page') THEN 'matched_company_page' WHEN utype = 'unknown' OR rtype = 'unknown' THEN 'unknown_pattern' WHEN fit = 'excluded_far' OR (fit = 'unknown' AND NOT rem) THEN 'excluded_location'
  WHEN hst = 'SEEN' THEN 'history_seen' WHEN ms <> 0 AND ms < 70 THEN 'low_score' ELSE '' END AS rejection_reason FROM j""")
def debug_classification_join(spark, folder):
    labelled = classified(spark, folder, texts=False)
    rows = annotated(spark, folder, labelled)
    out = jn.url_debug_rows(labelled, rows, sel.select_by_buckets(rows), BOOK.patterns, BOOK.clean)
    return out.select("seq", "matched_pattern", "detected_type", "final_status", "rejection_reason")


@query("funnel_stats", ANN + f"""SELECT (SELECT count(*) FROM postings) AS collected, count(*) AS after_dedup, {_c(REAL)} AS after_cleaning, {_c("location_fit = 'excluded_far'")} AS removed_far,
 {_c("location_fit = 'unknown' AND NOT remote")} AS removed_unknown, {_c("history_status = 'NEW'")} AS new_jobs FROM ann""")
def funnel_stats(spark, folder):
    df = annotated(spark, folder)
    fit = F.col("location_fit")
    flags = {"after_dedup": F.lit(True), "after_cleaning": cl.is_real_posting(df), "removed_far": fit == "excluded_far",
             "removed_unknown": (fit == "unknown") & ~F.col("remote"), "new_jobs": F.col("history_status") == "NEW"}
    total = postings(spark, folder).agg(F.count("*")).scalar()
    return ag.funnel(df, flags).select(total.alias("collected"), "*")


@query("run_stats_sink", MARK + f"""SELECT 'local_student' AS search_profile, (SELECT count(*) FROM postings) AS total_candidates, count(*) AS after_filters, {_c("history_status = 'NEW'")} AS new_jobs,
 {_c("history_status = 'UPDATED'")} AS updated_jobs, {_c("history_status = 'SEEN'")} AS seen_jobs, {_c("history_status = 'RESURFACED'")} AS resurfaced_jobs, {_c("history_status = 'SEEN' AND NOT picked")} AS seen_skipped FROM marked""")
def run_stats_sink(spark, folder):
    from siftworks.plans.curation import RunOptions, run_stats
    rows = annotated(spark, folder)
    stats = run_stats(postings(spark, folder), rows, sel.write_back_selection(rows, sel.select_by_buckets(rows)), RunOptions())
    path = scratch_path(spark, "stats")
    files.append_run_stats(stats, path)
    names = ["search_profile", "total_candidates", "after_filters", "new_jobs", "updated_jobs", "seen_jobs", "resurfaced_jobs", "seen_skipped"]
    return spark.read.schema("search_profile string, " + ", ".join(f"{n} bigint" for n in names[1:])).json(path).select(*names)
