"""Views of the given tables in the shape of the operators, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks.corpus import NOW, SOURCES
from siftworks.operators.skew import spread_rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


# URL shapes of the postings; two neighbouring documents share most of them, so
# canonicalisation creates duplicates.  Valid in both SQL dialects.
URL_SQL = """
CASE (doc_id // 2) % 13
 WHEN 0 THEN concat('https://it.indeed.com/viewjob?jk=', doc_id // 2, '&utm_source=feed')
 WHEN 1 THEN concat('https://www.randstad.it/offerte-lavoro/posizione_', doc_id // 2, '/')
 WHEN 2 THEN concat('https://www.randstad.it/offerte-lavoro/q-', doc_id // 2, '/')
 WHEN 3 THEN concat('https://it.talent.com/view?id=', doc_id // 2, CASE WHEN doc_id % 2 = 1 THEN '&FBCLID=abc' ELSE '' END)
 WHEN 4 THEN concat('HTTPS://WWW.GiGroup.it/offerte-lavoro-dettaglio/lavoro/', doc_id // 2, '#top')
 WHEN 5 THEN concat('https://www.subito.it/offerte-lavoro/annuncio-', doc_id // 2, '.htm')
 WHEN 6 THEN concat('https://lavoro.lidl.it/punti-vendita/', doc_id // 2)
 WHEN 7 THEN concat('https://comune.napoli.it/avviso/', doc_id // 2)
 WHEN 8 THEN concat('https://', source, '.example.com/', lang, '/a/b/', doc_id // 2, '?Q=a+b&x=%20y~*&k')
 WHEN 9 THEN concat('https://duckduckgo.com/l/?uddg=https%3A%2F%2Fit.jooble.org%2Fjdp%2F', doc_id // 2, '%3Futm_campaign%3Dz')
 WHEN 10 THEN ''
 WHEN 11 THEN concat('https://www.adecco.it/lavora-con-noi?step=', doc_id // 2)
 ELSE concat('https://it.linkedin.com/jobs/search?keywords=data&n=', doc_id // 2)
END"""

POSTINGS_SQL = f"""
SELECT doc_id AS seq,
 {{pick_source}} AS source,
 source AS company,
 concat('site_', n_chars % 7) AS collector,
 lang,
 trim(regexp_extract(text, {{sentence}}, 1)) AS title,
 CASE lang WHEN 'en' THEN 'Napoli' WHEN 'fr' THEN 'Milano' WHEN 'de' THEN 'Remote' ELSE '' END AS location,
 CASE doc_id % 3 WHEN 0 THEN 'data entry Napoli' WHEN 1 THEN 'free work' ELSE '' END AS query,
 concat(text, CASE WHEN doc_id % 5 = 0 THEN ' salary $30000 - $50,000' WHEN doc_id % 5 = 1 THEN ' from 1200 eur' ELSE '' END) AS description,
 {URL_SQL} AS url,
 '2026-06-21T00:00:00+00:00' AS found_at,
 n_chars
FROM documents"""


def postings_sql() -> str:
    names = ", ".join(f"'{s}'" for s in SOURCES)
    return POSTINGS_SQL.format(pick_source=f"([{names}])[1 + doc_id % 12]", sentence=r"'^([^.!?\n]*)'")


def postings(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as postings, spread before any work on their texts."""
    names = ", ".join(f"'{s}'" for s in SOURCES)
    pick = f"element_at(array({names}), cast(1 + doc_id % 12 as int))"
    # The first sentence by byte searches: a pattern would first decode the whole text.
    sentence = "text"
    for end in (".", "!", "?", r"\n"):
        sentence = f"substring_index({sentence}, '{end}', 1)"
    body = POSTINGS_SQL.replace("regexp_extract(text, {sentence}, 1)", sentence).format(pick_source=pick).replace("doc_id // 2", "(doc_id div 2)")
    return spark.sql(body.replace("FROM documents", "FROM {documents}"), documents=spread_rows(table(spark, folder, "documents"), "doc_id", "n_chars"))


def threads(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as community posts: every turn is a post."""
    return spark.sql(THREADS_SQL.format(sentence=r"'^([^.!?\\n]*)'").replace("FROM conversations", "FROM {conversations}").replace(
        "conv_id // 10", "(conv_id div 10)"), conversations=table(spark, folder, "conversations"))


THREADS_SQL = """
SELECT conv_id * 1000 + turn AS seq,
 trim(regexp_extract(text, {sentence}, 1)) AS title,
 text AS body,
 '' AS summary,
 CASE WHEN turn % 2 = 0 THEN concat('https://forum.example.com/t/', conv_id // 10) ELSE '' END AS url,
 concat('sub', conv_id % 5) AS subreddit,
 role AS author,
 concat('query ', conv_id % 4) AS query,
 conv_id % 4 AS query_seq,
 concat('2026-0', 1 + conv_id % 6, '-1', turn % 10, 'T08:00:00Z') AS created_at
FROM conversations"""


def threads_sql() -> str:
    return THREADS_SQL.format(sentence=r"'^([^.!?\n]*)'")


def normalized(spark: SparkSession, folder: str, profile: str = "local_student", only: DataFrame | None = None, **more: bool) -> DataFrame:
    """Postings, or those of them whose ``seq`` is in ``only``, with all labels and scores; ``more``: see normalize_posting."""
    from checks.corpus import BOOK
    from siftworks.operators.projections import normalize_posting
    rows = postings(spark, folder)
    return normalize_posting(rows if only is None else rows.join(only, "seq", "left_semi"), BOOK, profile, now=now(), **more)


def history(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """History of an earlier run: the labelled documents were sent then.

    Documents with toxic = 1 have changed since, those with quality = 0 were
    recorded but never sent.
    """
    from siftworks.functions import identity as ident
    from siftworks.operators.dedup import keep_first
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    if rows is None:  # only the labelled postings are needed, so only they are labelled and scored
        rows = normalized(spark, folder, only=labels.select(F.col("doc_id").alias("seq")), hashed=True)
    elif not {"job_id", "content_hash"} <= set(rows.columns):
        rows = rows.withColumn("job_id", ident.job_id(rows)).withColumn("content_hash", ident.content_hash(rows))
    sent = rows.join(labels, F.col("seq") == F.col("doc_id"))
    first = keep_first(sent, ["job_id"], ["seq"])
    day = F.date_format(F.date_sub(F.to_date(now()), (F.col("n_chars") % 20).cast("int")), "yyyy-MM-dd'T'06:00:00'Z'")
    return first.select(
        "job_id", "url", "title", "source", F.lit("2026-05-01T00:00:00Z").alias("first_seen"), day.alias("last_seen"),
        F.when(F.col("quality") == 0, "").otherwise(day).alias("last_sent"),
        F.when(F.col("quality") == 0, 0).otherwise(1 + F.col("n_chars") % 3).cast("int").alias("sent_count"),
        F.when(F.col("toxic") == 1, "changed").otherwise(F.col("content_hash")).alias("content_hash"),
        F.col("match_score"))


def classified(spark: SparkSession, folder: str, texts: bool = True) -> DataFrame:
    """Labelled, classified and hashed postings, written once for all that a query derives from them; ``texts``: with the descriptions."""
    from siftworks.session import written
    rows = normalized(spark, folder, typed=True, hashed=True)
    return written(rows if texts else rows.drop("description"), "classified")


def annotated(spark: SparkSession, folder: str, rows: DataFrame | None = None, texts: bool = False) -> DataFrame:
    """Deduplicated, classified and history-annotated postings (the selection input); ``rows``: the classified ones.

    Labels, scores and hashes stand on the rows, so only what reads the descriptions again (``texts``) moves them.
    """
    from siftworks.operators import dedup, history as hs
    from siftworks.session import written
    # The history of this view is derived from the same postings, so label them once.
    rows = classified(spark, folder, texts) if rows is None else rows
    if not texts:
        rows = rows.drop("description")
    # A query may start several branches here: written once in each query, and never read by another one.
    return written(hs.annotate_history(dedup.dedup_postings(rows), history(spark, folder, rows), now(), hashed=True), "annotated")
