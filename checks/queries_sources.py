"""Sources, sinks, extraction, unions and community posts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as s, sql_run as r
from checks.corpus import BOOK, NOW, SOURCES
from checks.queries_rules import SITE
from checks.registry import query
from checks.views import normalized, now, postings, table, threads
from siftworks.functions import classify as cl, reasons as rs, scoring as sc, text as tx, urls
from siftworks.operators import aggregates as ag, dedup, projections as pj, selection as sel, sets
from siftworks.session import scratch_path
from siftworks.sources import catalog, files, pages as pg, payloads as pl

P = s.with_postings
LANDED = ("seq", "title", "company", "location", "url", "description")


@query("csv_landing_scan", P() + "SELECT seq, title, company, location, url, description FROM postings")
def csv_landing_scan(spark, folder):
    path = scratch_path(spark, "csv")
    files.write_csv(postings(spark, folder), path, LANDED)
    df = files.read_csv(spark, path, "seq bigint, title string, company string, location string, url string, description string")
    return df.select("seq", *[tx.field(df, c).alias(c) for c in LANDED[1:]])


@query("csv_report_sink", P() + "SELECT CAST(seq AS VARCHAR) AS seq, title, url, '' AS salary, description FROM postings")
def csv_report_sink(spark, folder):
    path, columns = scratch_path(spark, "report"), ("seq", "title", "url", "salary", "description")
    files.write_csv(postings(spark, folder), path, columns)
    df = files.read_csv(spark, path, ", ".join(f"{c} string" for c in columns))
    return df.select(*[tx.field(df, c).alias(c) for c in columns])


@query("json_report_sink", P() + "SELECT seq, title, description, NULL::VARCHAR AS company FROM postings")
def json_report_sink(spark, folder):
    path = scratch_path(spark, "json")
    files.write_json(postings(spark, folder).select("seq", "title", "description", F.lit(None).cast("string").alias("company")), path)
    return spark.read.schema("seq bigint, title string, description string, company string").json(path)


@query("json_array_scan", P() + "SELECT seq, title, url FROM postings")
def json_array_scan(spark, folder):
    # Exports of at most 500 rows each, one JSON list per file.
    lists = postings(spark, folder).groupBy(F.expr("seq div 500").alias("part")).agg(
        F.to_json(F.collect_list(F.struct("seq", "title", "url"))).alias("value"))
    path = scratch_path(spark, "lists")
    lists.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.read_json_array(spark, path, "seq bigint, title string, url string")


@query("rule_table_load", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT 'positive' AS rule_set, {i} AS seq, {s.q(p)} AS phrase, {n} AS points, (SELECT count(*) FROM documents WHERE {s.has_word('lower(text)', p)}) AS documents"
    for i, (p, n) in enumerate(BOOK.weighted.positive)) + ")")
def rule_table_load(spark, folder):
    rules = BOOK.weighted.table(spark).filter("rule_set = 'positive'")
    texts = tx.settle(table(spark, folder, "documents").select("doc_id", "text"), {"low": F.lower("text")})
    found = tx.find_phrases(texts, "low", [p for p, _ in BOOK.weighted.positive], "found")
    counts = found.select(F.explode("found").alias("phrase")).groupBy("phrase").agg(F.count("*").alias("documents"))
    return counts.join(rules, "phrase", "right").select(
        "rule_set", "seq", "phrase", "points", F.coalesce("documents", F.lit(0)).alias("documents"))


@query("source_catalog_flatten", """
SELECT r_name AS "group", CAST(r_regionkey AS INTEGER) AS group_seq, s_suppkey AS seq, s_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal > 0""")
def source_catalog_flatten(spark, folder):
    nation = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    rows = table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    regions = {name: key for key, name in enumerate(("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))}
    groups = {name: rows.filter(F.col("n_regionkey") == key).select(
        F.col("s_suppkey").alias("seq"), F.col("s_name").alias("name"), (F.col("s_acctbal") > 0).alias("enabled")) for name, key in regions.items()}
    return catalog.flatten_sources(groups).select("group", "group_seq", "seq", "name")


@query("query_catalog", """
WITH l AS (SELECT p_type AS query, 0 AS list_seq, p_partkey AS seq FROM part UNION ALL SELECT concat('"', p_brand, '" remote job'), 1, p_partkey FROM part UNION ALL SELECT p_brand, 2, p_partkey FROM part)
SELECT query, list_seq, seq FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY list_seq, seq) AS rn FROM l) WHERE rn = 1""")
def query_catalog(spark, folder):
    part = table(spark, folder, "part")
    lists = [part.select(F.col(c).alias("query"), F.col("p_partkey").alias("seq")) for c in ("p_type", "p_brand", "p_brand")]
    return catalog.distinct_queries(lists, ["%s", '"%s" remote job', "%s"])


@query("crawl_plan", r"""
WITH t AS (SELECT p_type AS query, min(p_partkey) AS seq FROM part GROUP BY p_type), e AS (SELECT *, replace(url_encode(query), '%20', '+') AS enc, trim(regexp_replace(lower(query), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM t)
SELECT query, site, CASE site WHEN 'indeed' THEN concat('https://it.indeed.com/jobs?q=', enc) WHEN 'talent' THEN concat('https://it.talent.com/jobs?k=', enc) WHEN 'jooble' THEN concat('https://it.jooble.org/SearchResult?ukw=', enc)
 WHEN 'subito' THEN concat('https://www.subito.it/annunci-campania/vendita/offerte-lavoro/?q=', enc) WHEN 'adecco' THEN concat('https://www.adecco.it/lavoro/?k=', enc) WHEN 'google' THEN concat('https://www.google.com/search?q=', enc)
 WHEN 'github' THEN concat('https://api.github.com/search/issues?q=', enc) WHEN 'randstad' THEN concat('https://www.randstad.it/offerte-lavoro/q-', slug, '/')
 ELSE concat('https://www.gigroup.it/offerte-lavoro/?job=', enc, '&placeOfWork=&radius=25') END AS search_url, "offset"
FROM e, (SELECT unnest(['indeed','talent','jooble','subito','adecco','google','github','randstad','gigroup']) AS site) x, (SELECT CAST(unnest(range(0, 981, 20)) AS INTEGER) AS "offset") o""")
def crawl_plan(spark, folder):
    queries = table(spark, folder, "part").select(F.col("p_type").alias("query")).distinct()
    return catalog.plan_pages(catalog.plan_searches(queries), 0, 980, 20).select("query", "site", "search_url", "offset")


# --- payloads and feeds -----------------------------------------------------------------------

LINES_SQL = "lines AS (SELECT doc_id, lang, source, unnest(str_split(text, chr(10))) AS line, CAST(generate_subscripts(str_split(text, chr(10)), 1) - 1 AS INTEGER) AS item_no FROM documents)"


def lines(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "lang", "source", F.split("text", "\n").alias("lines"))


# Every payload rule over the lines of a text: item struct, path of the list, output columns (title, company, location, url), SQL of location and URL.
SEE = "concat('https://see.example/', doc_id, '/', item_no)"
APIS = {
    "remotejobs_org": ("data", ("title", "company", "location", "url"), "lang", SEE),
    "himalayas": ("jobs", ("title", "company", "location", "url"), "concat(lang, ', eu')", f"CASE WHEN item_no % 2 = 0 THEN concat('https://apply.example/', item_no) ELSE {SEE} END"),
    "arbeitnow": ("data", ("title", "company", "location", "url"), "lang", SEE),
    "jobicy": ("jobs", ("title", "company", "location", "url"), "lang", SEE),
    "remotefirstjobs": ("jobs", ("title", "company", "location", "url"), "concat(lang, ', eu')", SEE),
    "remotive": ("jobs", ("title", "company_name", "candidate_required_location", "url"), "lang", SEE),
    "reddit_listing": ("data.children.data", ("title", "author", "selftext", "url"), "lang", "concat('https://www.reddit.com/r/', doc_id, '/', item_no)"),
    "reddit_search": ("data.children.data", ("title", "author", "body", "url"), "lang", f"CASE WHEN item_no % 2 = 0 THEN concat('/r/', doc_id, '/', item_no) ELSE {SEE} END"),
    "github_issues": ("items", ("title", "body", "state", "html_url"), "lang", SEE),
}


def payload_item(api, x, i):
    """One item of an API's payload, in that API's own field names."""
    number, company, place = i.cast("string"), F.col("source"), F.col("lang")
    at = lambda prefix: F.concat(F.lit(prefix), F.col("doc_id").cast("string"), F.lit("/"), number)
    see, both = at("https://see.example/"), F.array(place, F.lit("eu"))
    fields = {
        "remotejobs_org": {"title": x, "company": F.struct(company.alias("name")), "location": place, "url": F.lit(""), "apply_url": see},
        "himalayas": {"title": x, "companyName": company, "locationRestrictions": both, "url": see, "pubDate": F.lit(1_700_000_000),
                      "applicationLink": F.when(i % 2 == 0, F.concat(F.lit("https://apply.example/"), number)).otherwise("")},
        "arbeitnow": {"title": x, "company_name": company, "location": place, "remote": F.lit(True), "url": see, "tags": both},
        "jobicy": {"jobTitle": x, "companyName": company, "jobGeo": place, "url": see, "jobType": both},
        "remotefirstjobs": {"title": x, "company_name": company, "locations": both, "url": see, "salary_min": F.lit(1)},
        "remotive": {"title": x, "company_name": company, "candidate_required_location": place, "url": see},
        "reddit_listing": {"title": x, "author": company, "selftext": place, "permalink": at("/r/"), "score": F.lit(1)},
        "reddit_search": {"title": x, "author": company, "selftext": place, "permalink": at("/r/"), "url": F.when(i % 2 == 0, "").otherwise(see)},
        "github_issues": {"title": x, "body": company, "state": place, "html_url": see, "labels": F.array(F.struct(place.alias("name")))},
    }[api]
    item = F.struct(*[v.alias(n) for n, v in fields.items()])
    return F.struct(item.alias("data")) if api.startswith("reddit") else item


def item_of(api):
    return lambda x, i: payload_item(api, x, i)


@query("json_payload_flatten", "WITH " + LINES_SQL + " " + " UNION ALL ".join(
    f"SELECT doc_id, '{api}' AS api, item_no, line AS title, source AS company, {place} AS location, {url} AS url FROM lines" for api, (_, _, place, url) in APIS.items()))
def json_payload_flatten(spark, folder):
    df, out = lines(spark, folder), None
    for api, (path, names, _, _) in APIS.items():
        items = F.transform("lines", item_of(api))
        body = F.struct(F.struct(items.alias("children")).alias("data")) if api.startswith("reddit") else F.struct(items.alias(path))
        rows = pl.flatten_payload(df.select("doc_id", F.lit(api).alias("api"), F.to_json(body).alias("payload")), pl.PAYLOAD_RULES[api])
        part = rows.select("doc_id", "api", "item_no", *[F.col(n).alias(c) for n, c in zip(names, ("title", "company", "location", "url"))])
        out = part if out is None else out.unionByName(part)
    return out


SPLIT = """CASE WHEN instr({t}, ' at ') > 0 THEN trim(substr({t}, 1, instr({t}, ' at ') - 1)) WHEN instr({t}, ' - ') > 0 THEN trim(substr({t}, 1, instr({t}, ' - ') - 1)) ELSE trim({t}) END AS title,
 CASE WHEN instr({t}, ' at ') > 0 THEN trim(substr({t}, instr({t}, ' at ') + 4)) WHEN instr({t}, ' - ') > 0 THEN trim(substr({t}, instr({t}, ' - ') + 3)) ELSE '' END AS company"""


@query("feed_item_extract", "WITH " + LINES_SQL + ", f AS (SELECT doc_id, item_no, source, trim(line) AS t FROM lines) SELECT 'rss' AS kind, doc_id, item_no, " + SPLIT.format(t="t") +
       ", concat('https://feed.example/?a=', doc_id, '&b=', item_no) AS url FROM f UNION ALL SELECT 'atom', doc_id, item_no, t, source,"
       " CASE WHEN item_no % 2 = 0 THEN concat('https://feed.example/?a=', doc_id, '&b=', item_no) ELSE concat('urn:', doc_id, ':', item_no) END FROM f")
def feed_item_extract(spark, folder):
    safe = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    df = lines(spark, folder)
    items = F.transform("lines", lambda x, i: F.concat(
        F.lit("<item><title>"), safe(x), F.lit("</title><link>https://feed.example/?a="), F.col("doc_id").cast("string"),
        F.lit("&amp;b="), i.cast("string"), F.lit("</link><pubDate>Mon, 01 Jun 2026 08:00:00 +0000</pubDate><description>d</description></item>")))
    xml = F.concat(F.lit("<rss version='2.0'><channel><title>c</title>"), F.array_join(items, ""), F.lit("</channel></rss>"))
    link = lambda i: F.concat(F.lit("<link rel='self' href='x'/>"), F.when(i % 2 == 0, F.concat(
        F.lit("<link rel='alternate' href='https://feed.example/?a="), F.col("doc_id").cast("string"), F.lit("&amp;b="), i.cast("string"), F.lit("'/>"))).otherwise(""))
    entries = F.transform("lines", lambda x, i: F.concat(
        F.lit("<entry><title>"), safe(x), F.lit("</title>"), link(i), F.lit("<id>urn:"), F.col("doc_id").cast("string"), F.lit(":"), i.cast("string"),
        F.lit("</id><updated>2026-06-01T08:00:00Z</updated><author><name>"), F.col("source"), F.lit("</name></author></entry>")))
    atom = F.concat(F.lit("<feed><title>c</title>"), F.array_join(entries, ""), F.lit("</feed>"))
    rss = pl.rss_items(df.select("doc_id", xml.alias("xml"))).select(F.lit("rss").alias("kind"), "doc_id", "item_no", "title", "company", "url")
    other = pl.atom_entries(df.select("doc_id", atom.alias("xml"))).select(F.lit("atom").alias("kind"), "doc_id", "item_no", "title", F.col("author").alias("company"), "url")
    return rss.unionByName(other)


@query("split_title_company", "WITH f AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1)::INTEGER - 1 AS line FROM documents) "
       "SELECT doc_id, line, " + SPLIT.format(t="t") + " FROM f")
def split_title_company(spark, folder):
    df = table(spark, folder, "documents")
    lines = df.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "t"))
    title, company = tx.split_title(F.col("t"))
    return lines.select("doc_id", "line", title.alias("title"), company.alias("company"))


HIT_SQL = "hits AS (SELECT seq, title, query, description, CASE WHEN seq % 3 = 0 THEN url ELSE '' END AS href, CASE WHEN seq % 3 = 1 THEN url ELSE '' END AS link0, url, CASE WHEN seq % 5 = 0 THEN '' ELSE description END AS body FROM postings)"


@query("search_hit_project", P("h AS (SELECT seq, CASE WHEN seq % 4 = 0 THEN '' ELSE title END AS title, CASE WHEN seq % 3 < 2 THEN url ELSE '' END AS u0, description FROM postings)", s.canon_ctes("h", "hc", "u0")) +
       "SELECT seq, title, curl AS url, description AS snippet FROM hc WHERE curl <> '' OR title <> ''")
def search_hit_project(spark, folder):
    df = postings(spark, folder)
    third = F.col("seq") % 3
    hits = df.select("seq", F.when(F.col("seq") % 4 == 0, "").otherwise(F.col("title")).alias("title"), F.when(third == 0, F.col("url")).otherwise("").alias("href"),
                     F.when(third == 1, F.col("url")).otherwise("").alias("link"), F.when(F.col("seq") % 5 == 0, "").otherwise(F.col("description")).alias("body"),
                     F.col("description").alias("snippet"))
    return pl.project_hits(hits).select("seq", "title", "url", "snippet")


# --- landed sources and unions -------------------------------------------------------------------

def landed(spark, folder):
    df = postings(spark, folder).withColumn("score", (F.col("seq") % 9).cast("string"))
    names = {"reddit": {"subreddit": "company", "selftext": "description"}, "remotive": {"company_name": "company", "candidate_required_location": "location"}}
    frames = []
    for source in SOURCES:
        rows = df.filter(F.col("source") == source)
        renamed = names.get(source, {})
        rows = rows.select("seq", "title", "url", "query", "score", *[F.col(old).alias(new) for new, old in renamed.items()],
                           *[c for c in ("company", "location", "description") if c not in renamed.values() and not (c == "location" and source == "duckduckgo")],
                           *([F.lit("sec").alias("sector"), F.lit("rol").alias("role"), F.lit("con").alias("contract")] if "description" in pj.LANDED_SOURCES[source] and "sector" in pj.LANDED_SOURCES[source]["description"] else []))
        frames.append(pj.normalize_landed(rows, source))
    return frames


@query("normalize_landed_sources", P() + """
SELECT seq, source, title, company, CASE source WHEN 'reddit' THEN 'remote' WHEN 'duckduckgo' THEN 'Italy' ELSE location END AS location, url,
 CASE WHEN source = 'remotefirstjobs' THEN concat(query, ' ', description) WHEN source IN ('smartjobspa', 'attalgroup', 'direzionelavoro') THEN concat('sec rol con ', description) ELSE description END AS description,
 CAST(CASE WHEN source = 'reddit' THEN seq % 9 ELSE 0 END AS INTEGER) AS source_score FROM postings""")
def normalize_landed_sources(spark, folder):
    return sets.union_sources(landed(spark, folder)).drop("source_seq")


@query("union_sources", P() + f"SELECT seq, source, CAST(list_position({s.arr(SOURCES)}, source) - 1 AS INTEGER) AS source_seq FROM postings")
def union_sources(spark, folder):
    return sets.union_sources(landed(spark, folder)).select("seq", "source", "source_seq")


@query("union_collectors", """SELECT 'documents' AS collector, doc_id AS id, text AS title, 0 AS source_seq FROM documents UNION ALL SELECT 'pages', page_id, url, 2 FROM pages
 UNION ALL SELECT 'benchmark', item_id, text, 3 FROM benchmark""")
def union_collectors(spark, folder):
    get = lambda name, key, title: table(spark, folder, name).select(F.col(key).alias("id"), F.col(title).alias("title"))
    frames = {"documents": get("documents", "doc_id", "text"), "broken": None, "pages": get("pages", "page_id", "url"), "benchmark": get("benchmark", "item_id", "text")}
    return sets.union_collectors(frames).select("collector", "id", "title", "source_seq")


@query("union_else_fallback", """WITH p AS (SELECT source AS site, doc_id FROM documents WHERE contains(text, 'Apache')), f AS (SELECT source AS site, doc_id FROM documents WHERE contains(text, 'license'))
SELECT site, doc_id FROM p UNION ALL SELECT site, doc_id FROM f WHERE site NOT IN (SELECT site FROM p)""")
def union_else_fallback(spark, folder):
    df = table(spark, folder, "documents").select(F.col("source").alias("site"), "doc_id", "text")
    have = lambda word: df.filter(F.contains("text", F.lit(word))).select("site", "doc_id")
    return sets.union_else_fallback(have("Apache"), have("license"), "site")


@query("global_hit_cap", P() + "SELECT seq, query FROM postings ORDER BY seq % 3, seq LIMIT 60")
def global_hit_cap(spark, folder):
    df = postings(spark, folder).select("seq", "query", (F.col("seq") % 3).alias("query_seq"), F.col("seq").alias("hit_seq"))
    return sel.hit_cap(df, 20, 3).select("seq", "query")


# --- site hits ----------------------------------------------------------------------------------------

WIDE = "site IN ('talent', 'jooble', 'gigroup', 'randstad')"
SFLAG, SREASON = r.remote_sql([("title", "title"), ("description", "wdesc"), ("snippet", "snip"), ("url", "wurl")])
SITE_CTES = [s.canon_ctes(), f"""sh AS (SELECT seq, title, query, curl AS url, {SITE.replace('url', 'curl')} AS site, description AS d FROM canon)""",
             f"""sn AS (SELECT *, CASE WHEN site IN ('gigroup', 'randstad') THEN concat_ws(' ', '', '', '', '', '', '', '', d, '', '') ELSE d END AS snip,
 CASE WHEN site IN ('talent', 'jooble') THEN d ELSE '' END AS wdesc, CASE WHEN {WIDE} THEN url ELSE '' END AS wurl, CASE WHEN site IN ('gigroup') THEN 'Gi Group' ELSE '' END AS company,
 CASE WHEN site IN ('indeed', 'subito', 'adecco', 'talent', 'jooble', 'duckduckgo') THEN query ELSE '' END AS asked FROM sh)""",
             f"""sx AS MATERIALIZED (SELECT *, lower(concat_ws(' ', title, snip)) AS lt, lower(concat_ws(' ', title, snip, asked)) AS la, lower(concat_ws(' ', title, snip, company, '', query)) AS le FROM sn)""",
             f"""sy AS MATERIALIZED (SELECT *, {SFLAG} AS remote, {SREASON} AS remote_reason, {s.any_of('la', BOOK.posting.part_time)} AS part_time, {r.category_sql('lt')} AS category, {r.base_score_sql('la')} AS score FROM sx)"""]


def site_hits(spark, folder):
    df = postings(spark, folder)
    typed = df.select("seq", "title", "query", F.col("url").alias("raw"), F.col("description").alias("snippet"))
    typed = tx.settle(typed, {"url": urls.canonical_url(F.col("raw"))})
    return typed.select("seq", "title", "query", "url", "snippet", F.expr(SITE).alias("site"))


@query("normalize_site_hits", P(*SITE_CTES) + f"SELECT seq, site, url, company, remote, remote_reason, part_time, category, score, {r.bucket_sql('le')} AS priority_bucket FROM sy")
def normalize_site_hits(spark, folder):
    return pj.normalize_site_hits(site_hits(spark, folder), BOOK).select(
        "seq", "site", "url", "company", "remote", "remote_reason", "part_time", "category", "score", "priority_bucket")


@query("site_collection")
def site_collection(spark, folder):
    from siftworks.plans.collection import site_collection as plan
    hits = site_hits(spark, folder).withColumns({"query_seq": F.col("seq") % 3, "hit_seq": F.col("seq")})
    direct = hits.filter(~F.contains(F.lower("snippet"), F.lit("license")))
    fallback = hits.filter(F.contains(F.lower("snippet"), F.lit("license")))
    return plan(direct, fallback, BOOK, top=80, part_time_first=True).select("seq", "site", "url", "score", "priority_bucket")


@query("merge_detail_fields", P(s.canon_ctes(), "marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id)",
       "det AS (SELECT * FROM (SELECT curl, quality, CASE WHEN toxic = 1 THEN '' ELSE concat('detail ', title) END AS description, row_number() OVER (PARTITION BY curl ORDER BY seq) AS rn FROM canon JOIN marks ON seq = doc_id WHERE curl <> '') WHERE rn = 1)") +
       """SELECT c.seq, CASE WHEN coalesce(d.description, '') <> '' THEN d.description ELSE c.description END AS description, CASE WHEN c.location <> '' THEN c.location WHEN d.curl IS NOT NULL THEN 'Detail town' ELSE '' END AS location,
 c.company, coalesce(d.quality = 1, false) AS smart_working FROM canon c LEFT JOIN det d USING (curl)""")
def merge_detail_fields(spark, folder):
    df = postings(spark, folder)
    listing = tx.settle(df.select("seq", "title", "location", "company", "description", F.col("url").alias("raw")), {"url": urls.canonical_url(F.col("raw"))})
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    known = dedup.keep_first(listing.filter("url <> ''").join(labels, F.col("seq") == F.col("doc_id")), ["url"], ["seq"])
    detail = known.select(
        "url", F.when(F.col("toxic") == 1, "").otherwise(F.concat(F.lit("detail "), "title")).alias("description"), F.lit("Detail town").alias("location"),
        F.lit("Detail firm").alias("company"), (F.col("quality") == 1).alias("smart_working"))
    return pj.merge_details(listing, detail).select("seq", "description", "location", "company", "smart_working")


# --- page texts -----------------------------------------------------------------------------------------

_ent = lambda x: f"replace(replace(replace(replace({x}, '&quot;', chr(34)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
VISIBLE = s.squeeze(_ent(r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?i)</(p|div|li|section|article|h[1-6])>', '. ', 'g'), '<[^>]+>', ' ', 'g')"""))
PLAIN = s.squeeze(_ent("regexp_replace(html, '<[^>]+>', ' ', 'g')"))


@query("html_text", f"SELECT page_id, {VISIBLE} AS visible, {PLAIN} AS plain, {s.squeeze(_ent('regexp_extract(html, ' + s.q('(?is)<h1[^>]*>(.*?)</h1>') + ', 1)'))} AS heading FROM pages")
def html_text(spark, folder):
    html = F.col("html")
    return table(spark, folder, "pages").select("page_id", tx.visible_text(html).alias("visible"), tx.plain_text(html).alias("plain"),
                                                tx.extract_text(html, r"(?is)<h1[^>]*>(.*?)</h1>").alias("heading"))


@query("html_detail_extract", f"""WITH v AS (SELECT page_id, {VISIBLE} AS description FROM pages) SELECT page_id, description, regexp_matches(lower(description), '(^|[^\\p{{L}}\\p{{N}}_])(smart working|full remote|remoto|lavoro da casa|ibrid[oa])([^\\p{{L}}\\p{{N}}_]|$)') AS smart_working,
 regexp_matches(lower(description), '(^|[^\\p{{L}}\\p{{N}}_])(full time|tempo pieno)([^\\p{{L}}\\p{{N}}_]|$)') AS full_time, 'Gi Group' AS company, array_to_string(list_filter({s.arr(pg.DETAIL_SKILLS['gigroup'])}, lambda t: contains(lower(description), t)), ', ') AS skills FROM v""")
def html_detail_extract(spark, folder):
    return pg.detail_fields(table(spark, folder, "pages"), "gigroup").select("page_id", "description", "smart_working", "full_time", "company", "skills")


@query("label_value")
def label_value(spark, folder):
    df = tx.settle(table(spark, folder, "pages"), {"text": tx.visible_text(F.col("html"))})
    names = ("the", "que", "die", "los")
    return df.select("page_id", tx.label_value(F.col("text"), names).alias("value"))


SEGMENT = "list_extract(str_split(rtrim(url, '/'), '/'), -1)"


@query("slug_title", P() + f"""SELECT seq, {s.squeeze(f"replace(split_part({SEGMENT}, '_', 1), '-', ' ')")} AS plain, {s.squeeze(f"replace(regexp_replace(split_part({SEGMENT}, '_', 1), '\\d+$', ''), '-', ' ')")} AS without_number,
 {s.squeeze(f"replace(replace(regexp_replace({SEGMENT}, '-\\d+\\.htm$', ''), '.htm', ''), '-', ' ')")} AS without_suffix, trim(regexp_replace(lower(trim(title)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM postings""")
def slug_title(spark, folder):
    url = F.col("url")
    return postings(spark, folder).select(
        "seq", tx.title_from_url(url).alias("plain"), tx.title_from_url(url, drop_number=True).alias("without_number"),
        tx.title_from_url(url, cut_underscore=False, drop_suffix=".htm").alias("without_suffix"), tx.slug(F.col("title")).alias("slug"))


@query("snippet_cut", f"""WITH t AS (SELECT doc_id, {s.squeeze('text')} AS x FROM documents) SELECT doc_id, CASE WHEN length(x) <= 500 THEN x ELSE concat(regexp_replace(left(x, 500), ' [^ ]*$', ''), '...') END AS snippet,
 CASE WHEN length(x) <= 80 THEN x ELSE regexp_replace(left(x, 80), ' [^ ]*$', '') END AS teaser FROM t""")
def snippet_cut(spark, folder):
    return table(spark, folder, "documents").select("doc_id", tx.cut_at_word(F.col("text"), 500, "...").alias("snippet"), tx.cut_at_word(F.col("text"), 80).alias("teaser"))


@query("embedded_json", "SELECT event_id, coalesce(CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END, '') AS k FROM events")
def embedded_json(spark, folder):
    df = table(spark, folder, "events")
    body = F.when(F.col("event_type") == "error", "{bad").otherwise(F.replace("props", F.lit('"'), F.lit("&quot;")))
    attrs = F.concat(F.lit(" class=\"x\" data-job='"), body, F.lit("'"))
    return df.select("event_id", pg.embedded_value(pg.data_job(attrs), "k").alias("k"))


STATUS = "CAST(CASE page_id % 6 WHEN 0 THEN 403 WHEN 1 THEN 301 WHEN 2 THEN 503 WHEN 3 THEN NULL ELSE 200 END AS INTEGER)"
KEYWORDS, TERMS = ("the", "la ", "worthless"), ("thonst", "mit license")


def fetched(spark, folder):
    return table(spark, folder, "pages").withColumn("status", F.expr(STATUS.replace("AS INTEGER", "AS INT"))).withColumns({
        "content_type": F.when(F.contains("url", F.lit("utm_source")), "application/rss+xml").otherwise("text/html"), "sitemap": F.contains("url", F.lit(".html"))})


FETCH = f"""f AS (SELECT *, {STATUS} AS status, contains(url, 'utm_source') AS rss, contains(url, '.html') AS sitemap FROM pages),
 g AS (SELECT *, coalesce(status >= 200 AND status < 400, false) AS reachable, {s.matched('lower(html)', KEYWORDS)} AS found FROM f),
 st AS (SELECT page_id, reachable, array_to_string(CASE WHEN reachable THEN found ELSE [] END, ',') AS keywords, CASE WHEN NOT reachable THEN 'manual' WHEN rss THEN 'rss' WHEN sitemap THEN 'sitemap' WHEN len(found) > 0 THEN 'direct' ELSE 'duckduckgo' END AS recommended_strategy FROM g)"""


def strategies(spark, folder):
    df = fetched(spark, folder)
    low = tx.settle(df, {"low": F.lower("html"), "reachable": cl.reachable(F.col("status"))})
    known = low.withColumn("found", F.when(F.col("reachable"), tx.matched_terms(F.col("low"), KEYWORDS)).otherwise(F.array().cast("array<string>")))
    feed = cl.looks_like_feed(F.col("content_type"), F.col("html"), None)
    return known.select("page_id", "reachable", F.array_join("found", ",").alias("keywords"), cl.crawl_strategy(
        F.col("reachable"), feed, F.col("sitemap"), F.col("found")).alias("recommended_strategy"))


@query("crawl_strategy", "WITH " + FETCH + " SELECT * FROM st")
def crawl_strategy(spark, folder):
    return strategies(spark, folder)


@query("strategy_counts", "WITH " + FETCH + " SELECT recommended_strategy, count(*) AS sources, CAST(count(*) FILTER (reachable) AS BIGINT) AS reachable FROM st GROUP BY recommended_strategy")
def strategy_counts(spark, folder):
    return ag.strategy_counts(strategies(spark, folder))


@query("blocked_response", f"SELECT page_id, coalesce({STATUS} IN (403, 429, 503), false) OR {s.any_of('lower(html)', TERMS)} AS blocked FROM pages")
def blocked_response(spark, folder):
    return fetched(spark, folder).select("page_id", cl.is_blocked(F.col("status"), F.col("html"), TERMS).alias("blocked"))


# --- community -------------------------------------------------------------------------------------------------

C = BOOK.community
TOK = lambda terms: s.any_token("lt", terms)
LIST = lambda terms: s.token_list("lt", terms)
CATEGORY = "CASE " + " ".join(f"WHEN {TOK(t)} THEN {s.q(n)}" for n, t in C.categories) + " ELSE 'other' END"
AGE = f"CAST(greatest(0, floor((epoch(TIMESTAMP '{NOW}') - epoch(CAST(replace(replace(created_at, 'T', ' '), 'Z', '') AS TIMESTAMP))) / 86400)) AS INTEGER)"
_sig = [("remote", 30, "+30 remote"), ("category = 'ai_data' AND ai", 25, "+25 AI annotation/evaluator"), ("len(lng) > 0", 20, "+20 Ukrainian/Russian"),
        ("category IN ('back_office_va', 'research') OR task", 20, "+20 VA/data entry/web research"), ("len(pay) > 0", 15, "+15 payment signal"),
        ("len(con) > 0", 10, "+10 contact/application signal"), ("clear", 10, "+10 clear task description"), ("len(scam) > 0", -60, "-60 scam signal"),
        ("len(unp) > 0", -50, "-50 unpaid/volunteer"), ("len(com) > 0", -40, "-40 commission/referral only"), ("len(pay) = 0 AND len(con) = 0", -30, "-30 no payment/contact signal"),
        ("vague", -30, "-30 vague DM-only post"), ("age_days > 30", -20, "-20 old post")]
POST_CTES = [
    f"c1 AS MATERIALIZED (SELECT *, lower(concat_ws(' ', title, body, summary)) AS lt, {s.squeeze(chr(99) + 'oncat_ws(chr(32), title, body, summary)')} AS flat, {AGE} AS age_days FROM threads)",
    f"c2 AS MATERIALIZED (SELECT *, ({TOK(C.remote)} AND NOT {TOK(C.onsite)}) AS remote, {CATEGORY} AS category, {TOK(C.ai)} AS ai, {TOK(C.tasks)} AS task, {TOK(C.weak_contact)} AS weak, "
    f"(length(flat) >= 80 AND {TOK([t for _, ts in C.categories for t in ts])}) AS clear, {LIST(C.scam)} AS scam, {LIST(C.non_job)} AS nonjob, {LIST(C.unpaid)} AS unp, {LIST(C.commission)} AS com, {LIST(C.payment)} AS pay, {LIST(C.contact)} AS con, {LIST(C.language)} AS lng FROM c1)",
    "c3 AS (SELECT *, (weak AND len(pay) = 0 AND len(con) = 0) AS vague FROM c2)",
    "posts AS MATERIALIZED (SELECT *, CAST(" + " + ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for c, n, _ in _sig) + " AS INTEGER) AS score, array_to_string(list_filter([" +
    ", ".join(f"CASE WHEN {c} THEN {s.q(t)} END" for c, _, t in _sig) + "], lambda x: x IS NOT NULL), '; ') AS score_reason FROM c3)",
]
POSTS = s.with_threads(*POST_CTES)
POST_REASON = """CASE WHEN len(scam) > 0 THEN 'scam_signal' WHEN len(nonjob) > 0 THEN 'non_job_post' WHEN len(unp) > 0 THEN 'unpaid' WHEN len(com) > 0 THEN 'commission_or_referral_only' WHEN vague THEN 'vague_dm_only'
 WHEN age_days > 90 AND NOT (remote AND category <> 'other' AND len(pay) > 0 AND len(con) > 0 AND score >= 70) THEN 'too_old' WHEN NOT remote THEN 'not_remote' WHEN category = 'other' THEN 'no_positive_category' WHEN score <= 0 THEN 'low_reddit_score' ELSE '' END"""


def posts(spark, folder):
    return sc.add_post_score(threads(spark, folder), now(), C)


@query("community_score", POSTS + "SELECT seq, remote, category, score, score_reason, age_days, array_to_string(pay, ', ') AS payment FROM posts")
def community_score(spark, folder):
    return posts(spark, folder).select("seq", "remote", "category", "score", "score_reason", "age_days", F.array_join("payment_signals", ", ").alias("payment"))


@query("community_post_rejection", POSTS + f"SELECT seq, {POST_REASON} AS reason FROM posts")
def community_post_rejection(spark, folder):
    df = posts(spark, folder)
    return df.select("seq", rs.post_rejection(df).alias("reason"))


CUT = f"CASE WHEN length({s.squeeze('body')}) <= 500 THEN {s.squeeze('body')} ELSE regexp_replace(left({s.squeeze('body')}, 500), ' [^ ]*$', '') END"


@query("normalize_community_posts", POSTS + f"""SELECT seq, title, subreddit AS company, CASE WHEN remote THEN 'Remote' ELSE '' END AS location, url, {CUT} AS snippet, {s.squeeze('body')} AS description,
 category, score, array_to_string(con, ', ') AS contact_signals, array_to_string(list_concat(scam, nonjob, unp, com), ', ') AS negative_signals FROM posts""")
def normalize_community_posts(spark, folder):
    return pj.normalize_posts(posts(spark, folder)).select(
        "seq", "title", "company", "location", "url", "snippet", "description", "category", "score", "contact_signals", "negative_signals")


@query("community_topk", POSTS + """, capped AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY seq) AS n FROM posts)
SELECT seq, query, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (ORDER BY score DESC, seq) AS rank FROM capped WHERE n <= 40) WHERE rank <= 100""")
def community_topk(spark, folder):
    top = sel.community_top(posts(spark, folder), 100, per_query=40)
    return sel.rank_rows(top, [F.col("score").desc(), F.col("seq")]).select("seq", "query", "score", "rank")


@query("community_collection")
def community_collection(spark, folder):
    from siftworks.plans.collection import post_collection
    return post_collection(threads(spark, folder), BOOK, now()).select("seq", "title", "url", "category", "score")


I = BOOK.issue
ITOK, ILIST = TOK, LIST
ISSUE_CTES = [
    f"i1 AS MATERIALIZED (SELECT *, lower(concat_ws(' ', title, body, author)) AS lt, {AGE} AS age_days FROM threads)",
    f"i2 AS MATERIALIZED (SELECT *, ({TOK(I.remote)} AND NOT {TOK(I.onsite)}) AS remote, CASE " + " ".join(f"WHEN {TOK(t)} THEN {s.q(n)}" for n, t in I.categories) +
    f" ELSE 'other' END AS category, {TOK(I.non_job)} AS nonjob, contains(lt, {s.q(I.help_term)}) AS help, {TOK(I.developer)} AS dev, {TOK(I.unpaid)} AS unp, {TOK(I.payment)} AS pay, {TOK(I.contact)} AS con, {TOK(I.language)} AS lng FROM i1)",
    "issues AS (SELECT *, CAST(CASE WHEN remote THEN 30 ELSE 0 END + CASE WHEN category = 'ai_data' THEN 25 ELSE 0 END + CASE WHEN lng THEN 20 ELSE 0 END + CASE WHEN pay THEN 15 ELSE 0 END + CASE WHEN con THEN 10 ELSE 0 END "
    "+ CASE WHEN category <> 'other' AND NOT dev THEN 10 ELSE 0 END - CASE WHEN dev THEN 50 ELSE 0 END - CASE WHEN unp THEN 40 ELSE 0 END - CASE WHEN NOT pay AND NOT con THEN 30 ELSE 0 END - CASE WHEN subreddit = 'sub1' THEN 20 ELSE 0 END - CASE WHEN age_days > 180 THEN 20 ELSE 0 END AS INTEGER) AS score FROM i2)",
]


@query("issue_rejection", s.with_threads(*ISSUE_CTES) + """SELECT seq, score, category, CASE WHEN nonjob THEN 'non_job_issue' WHEN help AND NOT (pay OR con) THEN 'help_wanted_without_job_signal' WHEN dev THEN 'developer_heavy'
 WHEN NOT remote THEN 'not_remote' WHEN category = 'other' THEN 'no_positive_category' WHEN score <= 0 THEN 'low_github_score' ELSE '' END AS reason FROM issues""")
def issue_rejection(spark, folder):
    df = threads(spark, folder)
    issues = df.select("seq", "title", "body", "created_at", F.when(F.col("subreddit") == "sub1", "closed").otherwise("open").alias("state"),
                       F.array(F.struct(F.col("author").alias("name"))).alias("labels"))
    scored = sc.add_issue_score(issues, now(), I)
    return scored.select("seq", "score", "category", rs.issue_rejection(scored).alias("reason"))


# --- pool columns ---------------------------------------------------------------------------------------------

_HAVE = {"match_score", "student_score", "candidate_score", "remote_score", "score", "title", "company", "location", "description", "location_fit", "remote",
         "remote_reason", "source", "collector", "category", "priority_bucket", "url", "selection_rejection_reason"}


def _pool_value(name: str) -> str:
    if name in pj.POOL_NUMBERS:
        return f"CAST({name} AS INTEGER)" if name in _HAVE else "0"
    special = {"search_profile": "'local_student'", "negative_reason": "neg", "normalized_category": "category"}
    return special.get(name) or (f"CAST({name} AS VARCHAR)" if name in _HAVE else "''")


@query("pool_projection", r.run(r.norm_ctes(), "SELECT " + ", ".join(f'{_pool_value(n)} AS "{label}"' for label, n in pj.POOL_COLUMNS) + " FROM norm"))
def pool_projection(spark, folder):
    return pj.pool_columns(normalized(spark, folder))
