"""URL expressions, URL types and dedup over postings and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as s
from checks.corpus import BOOK, PAGE_PATTERNS, PATTERNS
from checks.registry import query
from checks.views import postings, table
from siftworks.functions import identity as ident, text as tx, urls
from siftworks.operators import aggregates as ag, dedup, selection as sel
from siftworks.sources import files, pages as pg

POSTS, CANON = s.with_postings, s.canon_ctes()

# URLs of postings and pages in one table.
ALL_URLS = "all_urls AS (SELECT seq, url FROM postings UNION ALL SELECT 10000000000 + page_id, url FROM pages)"


def all_urls(spark, folder):
    pages = table(spark, folder, "pages").select((F.lit(10_000_000_000) + F.col("page_id")).alias("seq"), "url")
    return postings(spark, folder).select("seq", "url").unionByName(pages)


@query("url_canonical", POSTS(ALL_URLS, s.canon_ctes("all_urls")) + "SELECT seq, curl AS canonical FROM canon")
def url_canonical(spark, folder):
    df = all_urls(spark, folder)
    return df.select("seq", urls.canonical_url(F.col("url")).alias("canonical"))


@query("url_canonical_variants", POSTS(ALL_URLS, "v AS (SELECT seq, url, trim(url) AS u0 FROM all_urls)") + f"""
SELECT seq, {s.canonical('u0')} AS plain_canonical, {s.unwrap('u0')} AS redirect_target FROM v""")
def url_canonical_variants(spark, folder):
    url = F.col("url")
    return all_urls(spark, folder).select(
        "seq", urls.canonical_url(url, unwrap=False, nan_is_blank=True).alias("plain_canonical"),
        urls.redirect_target(url).alias("redirect_target"))


@query("url_parts", POSTS(ALL_URLS) + f"""
SELECT seq, {s.host('url')} AS host, lower({s.part('url', 3)}) AS path, {s.target('url')} AS target,
 CASE WHEN {s.part('url', 1)} <> '' AND {s.part('url', 2)} <> '' THEN concat({s.part('url', 1)}, '://', {s.part('url', 2)}, '/')
      ELSE concat(rtrim(url, '/'), '/') END AS root,
 array_to_string(list_sort({s.query_keys('url')}), ',') AS keys FROM all_urls""")
def url_parts(spark, folder):
    url = F.col("url")
    return all_urls(spark, folder).select(
        "seq", urls.bare_host(url).alias("host"), F.lower(urls.path(url)).alias("path"), urls.target(url).alias("target"),
        urls.root_url(url).alias("root"), F.array_join(F.array_sort(urls.query_keys(url)), ",").alias("keys"))


def _page_rules_sql() -> str:
    hosts = []
    for source in PAGE_PATTERNS.sources:
        search, job = [p.lower() for p in source.get("search", [])], [p.lower() for p in source.get("job", [])]
        mine = f"list_contains({s.arr([d.removeprefix('www.') for d in source['domains']])}, h)"
        longer = [f"(contains(t, {s.q(a)}) AND contains(t, {s.q(b)}))" for a in search for b in job if a.startswith(b) and len(a) > len(b)]
        more = " OR ".join(longer) if longer else "false"
        other = [p for p in search if p != "/page-"]
        hosts.append((mine, s.any_of("t", search), more, f"contains(t, '/page-') AND {s.any_of('t', other)}"))
    col = lambda i: "CASE " + " ".join(f"WHEN {h[0]} THEN {h[i]}" for h in hosts) + " ELSE false END"
    return f"{col(1)} AS any_search, {col(2)} AS more_specific, {col(3)} AS page_segment"


@query("pattern_match_rules", f"""
WITH p AS (SELECT page_id, {s.host('url')} AS h, {s.target('url')} AS t FROM pages)
SELECT page_id, {_page_rules_sql()} FROM p""")
def pattern_match_rules(spark, folder):
    df = urls.join_patterns(table(spark, folder, "pages").select("page_id", "url"), PAGE_PATTERNS)
    return df.select("page_id", urls.has_pattern("search").alias("any_search"),
                     urls.more_specific_search().alias("more_specific"), urls.segment_search().alias("page_segment"))


@query("url_type", POSTS(s.url_type_ctes(PATTERNS, "postings")) + "SELECT seq, utype AS url_type, upattern AS matched_pattern FROM typed")
def url_type(spark, folder):
    df = urls.classify_urls(postings(spark, folder).select("seq", "url"), PATTERNS)
    return df.select("seq", F.col("url_result_type").alias("url_type"), "matched_pattern")


@query("host_pattern_join", "WITH src AS (SELECT page_id, url FROM pages), " + s.url_type_ctes(PAGE_PATTERNS, "src") +
       "SELECT page_id, utype AS url_type, upattern AS matched_pattern FROM typed")
def host_pattern_join(spark, folder):
    df = urls.classify_urls(table(spark, folder, "pages").select("page_id", "url"), PAGE_PATTERNS)
    return df.select("page_id", F.col("url_result_type").alias("url_type"), "matched_pattern")


@query("page_extent", """
SELECT page_id, least(coalesce(list_max(list_transform(regexp_extract_all(concat(html, '<a href="', url, '">'), '[?&]page=(\\d+)', 1),
 lambda n: TRY_CAST(n AS INTEGER))), 1), 20) AS last_page FROM pages""")
def page_extent(spark, folder):
    # The navigation of the given pages has no paging links; the page's own URL is linked to it.
    df = table(spark, folder, "pages")
    linked = F.concat(F.col("html"), F.lit('<a href="'), F.col("url"), F.lit('">'))
    return df.select("page_id", urls.page_extent(linked, 20).alias("last_page"))


# --- dedup ------------------------------------------------------------------------------

IDENTITY = "concat_ws('|', lower(trim(title)), lower(trim(company)), lower(trim(location)))"


@query("dedup_url_or_identity", POSTS(CANON) + f"""
SELECT seq, source, url FROM (SELECT *, row_number() OVER (
 PARTITION BY CASE WHEN url <> '' THEN curl ELSE {IDENTITY} END ORDER BY seq) AS rn FROM canon) WHERE rn = 1""")
def dedup_url_or_identity(spark, folder):
    return dedup.dedup_postings(postings(spark, folder).select("seq", "source", "url", "title", "company", "location")).select(
        "seq", "source", "url")


@query("dedup_url_or_query", POSTS(CANON) + """
SELECT seq, url, query FROM (SELECT *, row_number() OVER (
 PARTITION BY CASE WHEN url <> '' THEN curl ELSE concat_ws('|', lower(trim(title)), lower(trim(query))) END ORDER BY seq) AS rn
 FROM canon) WHERE rn = 1""")
def dedup_url_or_query(spark, folder):
    return dedup.dedup_hits(postings(spark, folder).select("seq", "url", "title", "query")).select("seq", "url", "query")


@query("dedup_two_stage", POSTS() + """
SELECT seq, source, title, company FROM (
 SELECT *, row_number() OVER (PARTITION BY source, title, company ORDER BY seq) AS r2 FROM (
  SELECT *, row_number() OVER (PARTITION BY nullif(url, '') ORDER BY seq) AS r1 FROM postings) WHERE r1 = 1) WHERE r2 = 1""")
def dedup_two_stage(spark, folder):
    df = postings(spark, folder).select("seq", "source", "title", "company", F.nullif("url", F.lit("")).alias("url"))
    return dedup.dedup_two_stage(df).select("seq", "source", "title", "company")


@query("dedup_source_url", POSTS() + """
SELECT seq, company AS source, url FROM (SELECT *, row_number() OVER (PARTITION BY company, url ORDER BY seq) AS rn FROM postings) WHERE rn = 1""")
def dedup_source_url(spark, folder):
    df = postings(spark, folder).select("seq", F.col("company").alias("source"), "url")
    return dedup.dedup_source_urls(df)


@query("duplicate_flag", POSTS() + """
SELECT seq, row_number() OVER (PARTITION BY CASE WHEN url <> '' THEN lower(trim(url))
 ELSE concat_ws('|', collector, lower(trim(title)), lower(trim(company)), lower(trim(location))) END ORDER BY seq) > 1 AS duplicate FROM postings""")
def duplicate_flag(spark, folder):
    df = postings(spark, folder).select("seq", "url", "collector", "title", "company", "location")
    return dedup.flag_duplicates(df, ident.url_key(df)).select("seq", "duplicate")


SENT_KEY = f"CASE WHEN url <> '' THEN pcurl ELSE {IDENTITY} END"
PLAIN_CANON = f"plain AS MATERIALIZED (SELECT *, {s.canonical('url')} AS pcurl FROM postings)"


@query("dedup_sent_key", POSTS(PLAIN_CANON) + f"""
SELECT count(*) AS kept, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS skipped
FROM (SELECT {SENT_KEY} AS k, count(*) AS n FROM plain GROUP BY k)""")
def dedup_sent_key(spark, folder):
    df = postings(spark, folder).select("url", "title", "company", "location")
    return dedup.count_duplicates(df, ident.sent_key(df))


@query("seen_url_across_queries", POSTS() + """
SELECT query, count(*) AS accepted FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq % 3, seq) AS rn
 FROM postings WHERE url <> '') WHERE rn = 1 GROUP BY query""")
def seen_url_across_queries(spark, folder):
    df = postings(spark, folder).select("url", "query", (F.col("seq") % 3).alias("query_seq"), F.col("seq").alias("hit_seq"))
    return dedup.accepted_per_query(df)


# Row by row in input order, with the keys taken so far.
GREEDY = s.with_threads(
    "keyed AS (SELECT *, list_distinct(list_filter([url, lower(concat_ws('|', title, author)), lower(concat_ws('|', title, subreddit))], lambda k: k <> '')) AS keys, "
    "row_number() OVER (ORDER BY seq) AS place FROM threads)",
    "walk AS (SELECT 0 AS place, []::VARCHAR[] AS taken, -1::BIGINT AS kept UNION ALL "
    "SELECT k.place, CASE WHEN list_has_any(w.taken, k.keys) THEN w.taken ELSE list_concat(w.taken, k.keys) END, CASE WHEN list_has_any(w.taken, k.keys) THEN -1 ELSE k.seq END "
    "FROM walk w JOIN keyed k ON k.place = w.place + 1)").replace("WITH ", "WITH RECURSIVE ", 1) + "SELECT seq, url, author, subreddit FROM threads WHERE seq IN (SELECT kept FROM walk)"


@query("dedup_multi_key_greedy", GREEDY)
def dedup_multi_key_greedy(spark, folder):
    from checks.views import threads
    df = threads(spark, folder)
    return dedup.dedup_greedy(df, dedup.post_keys(df)).select("seq", "url", "author", "subreddit")


# --- debug statistics ------------------------------------------------------------------------

PAGE_DEBUG = "WITH src AS (SELECT page_id AS seq, url, regexp_extract(url, '[?&]ref=(\\w+)', 1) AS ref FROM pages), " + s.url_type_ctes(
    PAGE_PATTERNS, "src", "typed") + ", rows AS (SELECT seq, url, concat('c_', left(lower(regexp_extract(url, 'example\\.(\\w+)', 1)), 3)) AS collector, utype, upattern FROM typed) "


def debug_pages(spark, folder):
    df = table(spark, folder, "pages").select(F.col("page_id").alias("seq"), "url")
    typed = urls.classify_urls(df, PAGE_PATTERNS)
    name = F.concat(F.lit("c_"), F.left(F.lower(F.regexp_extract("url", r"example\.(\w+)", 1)), F.lit(3)))
    return typed.select("seq", "url", name.alias("collector"), F.col("url_result_type").alias("detected_type"), "matched_pattern",
                        F.lit("").alias("title"), F.lit("").alias("rejection_reason"))


@query("pattern_usage", PAGE_DEBUG + "SELECT upattern AS pattern, count(*) AS n FROM rows GROUP BY upattern")
def pattern_usage(spark, folder):
    return ag.pattern_usage(debug_pages(spark, folder))


PREFIXES = f"""
parts AS (SELECT seq, collector, {s.part('url', 3)} AS p FROM rows WHERE utype = 'unknown'),
cells AS (SELECT seq, collector, p, list_filter(str_split(p, '/'), lambda x: x <> '') AS seg FROM parts),
cand AS (SELECT seq, collector, list_concat(
  CASE WHEN p IN ('', '/') THEN CAST([] AS VARCHAR[]) WHEN suffix(p, '/') THEN [p] ELSE [concat(p, '/')] END,
  list_transform(range(1, least(len(seg), 3) + 1), lambda n: concat('/', array_to_string(seg[1:n], '/'), '/'))) AS c FROM cells),
exploded AS (SELECT seq, collector, unnest(c) AS prefix, generate_subscripts(c, 1) AS pos FROM cand) """


@query("path_prefix_counts", PAGE_DEBUG + ", " + PREFIXES + "SELECT collector, prefix, count(*) AS n FROM exploded GROUP BY ALL")
def path_prefix_counts(spark, folder):
    return ag.path_counts(debug_pages(spark, folder)).select("collector", "prefix", "n")


@query("top_paths_per_collector", PAGE_DEBUG + ", " + PREFIXES + """
, counted AS (SELECT collector, prefix, count(*) AS n, min(seq * 10 + pos) AS f FROM exploded GROUP BY ALL)
SELECT collector, prefix, n, CAST(rk AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY collector ORDER BY n DESC, f) AS rk FROM counted) WHERE rk <= 10""")
def top_paths_per_collector(spark, folder):
    return sel.top_paths(ag.path_counts(debug_pages(spark, folder))).select("collector", "prefix", "n", "rank")


@query("unknown_share", PAGE_DEBUG + """
SELECT collector, count(*) AS urls, CAST(count(*) FILTER (utype = 'unknown') AS BIGINT) AS unknown FROM rows GROUP BY collector""")
def unknown_share(spark, folder):
    return ag.unknown_share(debug_pages(spark, folder))


@query("partitioned_unknown_sink", PAGE_DEBUG + f"""
SELECT collector, url, CASE WHEN {s.part('url', 3)} = '' THEN '/' ELSE {s.part('url', 3)} END AS url_path, utype AS detected_type
FROM rows WHERE utype = 'unknown'""")
def partitioned_unknown_sink(spark, folder):
    from siftworks.session import scratch_path
    path = scratch_path(spark, "unknown")
    files.write_unknown_urls(debug_pages(spark, folder), path)
    return spark.read.parquet(path).select(F.col("collector").cast("string").alias("collector"), "url", "url_path", "detected_type")


# --- links of landed pages -------------------------------------------------------------------------

HREFS = r"""
found AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b([^>]*)>(.*?)</a>', 1)) AS attrs,
 unnest(regexp_extract_all(html, '(?is)<a\b([^>]*)>(.*?)</a>', 2)) AS body,
 unnest(range(len(regexp_extract_all(html, '(?is)<a\b([^>]*)>(.*?)</a>', 1)))) AS pos FROM pages),
hrefs AS (SELECT *, regexp_extract(attrs, 'href="([^"]+)"', 1) AS href FROM found),
abs AS (SELECT page_id, pos, concat(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1), href) AS link,
 trim(regexp_replace(regexp_replace(body, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM hrefs WHERE href <> '') """


@query("html_link_extract", "WITH " + HREFS + f""", c AS (SELECT *, {s.canonical('link')} AS curl FROM abs)
SELECT page_id, curl AS link_url, title FROM (SELECT *, row_number() OVER (PARTITION BY page_id, curl ORDER BY pos) AS rn FROM c
 WHERE regexp_matches(curl, '/[a-z]{{3,}}$') AND title <> '') WHERE rn = 1""")
def html_link_extract(spark, folder):
    df = table(spark, folder, "pages").withColumn("page_url", F.col("url"))
    links = pg.extract_links(df, F.col("page_url"), lambda link: link.rlike("/[a-z]{3,}$"))
    return links.select("page_id", "link_url", "title")
