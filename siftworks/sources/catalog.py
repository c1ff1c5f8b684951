"""Source catalogue, query lists and the grid of pages to fetch."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftworks.functions import text as tx, urls
from siftworks.operators.dedup import keep_first
from siftworks.rules import fixed_values as fv


def flatten_sources(groups: Mapping[str, DataFrame], order: str = "seq") -> DataFrame:
    """Named source groups as one table with a ``group`` column; only enabled rows."""
    tagged = [
        frame.withColumn("group", F.lit(name)).withColumn("group_seq", F.lit(i))
        for i, (name, frame) in enumerate(groups.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged).filter(F.col("enabled"))


def source_table(spark: SparkSession, config: Mapping) -> DataFrame:
    """The catalogue of a rule file as a table."""
    rows = [
        (g, group, i, s.get("name", ""), s.get("type", ""), str(s.get("priority", "")), s.get("base_url", ""))
        for g, group in enumerate(fv.SOURCE_GROUPS) for i, s in enumerate(config.get(group) or []) if s.get("enabled")
    ]
    return spark.createDataFrame(rows, "group_seq int, `group` string, seq int, name string, type string, priority string, base_url string")


def distinct_queries(lists: Sequence[DataFrame], templates: Sequence[str] | None = None) -> DataFrame:
    """Concatenated query lists, wrapped in templates, first occurrence of each query.

    A template has one ``%s``; lists have columns (query, seq).
    """
    templates = templates or ["%s"] * len(lists)
    parts = [
        frame.select(F.format_string(template, "query").alias("query"), F.lit(i).alias("list_seq"), "seq")
        for i, (frame, template) in enumerate(zip(lists, templates))
    ]
    return keep_first(reduce(lambda a, b: a.unionByName(b), parts), ["query"], ["list_seq", "seq"])


def query_rows(spark: SparkSession, queries: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(q, i) for i, q in enumerate(queries)], "query string, seq int")


# Search URL of each site; %s is the form-encoded query (fixed formats).
SEARCH_URLS = {
    "indeed": "https://it.indeed.com/jobs?q=%s",
    "talent": "https://it.talent.com/jobs?k=%s",
    "jooble": "https://it.jooble.org/SearchResult?ukw=%s",
    "subito": "https://www.subito.it/annunci-campania/vendita/offerte-lavoro/?q=%s",
    "adecco": "https://www.adecco.it/lavoro/?k=%s",
    "google": "https://www.google.com/search?q=%s",
    "github": "https://api.github.com/search/issues?q=%s",
}
GIGROUP_PLACES = ("Napoli", "Pozzuoli", "Bacoli", "Casoria")
GIGROUP_PLAIN = ("lavoro", "offerte lavoro")


def search_url(site: str, query: Column) -> Column:
    """URL of a site's search for a query."""
    q = tx.nz(query)
    if site in SEARCH_URLS:
        text = q if site in ("indeed", "subito", "google", "github") else F.trim(q)
        before, after = SEARCH_URLS[site].split("%s")
        return F.concat(F.lit(before), urls.encode(text), F.lit(after))
    if site == "randstad":
        name = tx.slug(q)
        root = "https://www.randstad.it/offerte-lavoro/"
        return F.when(name == "", root).otherwise(F.concat(F.lit(root + "q-"), urls.encode(name), F.lit("/")))
    if site == "gigroup":
        found = [q.rlike(rf"(?i)\b{re.escape(p)}\b") for p in GIGROUP_PLACES]
        place, job = F.when(found[0], GIGROUP_PLACES[0]), F.when(found[0], F.regexp_replace(q, rf"(?i)\b{GIGROUP_PLACES[0]}\b", " "))
        for name, test in zip(GIGROUP_PLACES[1:], found[1:]):
            place, job = place.when(test, name), job.when(test, F.regexp_replace(q, rf"(?i)\b{name}\b", " "))
        job = tx.squeeze(F.coalesce(job, q))
        job = F.when(F.lower(job).isin(*GIGROUP_PLAIN), "").otherwise(job)
        return F.concat(
            F.lit("https://www.gigroup.it/offerte-lavoro/?job="), urls.encode(job), F.lit("&placeOfWork="),
            urls.encode(F.coalesce(place, F.lit(""))), F.lit("&radius=25"))
    raise ValueError(f"unknown site: {site}")


SEARCH_SITES = (*SEARCH_URLS, "randstad", "gigroup")


def plan_searches(queries: DataFrame, sites: Sequence[str] = SEARCH_SITES) -> DataFrame:
    """Search URL of every query on every site (sites are a fixed list inside the row)."""
    cells = F.array(*[F.struct(F.lit(s).alias("site"), search_url(s, F.col("query")).alias("search_url")) for s in sites])
    return queries.select("*", F.explode(cells).alias("c")).select(*queries.columns, "c.site", "c.search_url")


def plan_communities(queries: DataFrame, communities: Sequence[str], kind: str = "rss") -> DataFrame:
    """Community search URLs, one row per query and community."""
    suffix = {"rss": "search.rss", "json": "search.json"}[kind]
    tail = F.concat(F.lit(f"/{suffix}?q="), urls.encode(F.col("query")), F.lit("&restrict_sr=1&sort=new"))
    return queries.select("*", F.explode(F.array(*[F.lit(c) for c in communities])).alias("subreddit")).withColumn(
        "search_url", F.concat(F.lit("https://www.reddit.com/r/"), F.col("subreddit"), tail))


def plan_pages(queries: DataFrame, first: int, last: int, step: int, name: str = "offset") -> DataFrame:
    """One row per query and page offset."""
    return queries.select("*", F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(step))).alias(name))
