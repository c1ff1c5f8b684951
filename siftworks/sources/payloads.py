"""Rows from landed API payloads, feeds and search hits."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from siftworks.functions import text as tx, urls
from siftworks.operators.dedup import keep_first


@dataclass(frozen=True)
class PayloadRule:
    """Where the items of an API payload are and how their fields map."""

    schema: str
    items: str
    fields: Mapping[str, str]


_NAME = "struct<name:string>"
# One rule per API: payload schema, path of the item list, SQL expression per field.
PAYLOAD_RULES = {
    "arbeitnow": PayloadRule(
        "data array<struct<title:string,company_name:string,location:string,remote:boolean,url:string,"
        "tags:array<string>,job_types:array<string>,description:string>>", "data",
        {"title": "title", "company": "company_name", "location": "location", "remote": "remote", "url": "url",
         "tags": "array_join(tags, ', ')", "job_types": "array_join(job_types, ', ')", "description": "description"}),
    "himalayas": PayloadRule(
        "jobs array<struct<title:string,companyName:string,locationRestrictions:array<string>,applicationLink:string,"
        "url:string,pubDate:bigint,description:string>>", "jobs",
        {"title": "title", "company": "companyName", "location": "array_join(locationRestrictions, ', ')",
         "url": "coalesce(nullif(applicationLink, ''), url)", "pub_date": "timestamp_seconds(pubDate)",
         "description": "description"}),
    "jobicy": PayloadRule(
        "jobs array<struct<jobTitle:string,companyName:string,jobIndustry:array<string>,jobGeo:string,"
        "jobType:array<string>,url:string,pubDate:string,jobDescription:string>>", "jobs",
        {"title": "jobTitle", "company": "companyName", "category": "array_join(jobIndustry, ', ')", "location": "jobGeo",
         "job_type": "array_join(jobType, ', ')", "url": "url", "posted_at": "pubDate", "description": "jobDescription"}),
    "remotefirstjobs": PayloadRule(
        "jobs array<struct<title:string,company_name:string,category:string,seniority:string,locations:array<string>,"
        "salary_min:bigint,salary_max:bigint,url:string,published_at:string,description:string>>", "jobs",
        {"title": "title", "company": "company_name", "category": "category", "seniority": "seniority",
         "location": "array_join(locations, ', ')", "salary_min": "salary_min", "salary_max": "salary_max",
         "url": "url", "posted_at": "published_at", "description": "description"}),
    "remotejobs_org": PayloadRule(
        f"data array<struct<title:string,company:{_NAME},category:{_NAME},location:string,salary_min:bigint,"
        "salary_max:bigint,salary_text:string,type:string,url:string,apply_url:string,posted_at:string,description:string>>",
        "data",
        {"title": "title", "company": "company.name", "category": "category.name", "location": "location",
         "salary_min": "salary_min", "salary_max": "salary_max", "salary_text": "salary_text", "job_type": "type",
         "url": "coalesce(nullif(url, ''), apply_url)", "posted_at": "posted_at", "description": "description"}),
    "remotive": PayloadRule(
        "jobs array<struct<title:string,company_name:string,candidate_required_location:string,url:string,description:string>>",
        "jobs",
        {"title": "title", "company_name": "company_name", "candidate_required_location": "candidate_required_location",
         "url": "url", "description": "description"}),
    "reddit_listing": PayloadRule(
        "data struct<children:array<struct<data:struct<title:string,author:string,score:int,created_utc:double,"
        "permalink:string,selftext:string>>>>", "data.children.data",
        {"title": "title", "author": "author", "score": "score", "created_utc": "created_utc",
         "url": "concat('https://www.reddit.com', permalink)", "selftext": "selftext"}),
    "reddit_search": PayloadRule(
        "data struct<children:array<struct<data:struct<title:string,selftext:string,url:string,permalink:string,"
        "created_utc:double,subreddit:string,author:string>>>>", "data.children.data",
        {"title": "coalesce(title, '')", "body": "coalesce(selftext, '')", "summary": "coalesce(selftext, '')",
         "url": "coalesce(nullif(url, ''), permalink, '')", "created_at": "cast(cast(created_utc as bigint) as string)",
         "item_subreddit": "coalesce(subreddit, '')", "author": "coalesce(author, '')"}),
    "github_issues": PayloadRule(
        "items array<struct<title:string,body:string,html_url:string,repository_url:string,state:string,created_at:string,"
        f"labels:array<{_NAME}>,user:struct<login:string>>>", "items",
        {"title": "title", "body": "body", "html_url": "html_url", "repository_url": "repository_url", "state": "state",
         "created_at": "created_at", "labels": "labels", "user": "user"}),
}


def flatten_payload(df: DataFrame, rule: PayloadRule, payload: str = "payload") -> DataFrame:
    """One row per item of each payload; other columns are repeated, ``item_no`` keeps the order.

    Unreadable payloads give no rows.
    """
    others = [c for c in df.columns if c != payload]
    items = (
        df.withColumn("_p", F.from_json(F.col(payload), rule.schema)).select(*others, F.posexplode(F.col(f"_p.{rule.items}")).alias("item_no", "_i")))
    return items.select(*others, "item_no", "_i.*").select(
        *others, "item_no", *[F.expr(expr).alias(name) for name, expr in rule.fields.items()])


# --- feeds -----------------------------------------------------------------------

RSS_SCHEMA = "channel struct<item:array<struct<title:string,link:string,pubDate:string,description:string>>>"
ATOM_SCHEMA = (
    "entry array<struct<title:string,content:string,summary:string,id:string,updated:string,"
    "link:array<struct<_href:string,_rel:string>>,author:struct<name:string>>>"
)


def rss_items(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Items of RSS 2.0 documents; unreadable documents give no rows."""
    others = [c for c in df.columns if c != xml]
    parsed = df.withColumn("_d", F.from_xml(F.col(xml), RSS_SCHEMA, {"mode": "PERMISSIVE"}))
    items = parsed.select(*others, F.posexplode("_d.channel.item").alias("item_no", "_i"))
    clean = lambda name: tx.strip_space(tx.unescape(F.col(f"_i.{name}")))
    title, company = tx.split_title(clean("title"))
    return items.select(
        *others, "item_no", title.alias("title"), company.alias("company"), F.lit("remote").alias("location"),
        clean("link").alias("url"), clean("pubDate").alias("posted_at"), clean("description").alias("description"))


def atom_entries(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Entries of Atom documents; the alternate link is the URL, else the id."""
    others = [c for c in df.columns if c != xml]
    parsed = df.withColumn("_d", F.from_xml(F.col(xml), ATOM_SCHEMA, {"mode": "PERMISSIVE"}))
    items = parsed.select(*others, F.posexplode("_d.entry").alias("item_no", "_i"))
    alternate = F.try_element_at(F.filter(F.col("_i.link"), lambda link: link["_rel"] == "alternate"), F.lit(1))
    part = lambda name: tx.nz(F.col(f"_i.{name}"))
    return items.select(
        *others, "item_no", part("title").alias("title"), part("content").alias("body"), part("summary").alias("summary"),
        F.when(alternate.isNotNull(), tx.nz(alternate["_href"])).otherwise(part("id")).alias("url"),
        part("updated").alias("published_at"), part("updated").alias("created_at"), part("author.name").alias("author"))


# --- search hits -------------------------------------------------------------------

def project_hits(df: DataFrame) -> DataFrame:
    """Search-engine hits: first usable link and text; rows without both are dropped."""
    link = tx.first_filled(*[tx.field(df, n) for n in ("href", "url", "link", "source")])
    snippet = tx.first_filled(*[tx.field(df, n) for n in ("body", "snippet")])
    keep = [df[c] for c in ("seq", "query", "query_seq", "hit_seq") if c in df.columns]
    hits = df.select(*keep, tx.field(df, "title").alias("title"), urls.canonical_url(link).alias("url"), snippet.alias("snippet"))
    return hits.filter((F.col("url") != "") | (F.col("title") != ""))


def latest_items(df: DataFrame) -> DataFrame:
    """First occurrence of each URL of a flattened source."""
    return keep_first(df, ["url"], ["seq", "item_no"])
