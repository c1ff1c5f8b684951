"""Collections: site pages with a search fallback, community posts and issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftworks.functions import classify as cl, reasons as rs, scoring as sc, text as tx
from siftworks.operators import dedup, filters as fl, selection as sel, sets
from siftworks.operators.projections import RuleBook, merge_details, normalize_issues, normalize_posts, normalize_site_hits
from siftworks.rules import fixed_values as fv


def site_collection(direct: DataFrame, fallback: DataFrame, book: RuleBook, top: int = 50,
                    details: DataFrame | None = None, part_time_first: bool = False,
                    limit_per_query: int | None = None, query_count: int = 1) -> DataFrame:
    """Postings of one or more sites.

    ``direct`` holds links found on listing pages, ``fallback`` search hits; both
    have columns site, query, query_seq, hit_seq, seq, title, url.  Bad titles and
    non-detail URLs are dropped, details are merged by URL, search hits are only
    used for sites without direct rows.
    """
    def usable(hits: DataFrame) -> DataFrame:
        good = fl.without_bad_terms(hits, book.posting)
        rows = normalize_site_hits(good, book)
        return rows.filter(cl.detail_url(rows["site"], rows["url"]))

    found = usable(direct)
    if limit_per_query is not None:
        found = sel.hit_cap(dedup.first_across_queries(found), limit_per_query, query_count)
    if details is not None:
        found = normalize_site_hits(merge_details(found, details), book)
    rows = dedup.dedup_hits(sets.union_else_fallback(found, usable(fallback), "site"))
    return sel.collector_top(rows, top, part_time_first)


def post_collection(posts: DataFrame, book: RuleBook, now: Column, top: int = fv.COMMUNITY_LIMIT) -> DataFrame:
    """Accepted community posts: scored, greedily deduplicated, best first."""
    scored = sc.add_post_score(posts, now, book.community)
    kept = scored.filter(rs.post_rejection(scored, book.community.max_days) == "")
    rows = normalize_posts(kept)
    return sel.community_top(dedup.dedup_greedy(rows, dedup.post_keys(rows)), top)


def issue_collection(issues: DataFrame, book: RuleBook, now: Column, top: int = fv.COMMUNITY_LIMIT) -> DataFrame:
    """Accepted issues: scored, first per URL, best first."""
    scored = sc.add_issue_score(issues, now, book.issue)
    kept = scored.filter(rs.issue_rejection(scored) == "")
    return sel.community_top(dedup.dedup_issues(normalize_issues(kept)), top)
