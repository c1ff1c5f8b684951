"""URL canonicalisation, parts and type as column expressions.

The URL is split with the RFC 3986 expression instead of ``parse_url``, which
raises on malformed input under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftworks.functions import text as tx
from siftworks.rules import UrlPatterns, fixed_values as fv

RFC3986 = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, RFC3986, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def authority(url: Column) -> Column:
    return _part(url, 2)


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def host_of(authority_text: Column) -> Column:
    return F.lower(F.regexp_extract(authority_text, r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1))


def hostname(url: Column) -> Column:
    """Lower-case host without user info and port."""
    return host_of(authority(url))


def bare_host(url: Column) -> Column:
    return F.regexp_replace(hostname(url), r"^www\.", "")


def root_url(url: Column) -> Column:
    def body(u: Column) -> Column:
        parts = F.concat(_part(u, 1), F.lit("://"), authority(u), F.lit("/"))
        bare = F.concat(F.rtrim(u, F.lit("/")), F.lit("/"))
        return F.when((_part(u, 1) != "") & (authority(u) != ""), parts).otherwise(bare)
    return tx.let(tx.nz(url), body)


def target(url: Column) -> Column:
    """Lower-case path?query, with '/' for an empty path."""
    p = F.regexp_replace(path(url), "^$", "/")
    return tx.let(query(url), lambda q: F.lower(F.when(q != "", F.concat(p, F.lit("?"), q)).otherwise(p)))


def decode(value: Column) -> Column:
    """Percent-decode; stray percent signs stay as they are."""
    return F.url_decode(F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25"))


def encode(value: Column) -> Column:
    """Form-encode with the unreserved set of RFC 3986 (keeps ~, encodes *)."""
    return F.replace(F.replace(F.url_encode(value), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _name(pair: Column) -> Column:
    return decode(F.substring_index(pair, "=", 1))


def _value(pair: Column) -> Column:
    return F.when(F.contains(pair, F.lit("=")), decode(F.regexp_replace(pair, "(?s)^[^=]*=", ""))).otherwise("")


def _pairs(q: Column) -> Column:
    return F.filter(F.split(q, "&"), lambda pair: pair != "")


def query_keys(url: Column) -> Column:
    """Distinct lower-case parameter names."""
    return F.array_distinct(F.transform(_pairs(query(url)), lambda pair: F.lower(_name(pair))))


def _parameter(pairs: Column, name: str) -> Column:
    hits = F.filter(pairs, lambda pair: _name(pair) == name)
    return tx.let(F.try_element_at(hits, F.lit(-1)), lambda pair: F.coalesce(_value(pair), F.lit("")))


def parameter(url: Column, name: str) -> Column:
    """Decoded value of a parameter, the last one when repeated, else ''."""
    return _parameter(_pairs(query(url)), name)


def unwrap_redirect(url: Column) -> Column:
    """Target of a search-engine redirect link, else the URL itself."""
    def inner(u: Column) -> Column:
        options = tx.let(_pairs(query(u)), lambda pairs: tx.first_filled(*[_parameter(pairs, n) for n in fv.REDIRECT_PARAMETERS]))
        # One more decoding without '+' handling, as for a path.
        decoded = tx.let(options, lambda value: F.when(
            value == "", u).otherwise(decode(F.replace(value, F.lit("+"), F.lit("%2B")))))
        # Most URLs have no such parameter: a byte search decides that cheaply.
        return F.when(tx.has_any(u, fv.REDIRECT_PARAMETERS), decoded).otherwise(u)
    return tx.let(url, inner)


def _clean_query(q: Column) -> Column:
    kept = F.filter(_pairs(q), lambda pair: ~F.lower(_name(pair)).isin(*fv.TRACKING_PARAMETERS))
    return F.array_join(F.transform(kept, lambda pair: F.concat(encode(_name(pair)), F.lit("="), encode(_value(pair)))), "&")


def _prefix_if(value: Column, before: str, after: str = "") -> Column:
    return tx.let(value, lambda v: F.when(v != "", F.concat(F.lit(before), v, F.lit(after))).otherwise(""))


def _assemble(url: Column) -> Column:
    # "/a/b//" loses its trailing slashes, "/" stays, "a" below an authority gets one.
    p = F.regexp_replace(path(url), r"(?s)(?<=[^/])/+$", "")
    rooted = F.when((authority(url) != "") & p.rlike("^[^/]"), F.concat(F.lit("/"), p)).otherwise(p)
    q = F.when(F.contains(url, F.lit("?")), _prefix_if(_clean_query(query(url)), "?")).otherwise("")
    return F.concat(_prefix_if(scheme(url), "", ":"), _prefix_if(F.lower(authority(url)), "//"), rooted, q)


def canonical_url(url: Column, unwrap: bool = True, nan_is_blank: bool = False) -> Column:
    """Canonical form used as identity.

    Lower-case scheme and authority, no trailing slash, no tracking parameters,
    no fragment, re-encoded query in its original order.  ``unwrap=False`` keeps
    redirect links; ``nan_is_blank`` also treats the text 'nan' as missing.
    """
    def body(whole: Column) -> Column:
        blank = (whole == "") | (F.lower(whole) == "nan") if nan_is_blank else whole == ""
        return F.when(blank, "").otherwise(tx.let(unwrap_redirect(whole), _assemble) if unwrap else _assemble(whole))
    return tx.let(tx.strip_space(url), body)


def redirect_target(url: Column) -> Column:
    """Only unwrap the redirect, keep everything else."""
    return tx.strip_space(unwrap_redirect(tx.strip_space(url)))


def _without_dots(p: Column, merged: bool = False) -> Column:
    """A rooted path without '.' and '..' steps, folded once; steps above the root stay at the root.

    ``merged`` paths (folder and relative link) also lose empty steps between the first and the last.
    """
    def fold(parts: Column) -> Column:
        last = F.element_at(parts, -1)
        steps = F.filter(parts, lambda s, i: (s != "") | (i == 0) | (i == F.size(parts) - 1)) if merged else parts
        kept = F.aggregate(steps, F.array().cast("array<string>"), lambda a, s: F.when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(1))))
                           .when(s == ".", a).otherwise(F.array_append(a, s)))
        closed = F.when(last.isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
        return tx.first_filled(F.array_join(closed, "/"), F.lit("/"))

    return tx.let(F.split(p, "/"), fold)


def resolve(base: Column, link: Column) -> Column:
    """Absolute URL of a link found on a page."""
    def body(u: Column) -> Column:
        origin = F.concat(scheme(base), F.lit("://"), authority(base))
        folder = F.regexp_replace(F.regexp_extract(path(base), r"(?s)^(.*/)?[^/]*$", 1), "^$", "/")
        own = F.regexp_extract(u, r"(?s)^[^?#]*", 0)
        rest = F.substr(u, F.length(own) + 1)
        return (
            F.when(u == "", base)
            .when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), u)
            .when(F.startswith(u, F.lit("//")), F.concat(scheme(base), F.lit(":"), u))
            .when(F.startswith(u, F.lit("/")), F.concat(origin, _without_dots(own), rest))
            .when(F.startswith(u, F.lit("?")), F.concat(origin, path(base), u))
            .when(F.startswith(u, F.lit("#")), F.concat(F.regexp_replace(base, "(?s)#.*$", ""), u))
            .otherwise(F.concat(origin, _without_dots(F.concat(folder, own), merged=True), rest))
        )

    return tx.let(tx.nz(link), body)


def segments(p: Column) -> Column:
    return F.filter(F.split(p, "/"), lambda part: part != "")


# --- URL type ----------------------------------------------------------------

def join_patterns(df: DataFrame, patterns: UrlPatterns, url: str = "url") -> DataFrame:
    """Attach the pattern row of the URL's host (``p_*`` columns, null if none).

    Patterns are rule input with one row per host, so this is a broadcast hash
    join; the pattern test itself runs inside the row (:func:`url_type`).
    """
    left = tx.settle(df, {"p_key": bare_host(F.col(url)), "p_target": target(F.col(url))})
    rows = patterns.frame(df.sparkSession)
    return left.join(rows, left["p_key"] == rows["p_host"], "left").drop("p_host")


def pattern_hits(name: str, text: str = "p_target") -> Column:
    """Patterns of one type contained in the target, in rule order."""
    return F.filter(F.col(f"p_{name}"), lambda p: F.contains(F.col(text), p))


def has_pattern(name: str) -> Column:
    return F.coalesce(F.exists(F.col(f"p_{name}"), lambda p: F.contains(F.col("p_target"), p)), tx.no())


def more_specific_search() -> Column:
    """A matching search pattern extends a matching job pattern."""
    return F.coalesce(
        F.exists(
            pattern_hits("search"),
            lambda s: F.exists(
                pattern_hits("job"),
                lambda j: F.startswith(s, j) & (F.length(s) > F.length(j)),
            ),
        ),
        tx.no(),
    )


def segment_search() -> Column:
    """'/page-' in the target plus another matching search pattern."""
    other = F.exists(pattern_hits("search"), lambda s: s != "/page-")
    return F.contains(F.col("p_target"), F.lit("/page-")) & F.coalesce(other, tx.no())


def exact_or_contained_search() -> Column:
    """Search patterns by containment, except the bare listing root, which must be the whole target."""
    root = "/offerte-lavoro/"
    return F.coalesce(
        F.exists(
            F.col("p_search"),
            lambda s: F.when(
                s == root,
                F.rtrim(F.col("p_target"), F.lit("/")) == root.rstrip("/"),
            ).otherwise(F.contains(F.col("p_target"), s)),
        ),
        tx.no(),
    )


def _label(kind: str) -> Column:
    return F.concat(F.col("p_source"), F.lit("_" + kind))


def url_type(patterns: UrlPatterns) -> tuple[Column, Column]:
    """(URL type, matched pattern) over the columns of :func:`join_patterns`."""
    excluded = [str(d).strip().lower().removeprefix("www.") for d in patterns.excluded_domains]
    search_first = F.coalesce(F.col("p_search_first"), tx.no())
    all_job = (F.size("p_job_all") > 0) & F.forall(F.col("p_job_all"), lambda p: F.contains(F.col("p_target"), p))
    ladder = [
        (F.col("p_key") == "", "unknown", F.lit("none")),
        (F.col("p_key").isin(*excluded) if excluded else tx.no(), "excluded_domain", F.lit("general_exclude_domains")),
        (F.col("p_source").isNull(), "unknown", F.lit("none")),
        ((F.col("p_source") == "randstad") & search_first & (exact_or_contained_search() | segment_search()),
         "search_page", _label("search")),
        (more_specific_search(), "search_page", _label("search")),
        (F.coalesce(all_job, tx.no()), "real_job", _label("job")),
        (search_first & has_pattern("search"), "search_page", _label("search")),
    ]
    names = {"job": "real_job", "search": "search_page"}
    ladder += [(has_pattern(k), names.get(k, k), _label(k)) for k in UrlPatterns.PATTERN_KEYS]
    kind, label = F.when(ladder[0][0], ladder[0][1]), F.when(ladder[0][0], ladder[0][2])
    for condition, value, name in ladder[1:]:
        kind, label = kind.when(condition, value), label.when(condition, name)
    return kind.otherwise("unknown"), label.otherwise("none")


def drop_pattern_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("p_")])


def classify_urls(df: DataFrame, patterns: UrlPatterns, url: str = "url",
                  type_name: str = "url_result_type", label_name: str = "matched_pattern") -> DataFrame:
    """Add URL type and matched pattern."""
    kind, label = url_type(patterns)
    joined = join_patterns(df, patterns, url)
    return drop_pattern_columns(tx.settle(joined, {type_name: kind, label_name: label}))


# --- path statistics -----------------------------------------------------------

def path_prefixes(url: Column) -> Column:
    """Full path and its first one to three segments, each ending in '/'.

    A path of at most three segments appears twice, once in full and once as
    its own prefix; the counts rely on that.
    """
    none = F.array().cast("array<string>")

    def body(p: Column) -> Column:
        full = F.when(p == "/", none).otherwise(F.array(F.regexp_replace(p, "(?s)([^/])$", "$1/")))

        def prefixes(parts: Column) -> Column:
            steps = F.least(F.size(parts), F.lit(3))
            return F.when(steps < 1, none).otherwise(F.transform(
                F.sequence(F.lit(1), F.greatest(steps, F.lit(1))),
                lambda n: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), n), "/"), F.lit("/"))))

        return F.concat(full, tx.let(segments(p), prefixes))

    return tx.let(F.regexp_replace(path(url), "^$", "/"), body)


def page_extent(html: Column, limit: int | None = None) -> Column:
    """Highest linked page number, at least 1; a fetch plan may bound it by ``limit``."""
    numbers = F.transform(
        F.regexp_extract_all(tx.nz(html), F.lit(r"[?&]page=(\d+)"), F.lit(1)),
        lambda n: n.try_cast("int"),
    )
    found = F.coalesce(F.array_max(numbers), F.lit(1))
    return found if limit is None else F.least(found, F.lit(limit))
