"""Building blocks of the comparison SQL (DuckDB dialect)."""

from __future__ import annotations

import re

from checks.views import postings_sql, threads_sql
from siftworks.functions.text import profile_term
from siftworks.rules import fixed_values as fv

RFC = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def q(text: str) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def arr(items) -> str:
    items = list(items)
    return "[" + ", ".join(q(i) for i in items) + "]" if items else "CAST([] AS VARCHAR[])"


def any_of(text: str, terms) -> str:
    return "(" + " OR ".join(f"contains({text}, {q(t)})" for t in terms) + ")" if terms else "false"


def first_of(text: str, terms) -> str:
    return "CASE " + " ".join(f"WHEN contains({text}, {q(t)}) THEN {q(t)}" for t in terms) + " END"


def label_of(text: str, labelled, otherwise: str) -> str:
    whens = " ".join(f"WHEN {any_of(text, terms)} THEN {q(label)}" for label, terms in labelled)
    return f"CASE {whens} ELSE {otherwise} END"


def points_of(text: str, groups) -> str:
    return "(" + " + ".join(f"CASE WHEN {any_of(text, terms)} THEN {n} ELSE 0 END" for terms, n in groups) + ")"


def matched(text: str, terms) -> str:
    return f"list_filter({arr(terms)}, lambda t: contains({text}, t))"


def word_rx(phrase: str) -> str:
    """Whole-word pattern without look-around, for letters of any script."""
    phrase = phrase.lower()
    escaped = re.sub(r"([\\.\[\](){}*+?^$|])", r"\\\1", phrase)
    inside, outside = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
    is_word = lambda c: c.isalnum() or c == "_"
    left = f"(^|{outside})" if is_word(phrase[0]) else inside
    right = f"({outside}|$)" if is_word(phrase[-1]) else inside
    return left + escaped + right


def has_word(text: str, phrase: str) -> str:
    return f"regexp_matches({text}, {q(word_rx(phrase))})"


def any_word(text: str, phrases) -> str:
    return "(" + " OR ".join(has_word(text, p) for p in phrases) + ")"


def token_rx(term: str) -> str:
    parts = [re.sub(r"([\\.\[\](){}*+?^$|])", r"\\\1", w) for w in term.lower().split(" ")]
    return r"(^|[^a-z0-9])" + r"\s+".join(parts) + r"([^a-z0-9]|$)"


def has_token(text: str, term: str) -> str:
    term = term.lower()
    if re.match(r"[a-z0-9]", term) and re.search(r"[a-z0-9]$", term):
        return f"regexp_matches({text}, {q(token_rx(term))})"
    return f"contains({text}, {q(term)})"


def any_token(text: str, terms) -> str:
    return "(" + " OR ".join(has_token(text, t) for t in terms) + ")"


def token_list(text: str, terms) -> str:
    items = ", ".join(f"CASE WHEN {has_token(text, t)} THEN {q(t.lower())} END" for t in terms)
    return f"list_filter([{items}], lambda t: t IS NOT NULL)"


def squeeze(text: str) -> str:
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


def profile_text(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '[^a-z0-9àèéìòù]+', ' ', 'g'))"


def profile_terms(terms):
    return [profile_term(t) for t in terms]


# --- URLs ------------------------------------------------------------------------

def part(url: str, group: int) -> str:
    return f"regexp_extract({url}, {q(RFC)}, {group})"


def host(url: str) -> str:
    return f"regexp_replace(lower(regexp_extract({part(url, 2)}, '^(?:.*@)?(\\[[^\\]]*\\]|[^:]*)', 1)), '^www\\.', '')"


def decode(value: str) -> str:
    return f"url_decode(replace({value}, '+', ' '))"


def encode(value: str) -> str:
    return f"replace(url_encode({value}), '%20', '+')"


def pairs(query: str) -> str:
    return f"list_filter(str_split({query}, '&'), lambda p: p <> '')"


def pair_name(p: str) -> str:
    return decode(f"split_part({p}, '=', 1)")


def pair_value(p: str) -> str:
    return f"CASE WHEN contains({p}, '=') THEN {decode(f'substr({p}, instr({p}, chr(61)) + 1)')} ELSE '' END"


def param(url: str, name: str) -> str:
    hits = f"list_filter({pairs(part(url, 4))}, lambda p: {pair_name('p')} = {q(name)})"
    return f"coalesce({pair_value(f'list_extract({hits}, -1)')}, '')"


def query_keys(url: str) -> str:
    return f"list_distinct(list_transform({pairs(part(url, 4))}, lambda p: lower({pair_name('p')})))"


def unwrap(url: str) -> str:
    a, b = param(url, "uddg"), param(url, "url")
    return f"CASE WHEN {a} <> '' THEN url_decode({a}) WHEN {b} <> '' THEN url_decode({b}) ELSE {url} END"


def canonical(url: str) -> str:
    """Canonical form of an already unwrapped URL column."""
    keep = f"list_filter({pairs(part(url, 4))}, lambda p: NOT list_contains({arr(fv.TRACKING_PARAMETERS)}, lower({pair_name('p')})))"
    query = f"coalesce(array_to_string(list_transform({keep}, lambda p: concat({encode(pair_name('p'))}, '=', {encode(pair_value('p'))})), '&'), '')"
    path = f"CASE WHEN rtrim({part(url, 3)}, '/') = '' THEN {part(url, 3)} ELSE rtrim({part(url, 3)}, '/') END"
    return (
        f"CASE WHEN {url} = '' THEN '' ELSE concat("
        f"CASE WHEN {part(url, 1)} <> '' THEN concat(lower({part(url, 1)}), ':') ELSE '' END, "
        f"CASE WHEN {part(url, 2)} <> '' THEN concat('//', lower({part(url, 2)})) ELSE '' END, {path}, "
        f"CASE WHEN {query} <> '' THEN concat('?', {query}) ELSE '' END) END"
    )


def target(url: str) -> str:
    path = f"CASE WHEN {part(url, 3)} = '' THEN '/' ELSE {part(url, 3)} END"
    return f"lower(CASE WHEN {part(url, 4)} <> '' THEN concat({path}, '?', {part(url, 4)}) ELSE {path} END)"


# --- common tables ----------------------------------------------------------------

def with_postings(*ctes: str) -> str:
    return "WITH postings AS (" + postings_sql() + ")" + "".join(", " + c for c in ctes) + " "


def with_threads(*ctes: str) -> str:
    return "WITH threads AS (" + threads_sql() + ")" + "".join(", " + c for c in ctes) + " "


def canon_ctes(source: str = "postings", name: str = "canon", url: str = "url") -> str:
    """CTE that adds ``curl``, the canonical URL, to a table."""
    return (
        f"{name}_1 AS MATERIALIZED (SELECT *, {unwrap(url)} AS u1 FROM {source}), "
        f"{name} AS MATERIALIZED (SELECT * EXCLUDE (u1), {canonical('u1')} AS curl FROM {name}_1)"
    )


def url_type_ctes(patterns, source: str, name: str = "typed", url: str = "url") -> str:
    """CTE that adds utype and upattern, the URL type and matched pattern label."""
    whens_type, whens_label = [], []

    def add(condition: str, kind: str, label: str) -> None:
        whens_type.append(f"WHEN {condition} THEN {q(kind)}")
        whens_label.append(f"WHEN {condition} THEN {q(label)}")

    add("h = ''", "unknown", "none")
    excluded = [d.removeprefix("www.") for d in patterns.excluded_domains]
    add(f"list_contains({arr(excluded)}, h)", "excluded_domain", "general_exclude_domains")
    for s in patterns.sources:
        src, hosts = s["source"], [d.removeprefix("www.") for d in s["domains"]]
        mine = f"list_contains({arr(hosts)}, h)"
        search = [p.lower() for p in s.get("search", [])]
        job = [p.lower() for p in s.get("job", [])]
        first = bool(s.get("search_before_job"))
        if src == "randstad" and first:
            tests = [f"contains(t, {q(p)})" if p != "/offerte-lavoro/" else "rtrim(t, '/') = '/offerte-lavoro'" for p in search]
            add(f"{mine} AND ({' OR '.join(tests)})", "search_page", src + "_search")
            other = [p for p in search if p != "/page-"]
            add(f"{mine} AND contains(t, '/page-') AND {any_of('t', other)}", "search_page", src + "_search")
        longer = [f"(contains(t, {q(a)}) AND contains(t, {q(b)}))" for a in search for b in job if a.startswith(b) and len(a) > len(b)]
        if longer:
            add(f"{mine} AND ({' OR '.join(longer)})", "search_page", src + "_search")
        if s.get("job_all"):
            add(f"{mine} AND " + " AND ".join(f"contains(t, {q(p.lower())})" for p in s["job_all"]), "real_job", src + "_job")
        if first and search:
            add(f"{mine} AND {any_of('t', search)}", "search_page", src + "_search")
        for key in patterns.PATTERN_KEYS:
            found = [p.lower() for p in s.get(key, [])]
            if found:
                kind = {"job": "real_job", "search": "search_page"}.get(key, key)
                add(f"{mine} AND {any_of('t', found)}", kind, f"{src}_{key}")
    return (
        f"{name}_1 AS MATERIALIZED (SELECT *, {host(url)} AS h, {target(url)} AS t FROM {source}), "
        f"{name} AS MATERIALIZED (SELECT * EXCLUDE (h, t), CASE {' '.join(whens_type)} ELSE 'unknown' END AS utype, "
        f"CASE {' '.join(whens_label)} ELSE 'none' END AS upattern FROM {name}_1)"
    )
