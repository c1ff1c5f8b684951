"""Single rules on literal rows."""

import json

import pytest
from pyspark.sql import functions as F

from siftworks.functions import classify as cl, identity as ident, reasons as rs, scoring as sc, text as tx, urls
from siftworks.operators import aggregates as ag, joins as jn, projections as pj
from siftworks.rules import (
    CleanRules, CommunityRules, PostingRules, QualityRules, ReportRules, StudentRules, UrlPatterns, WeightedRules, load_rules,
)
from siftworks.sources import catalog, pages as pg, payloads as pl


def one(spark, value, expression, name="v"):
    return spark.createDataFrame([(value,)], f"{name} string").select(expression(F.col(name)).alias("r")).first().r


@pytest.mark.parametrize("url, expected", [
    ("HTTPS://WWW.Example.com/Jobs/?b=2&utm_source=x&A=1#top", "https://www.example.com/Jobs?b=2&A=1"),
    ("https://example.com/", "https://example.com/"),
    ("https://example.com", "https://example.com"),
    ("https://e.com/a//?k&x=%20y+z~*", "https://e.com/a?k=&x=+y+z~%2A"),
    ("https://duckduckgo.com/l/?uddg=https%3A%2F%2FIt.example.org%2Fjob%2F1%3Futm_term%3Dq&rut=1", "https://it.example.org/job/1"),
    ("https://e.com/?q=100%&b=%zz", "https://e.com/?q=100%25&b=%25zz"),
    ("  https://e.com/x?GCLID=1  ", "https://e.com/x"),
    ("", ""), (None, ""),
])
def test_canonical_url(spark, url, expected):
    assert one(spark, url, urls.canonical_url) == expected


def test_canonical_variants(spark):
    link = "https://d.com/l/?uddg=https%3A%2F%2Fe.com%2Fa%2F"
    assert one(spark, link, lambda c: urls.canonical_url(c, unwrap=False)) == "https://d.com/l?uddg=https%3A%2F%2Fe.com%2Fa%2F"
    assert one(spark, "NaN", lambda c: urls.canonical_url(c, unwrap=False, nan_is_blank=True)) == ""
    assert one(spark, link, urls.redirect_target) == "https://e.com/a/"


def test_resolve(spark):
    base = F.lit("https://e.com/a/b?x=1")
    cases = {"/c": "https://e.com/c", "d": "https://e.com/a/d", "?p=2": "https://e.com/a/b?p=2", "//f.org/g": "https://f.org/g",
             "http://z.de/": "http://z.de/", "../up": "https://e.com/up"}
    for link, expected in cases.items():
        assert one(spark, link, lambda c: urls.resolve(base, c)) == expected


PATTERNS = UrlPatterns.from_mapping({
    "randstad": {"domains": ["www.randstad.it"], "search_before_job": True, "job_all": ["/offerte-lavoro/", "_"],
                 "search": ["/offerte-lavoro/", "/page-", "/offerte-lavoro/q-"]},
    "gigroup": {"domains": ["gigroup.it"], "job": ["/jobs/"], "search": ["/jobs/all", "/offerte-lavoro/"]},
    "talent": {"domains": ["it.talent.com"], "job": ["/view?id="], "search": ["/jobs?"]},
    "general_exclude_domains": ["bad.it"],
})


@pytest.mark.parametrize("url, kind, label", [
    ("https://www.randstad.it/offerte-lavoro/", "search_page", "randstad_search"),
    ("https://www.randstad.it/offerte-lavoro/addetto_napoli_1/", "real_job", "randstad_job"),
    ("https://www.randstad.it/offerte-lavoro/q-napoli/", "search_page", "randstad_search"),
    ("https://www.randstad.it/offerte-lavoro/x_y/page-2/", "search_page", "randstad_search"),
    ("https://www.gigroup.it/jobs/all?x=1", "search_page", "gigroup_search"),
    ("https://gigroup.it/jobs/12", "real_job", "gigroup_job"),
    ("https://it.talent.com/view?id=3", "real_job", "talent_job"),
    ("https://www.bad.it/jobs/1", "excluded_domain", "general_exclude_domains"),
    ("https://other.org/jobs/1", "unknown", "none"), ("", "unknown", "none"), ("not a url", "unknown", "none"),
])
def test_url_type(spark, url, kind, label):
    row = urls.classify_urls(spark.createDataFrame([(url,)], "url string"), PATTERNS).first()
    assert (row.url_result_type, row.matched_pattern) == (kind, label)


def test_path_prefixes_count_short_paths_twice(spark):
    assert one(spark, "https://e.com/a/b", urls.path_prefixes) == ["/a/b/", "/a/", "/a/b/"]
    assert one(spark, "https://e.com/a/b/c/d/", urls.path_prefixes) == ["/a/b/c/d/", "/a/", "/a/b/", "/a/b/c/"]
    assert one(spark, "https://e.com", urls.path_prefixes) == []


def test_matching_dialects(spark):
    assert one(spark, "looking through", lambda c: tx.has_any(c, ["hr"]))
    assert not one(spark, "looking through", lambda c: tx.has_phrase(c, ["hr"]))
    assert not one(spark, "new [for hire] post", lambda c: tx.has_phrase(c, ["[for hire]"]))
    assert one(spark, "città è bella", lambda c: tx.has_phrase(c, ["è"]))
    assert one(spark, "pay $/hour and data\n entry", lambda c: tx.token_terms(c, ["$/hour", "data entry", "dat"])) == ["$/hour", "data entry"]
    df = spark.createDataFrame([("mit license, for license of mit",)], "t string")
    assert tx.find_phrases(df, "t", ["license", "mit license", "license mit", "mit"], "f").first().f == ["license", "mit license", "mit"]


def test_plain_text_and_entities(spark):
    html = "<p>A &amp; B&#233;&#x20AC; &lt;x&gt;</p><script>var a='<p>';</script><br/>end"
    assert one(spark, html, tx.visible_text) == "A & Bé€ <x>. end"
    assert one(spark, "a&amp;lt;b", tx.unescape) == "a&lt;b"


def test_small_text_helpers(spark):
    assert one(spark, "one two three", lambda c: tx.cut_at_word(c, 9, "...")) == "one two..."
    assert one(spark, "https://s.it/x/lavoro-bello-123.htm", lambda c: tx.title_from_url(c, cut_underscore=False, drop_suffix=".htm")) == "lavoro bello"
    assert one(spark, "Clerk at Acme - Rome", lambda c: F.concat_ws("/", *tx.split_title(c))) == "Clerk/Acme - Rome"
    assert one(spark, "Clerk - Acme", lambda c: F.concat_ws("/", *tx.split_title(c))) == "Clerk/Acme"
    items = spark.createDataFrame([(["b", " B", "", "a", None],)], "i array<string>")
    assert items.select(tx.distinct_items(F.col("i")).alias("r")).first().r == ["b", "a"]
    assert one(spark, "Contratto: tempo pieno  Orario: mattina Sede: Napoli", lambda c: tx.label_value(c, ["Contratto", "Orario"])) == "tempo pieno"


def test_times(spark):
    seconds = lambda v: one(spark, v, lambda c: F.unix_timestamp(ident.parse_time(c)))
    assert seconds("2026-07-01T12:00:00Z") == seconds("Wed, 01 Jul 2026 14:00:00 +0200") == seconds("1782907200")
    assert seconds("2026-07-01T12:00:00") == 1782907200
    assert seconds("soon") is None and seconds("") is None
    now = F.lit("2026-07-08 11:59:59").cast("timestamp")
    assert one(spark, "2026-07-01T12:00:00Z", lambda c: ident.age_days(ident.parse_time(c), now)) == 6
    assert one(spark, "", lambda c: ident.age_days(ident.parse_time(c), now)) is None


def test_hashes_equal_compact_json(spark):
    import hashlib
    df = spark.createDataFrame([("", "src", 'Tìtle "x"', "Acme", "Napoli")], "url string, source string, title string, company string, location string")
    expected = hashlib.sha256(json.dumps(['src|tìtle "x"|acme|napoli'], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    assert df.select(ident.job_id(df).alias("r")).first().r == expected
    fields = {n: "" for n in ident.SENT_CONTENT_FIELDS} | {"title": 'Tìtle "x"', "company": "Acme", "location": "Napoli"}
    expected = hashlib.sha256(json.dumps(fields, ensure_ascii=False, sort_keys=True).encode()).hexdigest()
    assert df.select(ident.sent_content_hash(df).alias("r")).first().r == expected


def test_quality_case(spark):
    df = spark.createDataFrame([("Worldwide contract shipping dashboard role $30000 - $50000", "Acme", "Worldwide", "")],
                               "title string, company string, location string, description string")
    row = sc.add_quality(df, QualityRules()).first()
    assert (row.normalized_remote_category, row.country_restriction, row.employment_type) == ("Logistics", "Worldwide", "Contract")
    assert (row.salary_min, row.salary_max, row.currency) == (30000, 50000, "USD")
    assert row.positive_reason.startswith("+35 Data: dashboard; +40 Logistics: shipping; +20 country: Worldwide; +5 salary present")


def test_weighted_score_and_excluded_title(spark):
    rules = WeightedRules(positive=(("python", 30), ("data entry", 20)), combos=((("python", "data entry"), 15, "both"),),
                          negative=(("advice", -50),), excluded_titles=("engineer",), source_bonus={"s": 10})
    df = spark.createDataFrame([("Python data entry", "s", "no advice"), ("Engineer", "s", "python")], "title string, source string, description string")
    rows = sc.add_weighted_score(sc.add_quality(df, QualityRules((), (), (), {}, (), ())), rules).orderBy("title").collect()
    assert (rows[0].job_score, rows[0].score_reason) == (-100, "excluded title: engineer")
    assert (rows[1].job_score, rows[1].score_reason) == (25, "+30 python, +20 data entry, +15 both, -50 advice")


def test_remote_flag_and_category(spark):
    rules = PostingRules()
    flag = lambda title, text: tuple(spark.createDataFrame([(title, text)], "a string, b string").select(
        *[c.alias(n) for n, c in zip("xy", cl.remote_flag([("title", F.col("a")), ("description", F.col("b"))], rules))]).first())
    assert flag("Remote clerk", "") == (True, "title: remote")
    assert flag("Remote clerk", "lavoro in sede") == (False, "negative: in sede")
    assert flag("Clerk", "") == (False, "none")
    kind = lambda text: one(spark, text, lambda c: cl.category(c, rules))
    assert [kind(t) for t in ("ai trainer", "data entry", "hotel", "magazziniere", "x")] == ["ai_annotation", "data_entry", "hotel", "warehouse", "other"]


def test_match_score_rounds_half_even(spark):
    df = spark.createDataFrame([(50, 50), (90, 100), (10, 0)], "s int, c int")
    assert [r.m for r in df.select(sc.match_score(F.col("s"), F.col("c")).alias("m")).collect()] == [50, round(0.45 * 90 + 55), round(4.5)]


def test_student_unwanted_title_zeroes_scores(spark):
    book = pj.RuleBook(student=StudentRules(preferred_titles=("call center",), unwanted_titles=("telemarketing",)))
    df = spark.createDataFrame([("Call-Center   Part Time",), ("Telemarketing",)], "title string")
    rows = {r.title: r for r in pj.normalize_posting(df, book).collect()}
    assert rows["Call-Center   Part Time"].matched_keyword == "call center"
    bad = rows["Telemarketing"]
    assert (bad.student_score, bad.candidate_score, bad.match_score, bad.selection_rejection_reason) == (0, 0, 0, "unwanted_title")


def test_clean_modes(spark):
    rows = [("Clerk", "https://gigroup.it/jobs/1", ""), ("Offerte", "https://gigroup.it/jobs/all", ""), ("Un concorso", "https://gigroup.it/jobs/2", ""),
            ("x", "https://none.org/a?q=1", ""), ("x", "https://none.org/cerca/1", ""), ("annunci oggi", "https://none.org/z", "")]
    df = jn.classify_results(spark.createDataFrame(rows, "title string, url string, description string"), PATTERNS, CleanRules())
    kinds = [r.result_type for r in df.orderBy("url", "title").collect()]
    assert sorted(kinds) == sorted(["job", "search_page", "article", "search_page", "category_page", "aggregator_page"])
    assert df.filter(cl.keep_by_mode(df, "strict", CleanRules())).count() == 1
    summary = ag.clean_summary(df, cl.keep_by_mode(df, "strict", CleanRules())).first()
    assert summary.total_before == summary.total_after + sum(v for k, v in summary.asDict().items() if k.startswith("removed_"))


def test_community_post(spark):
    now = F.lit("2026-07-01 00:00:00").cast("timestamp")
    rows = [("Remote data annotation", "Paid hourly contract, apply by email. Work from home on data labeling tasks for a long term project.", "2026-06-20T00:00:00Z"),
            ("Easy money crypto", "dm me", "2026-06-20T00:00:00Z"), ("Remote assistant", "Paid, apply by form", "2026-01-01T00:00:00Z")]
    df = sc.add_post_score(spark.createDataFrame(rows, "title string, body string, created_at string"), now, CommunityRules())
    out = {r.title: (r.score, r.reason) for r in df.withColumn("reason", rs.post_rejection(df)).collect()}
    assert out["Remote data annotation"] == (90, "")
    assert out["Easy money crypto"][1] == "scam_signal"
    assert out["Remote assistant"][1] in ("", "too_old")


def test_payloads_and_feeds(spark):
    payload = json.dumps({"data": [{"title": "T", "company": {"name": "C"}, "category": {"name": "K"}, "url": "", "apply_url": "u"}]})
    df = spark.createDataFrame([(1, payload), (2, "{bad")], "seq int, payload string")
    rows = pl.flatten_payload(df, pl.PAYLOAD_RULES["remotejobs_org"]).collect()
    assert [(r.seq, r.title, r.company, r.category, r.url) for r in rows] == [(1, "T", "C", "K", "u")]
    atom = ("<feed xmlns='http://www.w3.org/2005/Atom'><entry><title>A</title><content>B</content><link rel='alternate' href='h'/>"
            "<id>i</id><updated>2026-06-01T00:00:00Z</updated><author><name>n</name></author></entry></feed>")
    row = pl.atom_entries(spark.createDataFrame([(1, atom)], "seq int, xml string")).first()
    assert (row.title, row.body, row.url, row.author, row.created_at) == ("A", "B", "h", "n", "2026-06-01T00:00:00Z")


def test_page_extraction(spark):
    html = """<a class="x" href="/offerte-lavoro/commesso_napoli_1/"><b>Commesso</b></a><a href='/offerte-lavoro/q-napoli/'>no</a>
      <a href="https://www.randstad.it/offerte-lavoro/cuoco_roma_2/?utm_source=a"></a><a href="/offerte-lavoro/commesso_napoli_1/">again</a>"""
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = pg.site_links(df, "randstad").orderBy("pos").collect()
    assert [(r.link_url, r.title) for r in rows] == [
        ("https://www.randstad.it/offerte-lavoro/commesso_napoli_1", "Commesso"), ("https://www.randstad.it/offerte-lavoro/cuoco_roma_2", "cuoco")]
    card = '<div data-new-id="7"><h2>Baker</h2><span class="JobCard_company">Acme</span></div><a href="/view?id=8">Apply</a><a href="/view?id=9">Clerk</a>'
    cards = {r.link_url[-1]: (r.title, r.company) for r in pg.talent_cards(spark.createDataFrame([(1, card)], "page_id int, html string")).collect()}
    assert cards == {"7": ("Baker", "Acme"), "9": ("Clerk", "")}
    article = """<article class="a ggp-job-item"><a href="/offerte-lavoro-dettaglio/x/12" data-job='{&quot;offerTitle&quot;: &quot;Cook&quot;, &quot;province&quot;: &quot;NA&quot;}'>t</a></article>"""
    job = pg.gigroup_articles(spark.createDataFrame([(1, article)], "page_id int, html string")).first()
    assert (job.title, job.location, job.company) == ("Cook", "NA", "Gi Group")
    result = ('<div class="singleResult x"><a href="job.php?id=1"><h3>Cook</h3></a><table><tr><th><label>Settore:</label></th><td>Food</td></tr>'
              '<tr><th><label>Luogo di lavoro</label></th><td>Rome</td></tr></table><div class="descriptionContainer">Long text</div>')
    row = pg.arca24_results(spark.createDataFrame([(1, result)], "page_id int, html string"), "https://a.it", "A").first()
    assert (row.title, row.location, row.sector, row.url, row.description) == ("Cook", "Rome", "Food", "https://a.it/job.php?id=1", "Long text")
    detail = "<div>Contratto: tempo determinato</div><div>Orario di lavoro: full time</div><div>Luogo di lavoro: Napoli</div><p>excel</p>"
    row = pg.detail_fields(spark.createDataFrame([(1, detail)], "page_id int, html string")).first()
    assert (row.contract_type, row.location, row.full_time, row.company, row.skills) == ("tempo determinato", "Napoli", True, "Gi Group", "excel")


def test_search_urls(spark):
    url = lambda site, q: one(spark, q, lambda c: catalog.search_url(site, c))
    assert url("gigroup", "offerte lavoro Napoli") == "https://www.gigroup.it/offerte-lavoro/?job=&placeOfWork=Napoli&radius=25"
    assert url("gigroup", "back office Napoli") == "https://www.gigroup.it/offerte-lavoro/?job=back+office&placeOfWork=Napoli&radius=25"
    assert url("randstad", "Data entry Napoli") == "https://www.randstad.it/offerte-lavoro/q-data-entry-napoli/"
    assert url("adecco", " a b ") == "https://www.adecco.it/lavoro/?k=a+b"


def test_rule_files(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"positive_weights": {"a": 1}, "combo_weights": [{"phrases": ["a", "b"], "points": 2, "reason": "r"}],
                                "priority": {"high_score": 500}, "export": {"top_report_limit": 9}}))
    rules = WeightedRules.from_mapping(load_rules(str(path)))
    assert (rules.positive, rules.combos, rules.high, rules.medium, rules.top_limit) == ((("a", 1),), ((("a", "b"), 2, "r"),), 500, 75, 9)
    with pytest.raises(FileNotFoundError):
        load_rules(str(tmp_path / "none.json"))
    assert load_rules(str(tmp_path / "none.json"), required=False) == {}
    (tmp_path / "empty.json").write_text("")
    with pytest.raises(ValueError):
        load_rules(str(tmp_path / "empty.json"))
