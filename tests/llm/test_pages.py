import base64
import hashlib
import html as h
import re

from pyspark.sql import functions as F

from siftworks.llm import html_extract as he
from siftworks.llm import warc
from siftworks.session import scratch_path

SCHEMA = "page_id long, url string, html string, type string, file string"


def brute_records(rows, least):
    payloads = [(p, (t or "").encode()) for p, _, t in rows]
    first = {}
    for p, b in payloads:
        if p is not None:
            first[b] = min(first.get(b, p), p)
    out = []
    for p, b in payloads:
        revisit = p is not None and len(b) >= least and first[b] < p
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", first[b] if revisit else None, True))
    return sorted(out, key=str)


FAKE = "<pre>WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n</pre>"


def test_round_trip(spark):
    rows = [(5, "http://a/", "same"), (2, None, "same"), (9, "u\r\nx: y", "same"), (3, "b", None), (4, "c", ""), (6, "d", FAKE), (7, "e", FAKE),
            (8, "f", "WARC/1.0\r\n"), (10, "g", "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 999999\r\n\r\n" + "é😀" * 20_000),
            (11, "h", "WARC/1.0\r\n" * 50), (12, "i", "tail WARC/1.0\r"), (None, "j", "nobody"), (13, "k", "\r\n\r\n" * 3), (14, "l", "ab"), (15, "m", "ab")]
    pages = spark.createDataFrame([(p, u, t, "x", "y") for p, u, t in rows], SCHEMA).repartition(3)
    for least in (0, 3):
        assert sorted((tuple(r) for r in warc.archive_round_trip(pages, least).collect()), key=str) == brute_records(rows, least)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_small_blocks_and_the_files_themselves(spark):
    rows = [(i, "u", f"page {i} " * (i % 40)) for i in range(200)] + [(500, "v", FAKE * 30)]
    pages = spark.createDataFrame([(p, u, t, "x", "y") for p, u, t in rows], SCHEMA).repartition(2)
    path = scratch_path(spark, "warc-test")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = sorted((tuple(r) for r in warc.archive_round_trip(pages, 0, path).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == brute_records(rows, 0)
    # The bytes of each file are a plain chain of records.
    seen = 0
    for row in spark.read.format("binaryFile").load(path).collect():
        data, at = bytes(row["content"]), 0
        while at < len(data):
            assert data[at:at + 10] == b"WARC/1.0\r\n"
            end = data.index(b"\r\n\r\n", at) + 4
            at = end + int(re.search(rb"Content-Length: (\d+)", data[at:end])[1]) + 4
            assert data[at - 4:at] == b"\r\n\r\n"
            seen += 1
    assert seen == len(rows)


def test_given_pages(spark):
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        body = row["html"][row["html"].index("<article>"):row["html"].rindex("</article>")]
        want = " ".join(h.unescape(re.sub("</?b>", "", re.sub("</?(?:p|h1|br|article)>", "\n", body))).split())
        assert he.main_text(row["html"])[0] == want


PAGE = """<!doctype html><html><head><title>T</title><style>x{}</style></head><body class="has-sidebar"><div class="cookie-notice">We use cookies on this site and more words here</div>
<header class="site-header"><a href="/">Home page of a site</a></header><ul class="menu"><li><a href=1>One<li><a href=2>Two</ul>
<div id="content"><h2>Head &amp; line</h2><p>First para<b>graph</b> with&nbsp;several words, and more of them to make it long enough.<p>Second one, also of a good length; unclosed as well &#8364; 5.
<div class="ad-box">Buy this thing now, the best thing there is for you and others</div><p>Short.</p><p>Third paragraph of the article comes with <a href=x>a link</a> in it and goes on.</p></div>
<aside>Some side text that is long enough to count as a paragraph of text.</aside><form>Your mail <input></form><div class="comments"><p>A reader writes a comment that is long enough to be content.</p></div>
<script>var a = "<p>not text</p>";</script><footer>Copyright and so on</footer></body></html>"""


def test_parts_around_the_article():
    assert he.main_text(PAGE)[0] == ("Head & line First paragraph with several words, and more of them to make it long enough. "
                                     "Second one, also of a good length; unclosed as well € 5. Short. Third paragraph of the article comes with a link in it and goes on.")
    assert he.main_text(PAGE.replace('<div id="content">', "<main><article>").replace("goes on.</p></div>", "goes on.</p></article></main>"))[0] == he.main_text(PAGE)[0]
    assert he.main_text(None) == he.main_text("") == he.main_text("<nav>only a menu</nav>") == ("", 0)
    assert he.main_text("just text")[0] == "just text"


def test_several_content_regions():
    line = "Sentence {} of the story has quite a number of words in it, so that it counts as text."
    part = lambda a, b: "".join(f"<p>{line.format(i)}</p>" for i in range(a, b))
    text = lambda a, b: " ".join(line.format(i) for i in range(a, b))
    nav, foot = "<nav><a href=1>One</a> <a href=2>Two</a></nav>", "<footer>Copyright and so on</footer>"
    for cut in (3, 5, 6):
        articles = f"<article>{part(0, cut)}</article><article>{part(cut, 10)}</article>"
        assert he.main_text(f"<body>{nav}{articles}{foot}</body>")[0] == text(0, 10)
        assert he.main_text(f"<body>{nav}<div>{articles}</div>{foot}</body>")[0] == text(0, 10)
    lead = f"<h1>The head</h1><div class=lead><p>{line.format('lead')}</p></div>"
    assert he.main_text(f"<body>{nav}{lead}<div class=body>{part(0, 15)}</div>{foot}</body>")[0] == " ".join(["The head", line.format("lead"), text(0, 15)])
    assert he.main_text(f"<body>{nav}<main>{lead}<article>{part(0, 15)}</article></main>{foot}</body>")[0] == " ".join(["The head", line.format("lead"), text(0, 15)])
    assert he.main_text(f"<body>{nav}<h1>The head</h1><div class=body>{part(0, 15)}</div>{foot}</body>")[0] == f"The head {text(0, 15)}"


def test_extraction_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x", "y"), (1, "u", PAGE, "x", "y"), (None, None, None, None, None), (3, "w", "<p>" + "word " * 50_000, "x", "y")], SCHEMA)
    got = sorted((tuple(r) for r in he.extract_main_text(pages).select("page_id", "url", F.length("text") == F.col("n_chars"), "n_chars").collect()), key=str)
    assert [r[2] for r in got] == [True] * 4 and {r[3] for r in got} == {0, 249_999, len(he.main_text(PAGE)[0])}
    assert he.extract_main_text(pages.limit(0)).count() == 0


def test_odd_declarations_and_parts_within_a_line():
    from siftworks.llm.html_extract import main_text
    page = "<html><body><article><p>One long line of text that is the article itself{}.</p><p>And another line of it.</p></article></body></html>"
    want = "One long line of text that is the article itself. And another line of it."
    for part in ("<![foo[ x ]]>", "<span hidden> not shown</span>", '<span class="advert"> buy <b>this</b></span>', '<i style="display: none">x</i>', "<![if IE]>"):
        found = main_text(page.format(part))[0]
        assert found.replace(" x ]]>", "").replace("]]>", "") == want, (part, found)
