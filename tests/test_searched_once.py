"""A long text is lowered, searched, hashed and moved once, with the results of the plain forms."""

import pytest
from pyspark.sql import functions as F

from checks import views
from checks.corpus import BOOK
from siftworks.functions import identity as ident, text as tx
from siftworks.operators import history as hs, joins as jn, projections as pj

TERMS = ["the", "of of", "a\0b", "", "napoli", "ας", "é x", "one two three"]
# Short texts around a long one; terms lie in it, around it and across its ends.
TEXTS = [
    ("", "", ""), (None, None, None), ("xx of", "of yy" + " z" * 60, "end"), ("", "THE" + " z" * 60 + " nap", "oli"), ("one", "two", "three"),
    ("one", "two" + " z" * 60, "three"), ("a", "\0b", ""), ("x", "of" + "\0" * 60 + "of", ""), ("ΑΣ", "ΤΑΣ" + " z" * 60 + "ΚΑΣ", "Σ"),
    ("cafÉ", "x" + "İ" * 60, "nap oli"), ("", "z " * 60 + "Napoli" + " z" * 60, ""), ("of", "of", ""), ("o", "of   of" + "-" * 80 + "the", "of"),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, *t) for i, t in enumerate(TEXTS)], "seq int, a string, d string, z string")


def test_a_joined_text_holds_what_the_plain_one_holds(texts):
    long = tx.LongText(TERMS, "d")
    joined = tx.Joined(long, [F.col("a")], [F.col("z")])
    plain = F.lower(F.concat_ws(" ", *[tx.nz(F.col(c)) for c in "adz"]))
    every = [*TERMS, "not in the book", "z z"]
    rows = long.add(texts, F.col("d")).select("seq", F.array(*[joined.holds(t) for t in every]).alias("now"),
                                              F.array(*[F.contains(plain, F.lit(t)) for t in every]).alias("was"),
                                              F.array(*[tx.Joined(long).holds(t) for t in every]).alias("alone"),
                                              F.array(*[F.contains(F.lower(tx.nz(F.col("d"))), F.lit(t)) for t in every]).alias("was_alone"))
    got = rows.collect()
    assert [r for r in got if r.now != r.was or r.alone != r.was_alone] == [] and any(any(r.now) for r in got)


def test_a_profile_holds_what_its_text_holds(texts):
    terms = [tx.profile_term(t) for t in ("the", "of of", "napoli", "nap oli", "one two three", "café x", "++", "z of")]
    long = tx.LongText([w for t in terms for w in t.split(" ")], "d")
    profile = tx.Profile(tx.Joined(long, [F.col("a")], [F.col("z")]))
    plain = tx.profile_text(F.concat_ws(" ", *[tx.nz(F.col(c)) for c in "adz"]))
    got = long.add(texts, F.col("d")).select("seq", F.array(*[profile.holds(t) for t in terms]).alias("now"),
                                             F.array(*[F.contains(plain, F.lit(t)) for t in terms]).alias("was")).collect()
    assert [r for r in got if r.now != r.was] == [] and any(any(r.now[1:]) for r in got)


def test_space_is_trimmed_as_by_the_pattern(spark):
    space = [chr(c) for c in range(0x3001) if chr(c).isspace() or c in (0x85, 0x180E, 0x200B, 0x2060)]
    values = ["", None, " ", "\n", "a\n", " a \n b\r\n", *[f"{c}a{c}b{c}" for c in space], *[c for c in space], "   "]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    was = F.regexp_replace(tx.nz(F.col("v")), r"(?U)^\s+|\s+$", "")
    assert [r for r in rows.select("i", tx.strip_space(F.col("v")).alias("now"), was.alias("was")).collect() if r.now != r.was] == []


def postings_of(spark):
    text = "The license of of antion. " + "und der " * 40
    rows = [(i, t, "Acme", "Napoli", u, d, "2026-06-01") for i, (t, u, d) in enumerate([
        ("The thing", "https://it.indeed.com/viewjob?jk=1", text), ("", "https://it.indeed.com/viewjob?jk=2&utm_source=x", "  " + text.upper() + "\n"),
        ("worthless", "", None), ("para", "https://x.example/search?q=a", "anea the " + text), ("x", "", "")])]
    return spark.createDataFrame(rows, "seq int, title string, company string, location string, url string, description string, found_at string")


def test_result_types_and_hashes_of_the_first_pass_are_those_of_a_second(spark):
    once = pj.normalize_posting(postings_of(spark), BOOK, typed=True, hashed=True)
    plain = jn.classify_results(pj.normalize_posting(postings_of(spark), BOOK), BOOK.patterns, BOOK.clean)
    plain = plain.withColumns({"job_id": ident.job_id(plain), "content_hash": ident.content_hash(plain)})
    assert sorted(once.columns) == sorted(plain.columns)
    names = sorted(once.columns)
    assert once.select(names).orderBy("seq").collect() == plain.select(names).orderBy("seq").collect()


def test_annotated_postings_are_hashed_once_and_leave_their_texts(spark):
    rows = views.classified(spark, "/root/testdata/sf0.001")
    known = hs.annotate_history(rows, views.history(spark, "/root/testdata/sf0.001", rows), views.now(), hashed=True)
    assert "sha2(" not in known._jdf.queryExecution().optimizedPlan().toString()
    assert "description" not in views.annotated(spark, "/root/testdata/sf0.001", rows).columns


def test_debug_rows_move_no_texts_and_keep_given_types(spark):
    raw = postings_of(spark).selectExpr("*", "'c' collector", "'unknown' location_fit", "true remote", "0 match_score",
                                        "'real_job' url_result_type", "'given' matched_pattern", "'job' result_type")
    known = raw.where("false").selectExpr("*", "'' history_status")
    out = jn.url_debug_rows(raw, known, known, BOOK.patterns, BOOK.clean)
    assert "description" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.matched_pattern, r.detected_type) for r in out.collect()} == {("given", "real_job")}


def test_terms_within_found_terms_are_told_apart(texts):
    long = tx.LongText(["the", "the the", "of", "of of", "a the the", "xx", "x", "THE"], "d")
    assert long.roots == ["the", "of", "x", "THE"]
    rows = long.add(texts, F.col("d")).select("d", F.col(long.found).alias("found"), F.array(*[
        F.contains(F.lower(tx.nz(F.col("d"))), F.lit(t)) for t in long.terms]).alias("was")).collect()
    assert [r for r in rows if r.found != r.was] == []


def test_a_long_term_is_looked_for_only_where_its_root_is(texts):
    long = tx.LongText(["the", "the the", "a the"], "d")
    plan = long.add(texts, F.col("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(") + plan.lower().count("contains(lambda") <= 3 and "CASE WHEN" in plan and len(long.roots) == 1


def test_a_long_text_is_trimmed_at_its_ends(spark):
    values = ["", None, " ", "a", " a", "a\u2003", "\n\na b\t", "\u3000\u3000", "\u200ba", *[f"{c}a{c}b{c}" for c in tx.SPACES], *tx.SPACES]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    assert [r for r in rows.select(tx.strip_long(F.col("v")).alias("now"), tx.strip_space(F.col("v")).alias("was")).collect() if r.now != r.was] == []


def test_lower_case_is_lowered_by_nothing(spark):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([("x".join(points[i:i + 4096]),) for i in range(0, len(points), 4096)], "v string").select(F.lower("v").alias("low"))
    assert rows.where(F.lower("low") != F.col("low")).count() == 0


def test_the_second_pass_reads_what_the_first_one_found(spark):
    first = pj.normalize_posting(postings_of(spark), BOOK, with_scores=False, typed=True, searched=True)
    plain = pj.normalize_posting(postings_of(spark), BOOK, with_scores=False, typed=True)
    again = pj.rescore(first, BOOK)
    long = pj.long_text(BOOK)
    assert set(again.columns).isdisjoint(long.columns) and {long.ends, long.found} <= set(first.columns) and long.text not in first.columns
    assert pj.rescore(first, BOOK)._jdf.queryExecution().optimizedPlan().toString().count(f"{long.found}_roots") == \
        first._jdf.queryExecution().optimizedPlan().toString().count(f"{long.found}_roots")
    names = sorted(again.columns)
    assert again.select(names).orderBy("seq").collect() == pj.rescore(plain, BOOK).select(names).orderBy("seq").collect()
