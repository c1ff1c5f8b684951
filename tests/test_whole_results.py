"""Operators against the standard library and against plain loops, beyond the data of the registered queries."""
import html
import random
import re
from pathlib import Path
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from siftworks.functions import text as tx, urls
from siftworks.operators import dedup, projections, selection, sets
from siftworks.session import scratch_path
from siftworks.sources import files


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


REFERENCES = [
    "Z&uuml;rich &ntilde; &ccedil; &ecirc;", "&trade;&times;", "&#38;amp;", "&#128; &#x80; &#129;", "&amp;lt;", "&copy 2020 &copyright; &notin; &notit;", "&unknown; &", "a&b&c",
    "&#x1F600; &#0; &#xD800; &#1114112; &#99999999999;", "&#11;x&#1;", "no reference", "", "&amp;&amp;&amp;", "&#65 &#x41g", "&lt&gt;", "&AMP; &NotEqualTilde;", "x" * 20 + "&eacute" * 50, "&ffff", "&#xFDD0;"]


def test_unescape_is_that_of_the_standard_library(spark):
    assert column(spark, REFERENCES, tx.unescape) == [html.unescape(r) for r in REFERENCES]
    assert column(spark, [None], tx.unescape) == [""]


def test_resolve_is_that_of_the_standard_library(spark):
    links = ["g", "./g", "g/", "/g", "?y", "g?y", "#s", "g#s", "g?y#s", "", ".", "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "../../../../g", "/./g", "/../g",
             "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "../" * 6 + "x", "g?y/./x", "g#s/../x", "http://o.com/a/../b", "//o.com/x", "mailto:x@y"]
    for base in ("http://a/b/c/d;p", "https://e.com/a", "https://e.com", "https://e.com/a/b/c/", "https://e.com/a/b?q=/x/y"):
        got = column(spark, links, lambda v: urls.resolve(F.lit(base), v))
        assert dict(zip(links, got)) == {link: urljoin(base, link) for link in links}


def test_title_without_query(spark):
    title = lambda v: tx.title_from_url(v, cut_underscore=False, otherwise="Talent job", drop_query=True)
    assert column(spark, ["https://it.talent.com/view?id=123", "https://it.talent.com/a-b/"], title) == ["view", "a b"]


def test_no_collector_delivered(spark):
    assert sets.union_collectors({"a": None}).collect() == []


def test_last_record_of_several_texts(spark):
    texts = [("b", '[{"job_id": "1", "title": "third"}]'), ("a", '[{"job_id": "1", "title": "first"}, {"job_id": "1", "title": "second"}, {"job_id": "2", "title": "x"}]')]
    raw = spark.createDataFrame(texts, "file string, value string").repartition(2)
    assert {r["job_id"]: r["title"] for r in files.history_rows(raw, order="file").collect()} == {"1": "third", "2": "x"}


def test_details_do_not_multiply_rows(spark):
    listing = spark.createDataFrame([(i, "u" if i < 2 else "", "old", "", "") for i in range(50)], "seq long, url string, description string, location string, company string")
    detail = spark.createDataFrame([("u", "new b"), ("u", "new a"), ("", "wrong")], "url string, description string")
    got = {r["seq"]: r["description"] for r in projections.merge_details(listing, detail).collect()}
    assert len(got) == 50 and got[0] == got[1] == "new a" and {v for k, v in got.items() if k > 1} == {"old"}


def test_rank_of_all_rows(spark):
    df = spark.range(1000).select("id", F.pmod(F.col("id") * 7919, F.lit(101)).alias("score")).repartition(7)
    got = {r["id"]: r["rank"] for r in selection.rank_all(df, [F.col("score").desc(), F.col("id")], ["id"]).collect()}
    order = sorted(range(1000), key=lambda i: (-(i * 7919 % 101), i))
    assert got == {i: place + 1 for place, i in enumerate(order)}


def test_long_conflict_chain(spark):
    rows = [(i, [f"k{i}", f"k{i + 1}"]) for i in range(50)] + [(100, ["alone"]), (101, [])]
    df = spark.createDataFrame(rows, "seq long, keys array<string>").repartition(3)
    taken, kept = set(), []
    for seq, keys in rows:
        if not taken & set(keys):
            kept.append(seq)
            taken |= set(keys)
    for at_once in (100_000, 7):
        assert sorted(r["seq"] for r in dedup.dedup_greedy(df, F.col("keys"), at_once=at_once).collect()) == kept


def steps_of(monkeypatch):
    """Count the steps of the greedy dedup: one folder of winners each."""
    folders = []
    monkeypatch.setattr(dedup, "scratch_path", lambda spark, label: folders.append(scratch_path(spark, label)) or folders[-1])
    return lambda: len(list(Path(folders[-1].removeprefix("file:")).glob("_step=*")))


def test_chain_of_ten_thousand_rows_takes_few_steps(spark, monkeypatch):
    steps = steps_of(monkeypatch)
    df = spark.range(10_000).select(F.col("id").alias("seq"), F.array(F.concat(F.lit("k"), F.col("id")), F.concat(F.lit("k"), F.col("id") + 1)).alias("keys"))
    for at_once, most in ((100_000, 1), (4000, 5)):
        kept = dedup.dedup_greedy(df, F.col("keys"), at_once=at_once)
        assert [r["seq"] for r in kept.orderBy("seq").collect()] == list(range(0, 10_000, 2))
        assert steps() <= most


@pytest.mark.parametrize("seed", range(3))
def test_greedy_dedup_in_both_kinds_of_steps(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([None, [], [f"k{rnd.randrange(40)}" for _ in range(rnd.randrange(1, 4))]])) for i in rnd.sample(range(1000), 120)]
    taken, kept = set(), []
    for seq, keys in sorted(rows, key=lambda r: r[0]):
        if not taken & set(keys or []):
            kept.append(seq)
            taken |= set(keys or [])
    df = spark.createDataFrame(rows, "seq int, keys array<string>").repartition(5)
    for at_once in (5, 40):
        got = dedup.dedup_greedy(df, F.col("keys"), at_once=at_once)
        assert got.schema == df.schema and sorted(r["seq"] for r in got.collect()) == kept
    assert dedup.dedup_greedy(df.limit(0), F.col("keys")).count() == 0


def scored(spark, n, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["", "NEW", "SEEN", "UPDATED", None]), rnd.choice(["NEW", "SEEN"]), rnd.randrange(4), rnd.choice([1, 2, None]), f"text {i}") for i in range(n)]
    return spark.createDataFrame(rows, "seq int, selection_reason string, history_status string, match_score int, score int, description string").repartition(7)


@pytest.fixture
def many_ranges(spark):
    """Keep the ranges of small tables apart, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("top", [0, 1, 150, 300, 1000])
def test_top_rows_by_ranges_are_those_of_a_sort(spark, many_ranges, top):
    df = scored(spark, 300, top)
    for order in (selection.report_order, selection.status_order, selection.pool_order):
        plain = [(r["seq"], i + 1, r["description"]) for i, r in enumerate(df.orderBy(*order(df)).limit(top).collect())]
        for one_task in (selection.ONE_TASK, 0):
            got = selection.rank_top(df, order, top, one_task=one_task)
            assert sorted(((r["seq"], r["rank"], r["description"]) for r in got.collect()), key=lambda r: r[1]) == plain


def test_only_the_edge_of_a_large_top_is_ordered(spark, many_ranges):
    df = spark.range(40_000).select(F.col("id").alias("seq"), (F.col("id") * 7919 % 1009).cast("int").alias("score"))
    first = selection.first_rows(df, selection.pool_order, 25_000, ["seq", "score"], one_task=1000)
    plan = first._jdf.queryExecution().executedPlan().toString()
    limit = int(re.search(r"TakeOrderedAndProject\(limit=(\d+)", plan)[1])
    assert limit < 10_000 and "Sort [" not in plan
    assert {r["seq"] for r in first.collect()} == {r["seq"] for r in df.orderBy(*selection.pool_order(df)).limit(25_000).collect()}


def test_texts_stay_out_of_ranking_shuffles(spark):
    names = "seq long, url string, title string, source string, company string, location string, description string, match_score int, history_status string, location_fit string, remote boolean"
    df = spark.createDataFrame([(1, "u", "t", "s", "c", "l", "long text", 80, "NEW", "remote", True)], names)
    for ranked in (selection.select_by_buckets(df), dedup.dedup_two_stage(df)):
        plan = ranked._jdf.queryExecution().optimizedPlan().toString()
        nodes = [line.strip(" :+-") for line in plan.splitlines()]
        ranking = [i for i, node in enumerate(nodes) if node.startswith("Window ")]
        assert ranking and all("description" not in nodes[i] for i in ranking)
        # What the lowest ranking reads is a projection without the text.
        assert next(node for node in nodes[ranking[-1] + 1:] if node.startswith("Project")).count("description") == 0
