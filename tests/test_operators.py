"""Order-dependent and stateful operators against plain loops on small fixtures."""

import os
import random

import pytest
from pyspark.sql import functions as F

from siftworks.functions import identity as ident
from siftworks.operators import dedup, filters as fl, history as hs, selection as sel, sets
from siftworks.operators.skew import salted_left_join
from siftworks.session import scratch_path
from siftworks.sources import files



def now():
    return F.lit("2026-07-01 12:00:00").cast("timestamp")


SORT = ("match_score", "student_score", "candidate_score", "score")


def random_jobs(seed, n=120):
    rnd = random.Random(seed)
    return [{
        "seq": i, "title": f"t{i}", "url": f"https://e.com/{rnd.randrange(n // 2)}",
        "history_status": rnd.choice(["NEW", "UPDATED", "SEEN", "RESURFACED"]), "sent_count": rnd.randrange(2),
        "last_sent": rnd.choice(["", "2026-06-01T00:00:00Z"]), "rotation_eligible": rnd.random() < .5,
        "location_fit": rnd.choice(["remote", "allowed_local", "unknown", "excluded_far"]), "remote": rnd.random() < .4,
        "negative_reason": rnd.choice(["", "", "", "-40 country: x"]), "category": rnd.choice(["hotel", "cleaning", "data_entry", "other"]),
        "priority_bucket": "", "selection_reason": "", **{k: rnd.randrange(30, 100) for k in SORT},
    } for i in range(n)]


def order(j):
    return ({"NEW": 0, "UPDATED": 1, "RESURFACED": 2, "SEEN": 3}[j["history_status"]], *[-j[k] for k in SORT], j["seq"])


def select_loop(jobs, target, repeat, seen, fallback):
    """Fill buckets one after the other."""
    ok = lambda j: j["match_score"] >= 50 and not (j["location_fit"] == "excluded_far" or (j["location_fit"] == "unknown" and not j["remote"])) and "country" not in j["negative_reason"]
    fresh = lambda j: j["sent_count"] == 0 or not j["last_sent"]
    buckets = [("NEW", [j for j in jobs if j["history_status"] == "NEW"]), ("UPDATED", [j for j in jobs if j["history_status"] == "UPDATED"]),
               ("NEVER_SENT_FILL", [j for j in jobs if fresh(j) and j["history_status"] in ("SEEN", "RESURFACED")]),
               ("RESURFACED", [j for j in jobs if j["history_status"] == "RESURFACED"])]
    if seen:
        buckets.append(("SEEN", [j for j in jobs if j["history_status"] == "SEEN"][:repeat]))
    if fallback:
        buckets.append(("FALLBACK_ROTATION", [j for j in jobs if j["rotation_eligible"] and not fresh(j) and j["history_status"] in ("SEEN", "RESURFACED")]))
    out, keys = [], set()
    for name, rows in buckets:
        for j in sorted(filter(ok, rows), key=order):
            if len(out) < target and j["url"] not in keys:
                keys.add(j["url"])
                out.append((j["seq"], name))
    return out


@pytest.mark.parametrize("seed, seen, fallback", [(1, False, False), (2, True, True)])
def test_bucketed_selection(spark, seed, seen, fallback):
    jobs = random_jobs(seed)
    df = spark.createDataFrame(jobs).repartition(5)
    got = sel.select_by_buckets(df, target=25, include_seen=seen, repeat=4, fallback=fallback)
    assert sorted((r.seq, r.selection_reason) for r in got.collect()) == sorted(select_loop(jobs, 25, 4, seen, fallback))
    marked = sel.write_back_selection(df, got, include_seen=seen).collect()
    keys = {r.url for r in got.collect()}
    assert all((r.selection_rejection_reason == "selected") == (r.url in keys) for r in marked) and len(marked) == len(jobs)


@pytest.mark.parametrize("seed, top", [(3, 30), (4, 9)])
def test_quota_selection(spark, seed, top):
    jobs, quotas = random_jobs(seed), {"remote": 5, "data_office": 4, "hospitality": 4, "cleaning": 3, "maintenance": 2}
    tests = {"remote": lambda j: j["remote"], "data_office": lambda j: j["category"] == "data_entry", "hospitality": lambda j: j["category"] == "hotel",
             "cleaning": lambda j: j["category"] == "cleaning", "maintenance": lambda j: False}
    chosen, keys = [], set()
    for rows, quota in [([j for j in jobs if t(j) and j["location_fit"] != "excluded_far"], quotas[n]) for n, t in tests.items()] + [(jobs, top)]:
        for j in sorted(rows, key=order):
            if len(chosen) < top and quota > 0 and j["url"] not in keys:
                chosen.append(j["seq"])
                keys.add(j["url"])
                quota -= 1
    for parts, one_task in ((1, sel.ONE_TASK), (7, sel.ONE_TASK), (7, 0)):
        got = sel.quota_top(spark.createDataFrame(jobs).repartition(parts), top, quotas, one_task=one_task)
        assert sorted(r.seq for r in got.collect()) == sorted(chosen)


@pytest.mark.parametrize("seed", [5, 6])
def test_greedy_dedup(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["", f"u{rnd.randrange(12)}"]), f"t{rnd.randrange(9)}", f"a{rnd.randrange(3)}", f"s{rnd.randrange(3)}") for i in range(80)]
    kept, taken = [], set()
    for i, url, title, author, sub in rows:
        keys = {k for k in (url, f"{title}|{author}", f"{title}|{sub}") if k}
        if not keys & taken:
            kept.append(i)
            taken |= keys
    df = spark.createDataFrame(rows, "seq int, url string, title string, author string, subreddit string").repartition(6)
    assert sorted(r.seq for r in dedup.dedup_greedy(df, dedup.post_keys(df)).collect()) == kept


def test_salted_join_with_hot_key(spark):
    left = spark.range(3000).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)], "k string, v int")
    for how in ("left", "left_semi", "left_anti"):
        plain = left.join(right, "k", how).select(*(["seq", "k", "v"] if how == "left" else ["seq", "k"]))
        salted = salted_left_join(left, right, "k", "seq", how, salts=8, min_rows=500).select(*plain.columns)
        assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select(F.col("id").alias("seq"), (F.col("id") % 2).alias("k"))
    plan = dedup.keep_first(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert dedup.flag_duplicates(df, F.col("k")).filter("not duplicate").count() == 2


def test_dedup_is_idempotent_and_partition_free(spark):
    rows = [(i, f"HTTPS://e.com/{i % 7}/?utm_source={i}", f"t{i}", "", "") for i in range(50)] + [(100, "", "X ", "c", "l"), (101, "", "x", "C", "L")]
    df = spark.createDataFrame(rows, "seq int, url string, title string, company string, location string")
    once = dedup.dedup_postings(df.repartition(9))
    assert sorted(r.seq for r in once.collect()) == [0, 1, 2, 3, 4, 5, 6, 100]
    assert sorted(r.seq for r in dedup.dedup_postings(once).collect()) == sorted(r.seq for r in dedup.dedup_postings(df.coalesce(1)).collect())


def history_of(df, last_sent, digest=None, count=1):
    return df.select(ident.job_id(df).alias("job_id"), "url", "title", F.lit("s").alias("source"), F.lit("2026-01-01T00:00:00Z").alias("first_seen"),
                     F.lit(last_sent).alias("last_seen"), F.lit(last_sent).alias("last_sent"), F.lit(count).alias("sent_count"),
                     (ident.content_hash(df) if digest is None else F.lit(digest)).alias("content_hash"), F.lit(70).alias("match_score"))


@pytest.mark.parametrize("last_sent, digest, status, days", [
    ("2026-06-24T12:00:00Z", None, "RESURFACED", 7), ("2026-06-24T12:00:01Z", None, "SEEN", 6), ("2026-06-30T00:00:00Z", "other", "UPDATED", 1), ("", None, "SEEN", None)])
def test_history_status(spark, last_sent, digest, status, days):
    df = spark.createDataFrame([(1, "https://e.com/1", "T", "2026-06-01T00:00:00Z"), (2, "https://e.com/2", "U", "2026-06-01T00:00:00Z")], "seq int, url string, title string, found_at string")
    rows = hs.annotate_history(df, history_of(df.filter("seq = 1"), last_sent, digest), now()).orderBy("seq").collect()
    assert (rows[0].history_status, rows[0].days_since_last_sent, rows[0].first_seen) == (status, days, "2026-01-01T00:00:00Z")
    assert (rows[1].history_status, rows[1].sent_count, rows[1].first_seen) == ("NEW", 0, "2026-06-01T00:00:00Z")


def test_upsert_and_snapshot(spark):
    df = spark.createDataFrame([(1, "https://e.com/1", "T"), (2, "https://e.com/2", "U")], "seq int, url string, title string")
    sent = df.withColumn("job_id", ident.job_id(df)).withColumn("content_hash", ident.content_hash(df)).withColumn("match_score", F.lit(88))
    out = hs.upsert_history(history_of(df.filter("seq = 1"), "2026-06-01T00:00:00Z"), sent, now())
    rows = {r.title: (r.sent_count, r.first_seen, r.last_sent, r.match_score) for r in out.collect()}
    assert rows["T"] == (2, "2026-01-01T00:00:00Z", "2026-07-01T12:00:00Z", 88) and rows["U"][:2] == (1, "2026-07-01T12:00:00Z")
    path = scratch_path(spark, "test-history")
    files.write_history(out, path)
    assert spark.read.parquet(path).count() == 2


def test_history_files(spark, tmp_path):
    (tmp_path / "h.json").write_text('[{"job_id": "a", "title": "old"}, {"title": "none"}, {"job_id": "a", "title": "new"}]')
    assert [(r.job_id, r.title) for r in files.read_history(spark, str(tmp_path / "h.json")).collect()] == [("a", "new")]
    assert files.read_history(spark, str(tmp_path / "absent.json")).count() == 0
    (tmp_path / "s.json").write_text('{"k1": {"sent_at": "2026-04-02", "content_hash": "x"}, "k2": "2026-04-01", "k3": "2026-06-30", "k4": "never"}')
    rows = files.read_sent_keys(spark, str(tmp_path / "s.json"), now(), 90).collect()
    assert sorted((r.key, str(r.sent_at), r.content_hash) for r in rows) == [("k1", "2026-04-02", "x"), ("k3", "2026-06-30", "")]
    (tmp_path / "bad.json").write_text("{nope")
    assert files.read_sent_keys(spark, str(tmp_path / "bad.json"), now(), 90).count() == 0


def test_csv_edges(spark, tmp_path):
    schema = "title string, description string"
    assert files.read_csv(spark, str(tmp_path / "absent.csv"), schema).count() == 0
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text("title,description\n")
    big = "x" * 220 * 1024
    (tmp_path / "big.csv").write_text(f'title,description\n"a ""q"", b","{big}\n2nd"\n')
    assert files.read_csv(spark, str(tmp_path / "empty.csv"), schema).count() == 0
    assert files.read_csv(spark, str(tmp_path / "head.csv"), schema).count() == 0
    row = files.read_csv(spark, str(tmp_path / "big.csv"), schema).first()
    assert row.title == 'a "q", b' and row.description == big + "\n2nd"


def test_json_array_shape(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    assert files.read_json_array(spark, str(tmp_path / "a.json"), "a int").count() == 2
    assert files.read_json_array(spark, str(tmp_path / "none.json"), "a int").count() == 0
    (tmp_path / "o.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="expected a JSON list"):
        files.read_json_array(spark, str(tmp_path / "o.json"), "a int").collect()


def test_sets_and_filters(spark):
    first = spark.createDataFrame([("s1", 1)], "site string, n int")
    other = spark.createDataFrame([("s1", 9), ("s2", 5)], "site string, n int")
    assert sorted(map(tuple, sets.union_else_fallback(first, other, "site").collect())) == [("s1", 1), ("s2", 5)]
    jobs = spark.createDataFrame([(1, "x"), (2, "Selected")], "seq int, selection_rejection_reason string")
    assert [r.seq for r in fl.selected_or_all(jobs).collect()] == [2]
    assert fl.selected_or_all(jobs.filter("seq = 1")).count() == 1
    seen = spark.createDataFrame([(i, "SEEN" if i % 2 else "NEW") for i in range(6)], "seq int, history_status string")
    assert sorted(r.seq for r in sel.repeat_filter(seen, True, 2).collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.seq for r in sel.repeat_filter(seen).collect()) == [0, 2, 4]


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")
@pytest.mark.parametrize("key", ["url_canonical", "weighted_keyword_score", "dedup_url_or_identity", "community_score", "score_report", "html_link_extract"])
def test_registered_queries_match_sql(spark, key):
    import __spark_entry__  # noqa: F401
    from checks.compare import check, connect
    ok, note = check(spark, connect(FOLDER), FOLDER, key)
    assert ok, note
