"""The bucketed history against the plain upsert: the same rows, no exchange of the history, untouched parts as they were."""
import os

from pyspark.sql import functions as F

from siftworks.operators import history as hs
from siftworks.session import scratch_path
from siftworks.sources.history_table import HistoryTable

STAMP = "2026-06-01T00:00:00Z"


def now():
    return F.lit("2026-07-01T12:00:00Z").cast("timestamp")


def records(spark, n):
    job = F.concat(F.lit("job"), "id")
    return spark.range(n).select(job.alias("job_id"), F.concat(F.lit("https://e.com/"), "id").alias("url"), F.lit("t").alias("title"), F.lit("s").alias("source"),
                                 F.lit(STAMP).alias("first_seen"), F.lit(STAMP).alias("last_seen"), F.lit(STAMP).alias("last_sent"), F.lit(1).alias("sent_count"),
                                 F.lit("old").alias("content_hash"), F.lit(70).alias("match_score"))


def batch(spark, ids):
    rows = [(i, f"job{k}", f"https://e.com/{k}", f"title {i}", "s", STAMP, "new", 90) for i, k in enumerate(ids)]
    return spark.createDataFrame(rows, "seq int, job_id string, url string, title string, source string, found_at string, content_hash string, match_score int")


def files(path):
    return {os.path.join(folder, name) for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


def rows(df):
    return sorted(map(tuple, df.select(*hs.HISTORY_FIELDS).collect()), key=repr)


def test_upsert_rewrites_touched_parts_only(spark):
    path = scratch_path(spark, "history-table")
    before = records(spark, 500)
    table = HistoryTable.create(spark, "history_upsert_test", path, before, parts=8, buckets=2)
    assert rows(table.read()) == rows(before)
    local = path.removeprefix("file:")
    old = files(f"{local}/records")
    sent = batch(spark, [3, 7, 900, 7])
    expected = rows(hs.upsert_history(before, sent, now()))
    touched = table.upsert(sent, now())
    assert rows(table.read()) == expected and 1 <= len(touched) <= 3
    assert [r.sent_count for r in table.read().where("job_id in ('job3', 'job7', 'job900')").orderBy("job_id").collect()] == [2, 3, 1]
    new = files(f"{local}/records")
    inside = lambda name: any(f"/part={p}/" in name for p in touched)
    assert {f for f in old if not inside(f)} == {f for f in new if not inside(f)}
    assert not {f for f in old if inside(f)} & new

    # Another session would know the path alone.
    spark.sql("DROP TABLE history_upsert_test")
    again = HistoryTable.open(spark, "history_upsert_test", path)
    assert (again.parts, again.buckets) == (8, 2) and rows(again.read()) == expected
    assert again.upsert(sent.limit(0), now()) == [] and rows(again.read()) == expected
    one = sent.where("seq = 0")
    some = rows(again.read(one))
    part = spark.createDataFrame([(r[0],) for r in expected], "job_id string").withColumn("part", again.part()).where(F.col("part").isin(again.touched(one)))
    inside = {r.job_id for r in part.collect()}
    assert "job3" in inside and some == [r for r in expected if r[0] in inside]


def exchanged_scans(df):
    """Number of exchanges in the plan that lie above the scan of the history."""
    plan, depth, found = df._jdf.queryExecution().executedPlan().toString().splitlines(), [], 0
    for line in plan:
        level = len(line) - len(line.lstrip(" :+-*()0123456789"))
        depth = [d for d in depth if d[0] < level]
        depth.append((level, "Exchange" in line))
        if "FileScan" in line and "history_plan_test" in line:
            found += sum(flag for _, flag in depth)
    return found


def test_history_is_not_shuffled(spark):
    table = HistoryTable.create(spark, "history_plan_test", scratch_path(spark, "history-table"), records(spark, 300), parts=4, buckets=16)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = batch(spark, [1, 2, 3])
        known = hs.annotate_history(sent, table.read(), now())
        text = known._jdf.queryExecution().executedPlan().toString()
        assert "history_plan_test" in text and "SelectedBucketsCount" in text and exchanged_scans(known) == 0
        fresh = hs.sent_records(sent, now())
        after = table.after(fresh, table.touched(fresh))
        assert exchanged_scans(after) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_several_records_of_a_job(spark):
    twice = records(spark, 2).unionByName(records(spark, 1).withColumn("last_sent", F.lit("2026-06-20T00:00:00Z")).withColumn("sent_count", F.lit(5)))
    df = spark.createDataFrame([(1, "https://e.com/1", "T"), (2, "https://e.com/2", "U")], "seq int, url string, title string")
    from siftworks.functions import identity as ident
    own = df.select(ident.job_id(df).alias("job_id"), "seq").where("seq = 1").first().job_id
    twice = twice.withColumn("job_id", F.when(F.col("job_id") == "job0", own).otherwise(F.col("job_id")))
    got = hs.annotate_history(df, twice, now()).orderBy("seq").collect()
    assert [(r.seq, r.sent_count, r.last_sent) for r in got] == [(1, 5, "2026-06-20T00:00:00Z"), (2, 0, "")]
    table = HistoryTable.create(spark, "history_twice_test", scratch_path(spark, "history-table"), twice, parts=2, buckets=2)
    assert table.read().count() == 2
