"""Costs that once grew beyond the work: texts are searched once, and by cheap patterns."""

import time

from pyspark.sql import functions as F

from checks import queries_state, views
from siftworks.functions import text as tx
from siftworks.operators import joins as jn, selection as sel

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_profile_text_is_the_runs_of_its_letters(spark):
    values = ["", None, " ", "Á-É è", "àèéìòù ÀÈÉÌÒÙ", "a--b\n\tC😀d", "…x…", "5+ anni (full-time)!", "ı İ ß Ω"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    was = F.trim(F.regexp_replace(F.lower(tx.nz(F.col("v"))), "[^a-z0-9àèéìòù]+", " "))
    assert [r for r in rows.select(tx.profile_text(F.col("v")).alias("now"), was.alias("was")).collect() if r.now != r.was] == []


def test_profile_text_costs_about_as_much_as_other_patterns(spark):
    rows = spark.range(4000, numPartitions=4).select(F.repeat(F.concat(F.lit("the antion of thing "), F.col("id").cast("string"), F.lit(", und der. ")), 60).alias("v")).cache()
    rows.count()

    def seconds(value):
        best = []
        for _ in range(3):
            start = time.perf_counter()
            rows.agg(F.sum(F.length(value))).collect()
            best.append(time.perf_counter() - start)
        return min(best)

    assert seconds(tx.profile_text(F.col("v"))) < 5 * seconds(tx.squeeze(F.lower(F.col("v"))))
    rows.unpersist()


def test_a_pool_labels_its_postings_once(spark):
    for frame in (queries_state.pool(spark, SMALL), queries_state.health(spark, SMALL)[1]):
        assert "_settle_part_time" not in plan_of(frame)


def test_debug_rows_read_the_classified_rows_once(spark):
    labelled = views.classified(spark, SMALL)
    rows = views.annotated(spark, SMALL, labelled)
    raw = labelled.drop("url_result_type", "matched_pattern", "result_type")
    plan = plan_of(jn.url_debug_rows(raw, rows, sel.select_by_buckets(rows), queries_state.BOOK.patterns, queries_state.BOOK.clean).select("seq", "rejection_reason"))
    assert "_settle_result_type" not in plan


def test_the_history_view_labels_only_what_was_sent(spark):
    import re
    plan = views.history(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    semi = next(i for i, line in enumerate(lines) if "Join LeftSemi" in line)
    assert any(re.search("Generate inline", line) for line in lines[:semi]) and not any("Generate inline" in line for line in lines[semi:])


def test_postings_of_one_row_group_are_labelled_by_many_tasks(spark, tmp_path):
    noise = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: F.sha2(F.concat_ws("-", "id", i), 512)))
    rows = spark.range(2000, numPartitions=1).select(
        F.col("id").alias("doc_id"), noise.alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), (F.col("id") % 997).alias("n_chars"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    labelled = views.normalized(spark, str(tmp_path)).select("seq", "match_score", F.spark_partition_id().alias("task"))
    sizes = [r["n"] for r in labelled.groupBy("task").agg(F.count("match_score").alias("n")).collect()]
    assert sum(sizes) == 2000 and len(sizes) > 1 and max(sizes) < 1500


def test_numbering_and_cutting_by_ranges_compute_their_rows_once(spark):
    for ranked in (lambda df: sel.rank_all(df, sel.pool_order(df), ["seq", "match_score"]).selectExpr("seq"),
                   lambda df: sel.first_rows(df, sel.pool_order, 100, ["seq", "match_score"], one_task=10).selectExpr("seq")):
        calls = spark.sparkContext.accumulator(0)

        def counted(value):
            calls.add(1)
            return value % 7

        rows = spark.range(500, numPartitions=4).select(F.col("id").alias("seq"), F.udf(counted, "long")("id").alias("match_score"))
        ranked(rows).collect()
        assert calls.value == 500
