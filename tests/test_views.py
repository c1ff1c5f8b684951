from checks.queries_state import annotated

SMALL = "/root/testdata/sf0.001"


def test_each_query_reads_the_given_tables(spark, tmp_path):
    for name, share in (("documents", "doc_id % 2 = 0"), ("labels", "true")):
        spark.read.parquet(f"{SMALL}/{name}.parquet").where(share).write.parquet(f"{tmp_path}/{name}.parquet")
    before = {r["seq"] for r in annotated(spark, str(tmp_path)).collect()}
    spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id % 2 = 1").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    after = {r["seq"] for r in annotated(spark, str(tmp_path)).collect()}
    assert before and after and not before & after
