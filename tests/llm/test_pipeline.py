import corpus_pipeline as cp
from siftworks.llm.common import table
from siftworks.llm.decontaminate import edit_matches
from siftworks.llm.queries import QUERIES
from siftworks.llm.secret_scan import secret_scan
from tests.llm.test_ngram_join import brute

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SMALL)
        if name == "token_ids":
            assert out.columns == [*columns, "ids", "n_tokens", "round_trip"] and out.count() == docs.count()
            break
        assert out.columns == columns
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        kept = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "near_duplicates":
            classes = brute(list(rows.items()), cp.NEAR_WORDS, cp.NEAR_PERCENT)
            assert set(kept) == {d for d in rows if classes[d][1] == d}
        if name == "benchmark_leaks":
            assert set(rows) - set(kept) == {r["doc_id"] for r in edit_matches(docs, table(spark, SMALL, "benchmark")).collect()}
        if name == "secrets":
            assert set(kept) == set(rows) and not secret_scan(out).where("n_access + n_hex > 0").count()
        docs = spark.createDataFrame([tuple(r) for r in out.collect()], out.schema)


def test_run_and_odd_rows(spark, tmp_path):
    source = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "same few words " * 30, "en", "s", 5), (3, "same few words " * 30, "en", "s", 5),
                                    (4, " ".join(f"w{i}" for i in range(40)), "en", "s", 9), (4, " ".join(f"w{i}" for i in range(40)), "en", "s", 9)],
                                   "doc_id long, text string, lang string, source string, n_chars long")
    source.write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SMALL, "labels").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    table(spark, SMALL, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r["doc_id"] for r in cp.run(spark, str(tmp_path)).collect()] == [4]


def test_queries_are_complete():
    assert sorted(k.split("_")[0] for k in QUERIES) == sorted(f"op{n}" for n in range(1, 14))


def test_sql_of_the_queries(spark, monkeypatch):
    from checks import compare, registry
    from siftworks.llm.queries import SQL
    connection = compare.connect(SMALL)
    for key, sql in SQL.items():
        monkeypatch.setitem(registry.QUERIES, key, QUERIES[key])
        monkeypatch.setitem(registry.SQL, key, sql)
        ok, note = compare.check(spark, connection, SMALL, key)
        assert ok, note
