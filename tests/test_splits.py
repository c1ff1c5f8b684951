"""Files that are read in many blocks against the standard library."""
import csv
import json
import random

import pytest

from siftworks.sources import files, splits

FIELDS = ["a", 'he said "no"', '""', '"', "line\nbreak", "cr\r\nlf", ",", ", ,\n,", "", " x ", "é日本", "5\" disk", 'q"q', "\n\n", "end\\", "tab\t", '\n"\n,"\n']


@pytest.fixture()
def small_blocks(spark):
    """Blocks of 64 bytes: most records cross some."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "64")
    spark.conf.set(names[1], "8")
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def table(seed, rows=60):
    draw = random.Random(seed)
    return [[str(i)] + [draw.choice(FIELDS) if draw.random() < 0.8 else draw.choice(FIELDS) * draw.randrange(1, 30) for _ in range(3)] for i in range(rows)]


@pytest.mark.parametrize("seed,quoting,ending", [(1, csv.QUOTE_MINIMAL, "\n"), (2, csv.QUOTE_ALL, "\r\n"), (3, csv.QUOTE_MINIMAL, "\r\n")])
def test_csv_over_blocks(spark, small_blocks, tmp_path, seed, quoting, ending):
    want = []
    for part in range(2):
        rows = table(seed + 10 * part)
        with open(tmp_path / f"{part}.csv", "w", encoding="utf-8", newline="") as handle:
            out = csv.writer(handle, quoting=quoting, lineterminator=ending)
            out.writerows([["id", "x", "y", "z"], *rows])
        want += rows
    read = files.read_csv(spark, str(tmp_path), "id string, x string, y string, z string")
    assert splits.pieces(spark, str(tmp_path), "\n").select("_file", "_block").distinct().count() > 20
    assert sorted([["" if v is None else v for v in r] for r in read.collect()]) == sorted(want)


def test_csv_strays_blank_lines_and_long_fields(spark, small_blocks, tmp_path):
    text = '﻿id,x\n1,5" disk\n\n2,"a ""b"" c"\n3,"' + "x" * 220 * 1024 + '"\n4,"open\n\n\n' + "y\n" * 50 + '"\n5,plain'
    (tmp_path / "t.csv").write_text(text, encoding="utf-8")
    got = {r["id"]: r["x"] for r in files.read_csv(spark, str(tmp_path / "t.csv"), "id long, x string").collect()}
    assert got == {1: '5" disk', 2: 'a "b" c', 3: "x" * 220 * 1024, 4: "open\n\n\n" + "y\n" * 50, 5: "plain"}


def test_csv_without_rows(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,x\n")
    for path in (tmp_path, tmp_path / "none.csv", tmp_path / "absent.csv"):
        assert files.read_csv(spark, str(path), "id long, x string").collect() == []
    (tmp_path / "other.csv").write_text("id,y\n1,2\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path / "other.csv"), "id long, x string").collect()


def elements(seed, n):
    draw = random.Random(seed)
    texts = ["a", 'quote " end', "back\\", "br}ace", "{[", "]}", '\\"}', "é日本", "line\nbreak", "", "}" * 5, "\\\\}"]
    return [{"id": i, "t": draw.choice(texts) * draw.randrange(1, 12), "more": {"k": [draw.choice(texts), {"z": draw.choice(texts)}]}} for i in range(n)]


ROW = "struct<id:bigint,t:string,more:struct<k:array<string>>>"


@pytest.mark.parametrize("indent,tail", [(None, ""), (2, "\n"), (None, " \n ")])
def test_json_list_over_blocks(spark, small_blocks, tmp_path, indent, tail):
    rows = elements(indent or 0, 50)
    (tmp_path / "a.json").write_text(json.dumps(rows, ensure_ascii=False, indent=indent) + tail, encoding="utf-8")
    (tmp_path / "b.json").write_text("[]" + tail)
    got = files.read_json_array(spark, str(tmp_path), ROW).collect()
    assert sorted((r["id"], r["t"], r["more"]["k"][0], json.loads(r["more"]["k"][1])) for r in got) == [(r["id"], r["t"], r["more"]["k"][0], r["more"]["k"][1]) for r in rows]


@pytest.mark.parametrize("text", ['{"a": 1}', '"x"', '[{"id": 1}', '[{"id": 1}, {"id": 2', '[{"id": 1}]]', '[{"id": 1}] x', '[{"id": 1', '[1, 2]', '[{"id": "}]', "["])
def test_json_list_errors(spark, small_blocks, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="JSON list|something else"):
        files.read_json_array(spark, str(tmp_path / "a.json"), ROW).collect()


@pytest.mark.parametrize("indent,tail", [(None, ""), (1, "\n")])
def test_history_and_statistics(spark, small_blocks, tmp_path, indent, tail):
    records = {f"k{i}": {"job_id": f"j{i % 30}", "title": f'b}} "{i}"', "sent_count": i} for i in range(40)}
    for name, value in (("m", records), ("n", [{"job_id": "j1", "title": "of the list"}, {"title": "no id"}])):
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=indent) + tail)
    want = {r["job_id"]: r["title"] for r in records.values()} | {"j1": "of the list"}
    assert {r["job_id"]: r["title"] for r in files.read_history(spark, str(tmp_path)).collect()} == want

    stats = {"rows": 12, "by": {"a": 1, "b": {"c": "}"}}, "note": "x", "none": None}
    (tmp_path / "stats.json").write_text(json.dumps(stats, indent=indent) + tail)
    got = {r["name"]: r["value"] for r in files.read_run_stats(spark, str(tmp_path / "stats.json")).collect()}
    assert got["rows"] == "12" and json.loads(got["by"]) == stats["by"] and got["note"] == "x" and got["none"] is None
    assert files.read_run_stats(spark, str(tmp_path / "absent.json")).collect() == []
    assert files.read_history(spark, str(tmp_path / "absent.json")).collect() == []


def test_sent_keys(spark, small_blocks, tmp_path):
    from pyspark.sql import functions as F
    (tmp_path / "a.json").write_text(json.dumps({"k1": "2026-01-05", "k2": {"sent_at": "2026-01-06", "content_hash": "h}"}, "k3": "2026-01-07", "k4": "2020-01-01"}))
    (tmp_path / "b.json").write_text('{"k5": "2026-01-05", ')
    got = {r["key"]: (str(r["sent_at"]), r["content_hash"]) for r in files.read_sent_keys(spark, str(tmp_path), F.lit("2026-01-08").cast("timestamp"), 30).collect()}
    assert got == {"k1": ("2026-01-05", ""), "k2": ("2026-01-06", "h}"), "k3": ("2026-01-07", "")}
