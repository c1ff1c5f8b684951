import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftworks.llm import blocks, suffix_repeats as sr
from siftworks.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, body string, block int"


def brute(texts, length=200):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    draw = random.Random(seed)
    words = ["ab", "née", "ç", "tree", "of", "xyz", "日本"]

    def prose(n):
        return " ".join(draw.choice(words) + str(draw.randrange(10 ** 6)) for _ in range(n))

    passages = [prose(n) for n in (20, 21, 22, 24, 30, 60, 200)]
    texts = [None, "", "short", " " * 199, " " * 200, "a" * 201, "ab" * 400, "x" * 5000, prose(30), prose(400)]
    # Strings shared over exactly 199, 200, 201, 255, 256 and 257 bytes, at every phase of the cover.
    exact = "".join(draw.choice("qwertzuiop") for _ in range(400))
    texts += [prose(draw.randrange(3)) + "|" * draw.randrange(1, 60) + exact[k:k + n] + "#" + prose(2) for n in (199, 200, 201, 255, 256, 257) for k in (0, 31, 90)]
    for _ in range(40):
        parts = [draw.choice(passages) if draw.random() < 0.5 else prose(draw.randrange(40)) for _ in range(draw.randrange(1, 6))]
        texts.append(draw.choice(["", " ", "\n\n"]).join(parts))
    texts += [texts[-1]] * 3 + [texts[-2][5:], "Z" + texts[-3]]
    near = prose(300)
    texts += [near[:k] + "!" + near[k + 1:] for k in (0, 100, 199, 200, 201, 1000, 1400)]
    return texts


def run(spark, texts, length=200):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r for r in sr.remove_repeats(docs.repartition(3), length, rows=True).collect()}


def test_cover():
    assert {(a - b) % sr.PERIOD for a in sr.COVER for b in sr.COVER} == set(range(sr.PERIOD))


@pytest.mark.parametrize("seed,length", [(1, 200), (2, 200), (3, 57), (4, 90)])
def test_brute_force(spark, seed, length, monkeypatch):
    texts = corpus(seed)
    got = run(spark, texts, length)
    want = brute([(t or "").encode() for t in texts], length)
    for i, expected in enumerate(want):
        r = got[i]
        assert (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), r["kept_sha256"]) == expected, i
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]


def test_small_blocks(spark, monkeypatch):
    """Blocks of one or two documents, so that every repeat crosses blocks."""
    texts = corpus(7)
    whole = sr.text_blocks
    monkeypatch.setattr(sr, "text_blocks", lambda docs, label: whole(docs, label, 500))
    got = run(spark, texts)
    for i, expected in enumerate(brute([(t or "").encode() for t in texts])):
        assert (got[i]["n_bytes"], sum(s["end"] - s["start"] for s in got[i]["spans"]), len(got[i]["spans"]), got[i]["kept_sha256"]) == expected


def test_defined_cases(spark):
    long = "the same long line of text " * 20
    docs = spark.createDataFrame([(None, long, "", 0), (5, long, "", 0), (5, long, "", 0), (2 ** 60 + 1, "other", "", 0)], SCHEMA).coalesce(1)
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["kept_sha256"]) for r in sr.remove_repeats(docs).collect())
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == [(0, 540, nothing), (5, 540, nothing), (5, 540, nothing), (2 ** 60 + 1, 5, hashlib.sha256(b"other").hexdigest())]
    assert sr.remove_repeats(docs.limit(0)).count() == 0
    assert sr.remove_repeats(docs.where("doc_id = 1")).columns == ["doc_id", "n_bytes", "spans", "kept_sha256"]
    with pytest.raises(ValueError):
        sr.remove_repeats(docs, 50)


def test_bits_come_back_in_order():
    upper = np.array([5, 9, 5, 30, 2], np.uint64)
    order, have, begin = blocks.dealt(upper, 7)
    assert [upper[order[a:b]].tolist() for a, b in zip(begin[:-1], begin[1:])] == [[9, 30, 2], [5, 5]] and have.tolist() == [2, 5]


def test_query_columns(spark):
    got = QUERIES["op11_suffix_repeats"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert got.where(F.col("n_removed") > F.col("n_bytes")).isEmpty()
