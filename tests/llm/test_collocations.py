import random
import re
from collections import Counter

import numpy as np
import pytest

from siftworks.llm import collocations as co
from siftworks.llm.common import LOWER_AZ

SCHEMA = "text string, lang string, phrase string, f int"


def brute(rows, threshold, top):
    out = []
    for lang in {l or "und" for _, l in rows if l is not None} | {"und"}:
        f, n = Counter(), 0
        for text, l in rows:
            if (l if l is not None else "und") != lang:
                continue
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER_AZ)):
                words = re.findall(r"[^\x20\x09]+", piece)
                n += len(words)
                for k in range(1, 6):
                    f.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
        candidates = {p for p, a in f.items() if a >= threshold and len(p) > 1}
        ranked = []
        for p in candidates:
            if any(len(q) > len(p) and 100 * f[q] >= 100 * f[p] and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in candidates):
                continue
            score, k = min((1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def corpus(seed):
    draw = random.Random(seed)
    words = ["ab", "née", "Ç", "tree", "OF", "x", "日本", "a\x00b", "q w", "-", "1"]
    stock = ["New York City council", "tree of ab née x", "tree of ab", "日本 x - 1 OF the"]
    rows = [(None, "en"), ("", "en"), (" \t ", None), ("lone", None), ("a.b,c;d\ne\x0bf\x0cg\rh", "en")]
    for _ in range(60):
        parts = [draw.choice(stock) if draw.random() < 0.4 else draw.choice(words) for _ in range(draw.randrange(60))]
        rows.append((draw.choice([" ", "  ", "\t"]).join(p + draw.choice(["", "", "", ".", "!", "\n"]) for p in parts), draw.choice(["en", "de", None, "und"])))
    return rows + rows[-5:] * 3


@pytest.mark.parametrize("seed,threshold,top", [(1, 5, 2000), (2, 20, 7), (3, 1, 40)])
def test_brute_force(spark, seed, threshold, top, monkeypatch):
    rows = corpus(seed)
    whole = co.text_blocks
    monkeypatch.setattr(co, "text_blocks", lambda docs, label: whole(docs, label, 400))
    docs = spark.createDataFrame([(t, l, "clash", 1) for t, l in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in co.collocations(docs, threshold, top).collect()]
    assert sorted(got) == brute(rows, threshold, top)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert co.collocations(docs).collect() == []
    assert co.collocations(spark.createDataFrame([(None, None, "", 0), ("one", "en", "", 0)], SCHEMA)).collect() == []


def test_summary_keeps_what_is_frequent():
    draw = np.random.default_rng(3)
    for threshold in (7, 50):
        batches = [np.unique(draw.zipf(1.3, 4000).clip(max=10 ** 6).astype(np.uint32), return_counts=True) for _ in range(30)]
        total = Counter()
        for keys, counts in batches:
            total.update(dict(zip(keys.tolist(), counts.tolist())))
        summary = co.Summary(sum(total.values()) // threshold + 1)
        for keys, counts in batches:
            summary.merge(keys, counts)
            assert len(summary.keys) <= summary.capacity
        assert summary.taken < threshold and {k for k, n in total.items() if n >= threshold} <= set(summary.may_reach(threshold).tolist())
        one, other = co.Summary(summary.capacity), co.Summary(summary.capacity)
        for i, (keys, counts) in enumerate(batches):
            (one if i % 2 else other).merge(keys, counts)
        one.merge(other.keys, other.counts, other.taken)
        assert {k for k, n in total.items() if n >= threshold} <= set(one.may_reach(threshold).tolist())


def test_too_small_a_summary_is_told():
    summary = co.Summary(1)
    summary.merge(np.array([1, 2], np.uint32), np.array([5, 5]))
    with pytest.raises(ValueError):
        summary.may_reach(5)


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10 ** 12
    counts = spark.createDataFrame([("en", "", 0, 7 * big), ("en", "a", 1, 2 * big), ("en", "b", 1, 2 * big - 1), ("en", "a b", 2, big)], "lang string, phrase string, words long, f long")
    monkeypatch.setattr(co, "phrase_counts", lambda docs, threshold: counts)
    [row] = co.collocations(None).collect()
    assert row["score"] == 1000 * big * 7 * big // (2 * big * (2 * big - 1))
