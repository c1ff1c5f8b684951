import random

from siftworks.llm import ngram_join as nj
from siftworks.llm.common import LOWER_AZ, WORD
from siftworks.llm.components import components

SCHEMA = "doc_id long, text string, size int, digest string"


def brute(rows, n, percent):
    sets = {}
    for doc, text in rows:
        words = WORD.findall((text or "").translate(LOWER_AZ))
        span = min(n, len(words))
        sets[doc] = {tuple(words[i:i + span]) for i in range(len(words) - span + 1)} if words else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def corpus(seed=5):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passage = [draw.choice(words) for _ in range(60)]
    texts = [None, "", "  \t\n", "one", "one", "One two", "one TWO", "É é", "a b c"]
    bases = [[draw.choice(words) for _ in range(draw.choice((12, 30, 80, 150)))] for _ in range(12)]
    for base in bases:
        for _ in range(draw.choice((1, 3, 12))):
            copy = list(base)
            for _ in range(draw.choice((0, 0, 1, 2, 3, 6))):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy + (passage if draw.random() < 0.3 else [])))
    chain = list(bases[3])
    for k in range(20):
        chain = list(chain)
        chain[(7 * k) % len(chain)] = f"c{k}"
        texts.append(" ".join(chain))
    texts += ["long " + " ".join(draw.choice(words) for _ in range(5000))] * 2
    return [(100 + i, t) for i, t in enumerate(texts)]


def check(spark, rows, n, percent):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    got = {r[0]: (r[1], r[2]) for r in nj.ngram_jaccard_join(docs, n, percent).collect()}
    assert got == brute(rows, n, percent)


def test_contract(spark):
    check(spark, corpus(), 3, 90)


def test_wider_links_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 4)
    monkeypatch.setattr(nj, "MOST_SENT_IDS", 3)
    check(spark, corpus(9), 5, 80)


def test_repeated_rows_and_empty_table(spark):
    rows = [(7, "a b c d e"), (7, "a b c d e"), (3, "A b c d e"), (None, "a b c d e"), (None, None)]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in nj.ngram_jaccard_join(docs, 3, 90).collect()), key=str)
    assert got == sorted([(7, 3, 3), (7, 3, 3), (3, 3, 3), (None, 3, None), (None, 0, None)], key=str)
    assert nj.ngram_jaccard_join(docs.limit(0), 3, 90).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 103), (103, 101)], "u long, v long")
    got = {tuple(r) for r in components(edges).collect()}
    assert got == {(i, 0) for i in range(61)} | {(100, 100), (101, 100), (103, 100)}


def brute_links(rows, n, percent):
    sets = {d: {tuple(w[i:i + min(n, len(w))]) for i in range(len(w) - min(n, len(w)) + 1)} if w else set()
            for d, t in rows for w in [WORD.findall((t or "").translate(LOWER_AZ))]}
    return {(a, b) for a in sets for b in sets if a != b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}, sets


def test_every_link_is_counted(spark, monkeypatch):
    draw = random.Random(2)
    base = [f"b{i}" for i in range(150)]
    near = [" ".join(base[:k] + [f"x{k}"] + base[k + 1:]) for k in draw.sample(range(150), 30)]
    rows = corpus(11) + [(1000 + i, t) for i, t in enumerate([*near, near[0], near[0].upper()])]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    want, sets = brute_links(rows, 3, 90)
    for size in (256, 4):
        monkeypatch.setattr(nj, "BLOCK_SETS", size)
        monkeypatch.setattr(nj, "SHINGLES", 32 * size)
        got = {r["doc_id"]: r["n_links"] for r in nj.ngram_jaccard_counts(docs, 3, 90).collect()}
        assert got == {d: sum(a == d for a, _ in want) for d, _ in rows} and got[1000] > 20
        found = [tuple(r) for r in nj.ngram_jaccard_links(docs, 3, 90).collect()]
        different = {(a, b) for a, b in want if a < b and sets[a] != sets[b]}
        assert sum(x * y for *_, x, y in found) == len(different) and {f[:2] for f in found} <= different and len(found) == len({f[:2] for f in found})
    parts = sorted(map(tuple, nj.ngram_jaccard_components(docs, 3, 90).collect()))
    assert parts == sorted(map(tuple, nj.ngram_jaccard_join(docs, 3, 90).collect()))


def test_links_of_odd_rows(spark):
    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(61))
    rows = [(7, a), (7, b), (9, "other"), (None, a), (None, None), (8, "")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["n_shingles"], r["n_links"]) for r in nj.ngram_jaccard_counts(docs, 3, 90).collect()), key=str)
    assert got == sorted([(7, 58, 1), (7, 59, 1), (9, 1, 0), (None, 58, 0), (None, 0, 0), (8, 0, 0)], key=str)


def test_the_counted_share_changes_no_link(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(11), "doc_id long, text string")
    answers = []
    for one_in, frequent in ((1, 400_000), (16, 400_000), (3, 5), (1, 0)):
        monkeypatch.setattr(nj, "COUNTED_ONE_IN", one_in)
        monkeypatch.setattr(nj, "MOST_FREQUENT", frequent)
        answers.append(sorted(map(tuple, nj.ngram_jaccard_counts(docs, 3, 80).collect()), key=repr))
    assert answers[1:] == answers[:1] * 3


def test_a_list_of_near_copies_is_cut_to_its_forest_in_little_memory(monkeypatch):
    import tracemalloc

    import numpy as np
    draw = np.random.default_rng(3)
    base = np.unique(draw.integers(0, 1 << 63, 200).astype(np.uint64))
    sets = []
    for _ in range(1200):
        values = base.copy()
        at = draw.choice(len(base), int(draw.integers(0, 12)), replace=False)
        values[at] = draw.integers(0, 1 << 63, len(at)).astype(np.uint64)
        sets.append(np.unique(values))
    sets.sort(key=len)
    ids, sizes, bits = draw.permutation(len(sets)), np.array([len(v) for v in sets]), [nj.bitmap(v) for v in sets]
    half = np.arange(len(sets)) % 2 == 0

    def forest(left):
        tracemalloc.start()
        try:
            (i, j, _), = nj._forest_of(nj._open_pairs(sizes, ids, bits, left, 80), ids, ids)
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        return set(zip(np.minimum(ids[i], ids[j]).tolist(), np.maximum(ids[i], ids[j]).tolist())), peak

    for left in (None, half):
        monkeypatch.setattr(nj, "MOST_PAIRS", 50_000)
        cut, peak = forest(left)
        monkeypatch.setattr(nj, "MOST_PAIRS", 1 << 40)
        whole, most = forest(left)
        assert cut == whole and len(cut) == len(sets) - 1
        assert peak < 10_000_000 < most
