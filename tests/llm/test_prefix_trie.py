import hashlib
import random
import zlib

from pyspark.sql import functions as F

from siftworks.llm import prefix_trie as pt
from siftworks.llm.running import running

SCHEMA = "conv_id long, turn long, role string, text string, depth int, n_convs string"


def brute(rows):
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(conv, []).append((role or "", text or ""))
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, members in nodes.items():
        d = len(node)
        below = [n for n in nodes if n[:d] == node]
        children = [n for n in below if len(n) == d + 1]
        ends = sorted(c for c in members if len(made[c]) == d)
        out.append((min(members), d, min(nodes[node[:-1]]) if d else None, len(members), len(children),
                    sum(1 for n in below if not any(len(o) == len(n) + 1 and o[:len(n)] == n for o in below)),
                    sum((len(nodes[n]) - 1) * (len(n[-1][1].encode()) if n else 0) for n in below),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out)


def corpus(seed, convs=60):
    draw = random.Random(seed)
    openings = [("system", "be kind"), ("user", "héllo"), ("user", ""), (None, None), ("", ""), ("user", "日本")]
    rows = [(None, 1, "user", "nobody's"), (12, None, "user", "null turn"), (12, None, "user", "null turn"), (12, 0, None, "a")]
    stock = [[draw.choice(openings) for _ in range(12)] for _ in range(3)]
    for c in range(convs):
        if draw.random() < 0.15:
            continue
        turns = list(draw.choice(stock))[:draw.randrange(1, 13)]
        if draw.random() < 0.4:
            turns[draw.randrange(len(turns))] = ("user", f"own {draw.randrange(4)}")
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    long = [(("user", "assistant")[i % 2], f"turn {i // 2}") for i in range(150)]
    rows += [(c, t, *turn) for c in (1001, 1002, 1004) for t, turn in enumerate(long[:150 - c % 3])]
    draw.shuffle(rows)
    return rows


def run(spark, rows):
    return sorted((tuple(r) for r in pt.prefix_trie(spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(5)).collect()), key=repr)


def test_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        assert run(spark, rows) == sorted(brute(rows), key=repr)


def test_ownership_that_changes_at_every_depth(spark):
    """Each conversation shares one turn more with the one before it, so that the tree of paths is deep."""
    rows = []
    for i in range(25):
        c = 5 * (40 - i)  # its own base
        rows += [(c, t, "user", f"t{t}") for t in range(i)] + [(c, i, "user", f"own {i}")]
    assert run(spark, rows) == sorted(brute(rows), key=repr)


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pt.prefix_trie(empty).collect() == []
    assert run(spark, [(None, 0, "user", "x")]) == []
    [root] = run(spark, [(7, 0, "user", "x")])  # its base lends nothing and its own turns are below what would be lent
    assert root[:5] == (7, 0, None, 1, 0) and root == brute([(7, 0, "user", "x")])[0]


def test_equal_elements_are_proved(spark, monkeypatch):
    """With elements of no information the proof fails, and other bases are tried."""
    real, tried = pt.prefixes, []

    def weak(turns, bases):
        tried.append(bases)
        found = real(turns, bases)
        return found.withColumn("f1", F.lit(0).cast("long")).withColumn("f2", F.lit(0).cast("long")) if len(tried) == 1 else found
    monkeypatch.setattr(pt, "prefixes", weak)
    rows = corpus(4, 20)
    assert run(spark, rows) == sorted(brute(rows), key=repr)
    assert len(tried) == 2


def test_running_over_many_tasks(spark):
    rows = [(1 if i % 3 else i, i, i % 7) for i in range(600)]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the tasks are not merged again
    try:
        got = running(spark.createDataFrame(rows, "k long, o long, x long"), "k", [F.col("o").desc()], ["s"], lambda r: (r.x,), lambda a, b: (a[0] + b[0],)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sums, want = {}, {}
    for k, o, x in sorted(rows, key=lambda r: -r[1]):
        sums[k] = want[k, o] = sums.get(k, 0) + x
    assert {(r["k"], r["o"]): r["s"] for r in got} == want
