"""Phrases found through the index against a plain search of every phrase in every text."""
import random
import re

from pyspark.sql import functions as F

from siftworks.functions import scoring as sc, text as tx
from siftworks.rules import WeightedRules

WORDS = ["data", "entry", "remote", "perché", "c++", "e-mail", "job", "a", "part", "time", "napoli", "x1"]


def found_in(text, phrase):
    return text is not None and re.search(r"\b" + re.escape(phrase) + r"\b", text) is not None


def test_phrases_of_large_rule_sets(spark):
    draw = random.Random(3)
    made = lambda low, high: " ".join(draw.choice(WORDS) for _ in range(draw.randint(low, high)))
    phrases = sorted({made(1, 3) for _ in range(700)}) + ["data", "++", "data  entry"]
    texts = [None, "", "++", "a++b", "data  entry", *(made(0, 30) for _ in range(60)), ", ".join(WORDS), "-".join(WORDS)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = {r.i: r.found for r in tx.find_phrases(rows, "t", phrases, "found").collect()}
    assert got == {i: [p for p in phrases if found_in(t, p)] for i, t in enumerate(texts)}
    assert [r.found for r in tx.find_phrases(rows, "t", [], "found").collect()] == [[]] * len(texts)


def test_points_in_rule_order(spark):
    rules = WeightedRules.from_mapping({"positive_weights": {"Data": 5, "entry": 3, "napoli": 2}, "negative_weights": {"senior": -9, "data": -1},
                                        "combo_weights": [{"phrases": ["data", "entry"], "points": 7, "reason": "pair"}, {"phrases": ["entry", "napoli"], "points": 4, "reason": "near"}]})
    rows = spark.createDataFrame([(0, ["entry", "data"]), (1, []), (2, ["senior", "napoli"]), (3, None)], "i int, m array<string>")
    hits = F.concat(*sc.weighted_hits(F.col("m"), rules))
    got = {r.i: [tuple(h) for h in r.h] for r in rows.select("i", hits.alias("h")).collect()}
    assert rules.positive and rules.negative and rules.combos
    singles = [(p.lower(), n, f"+{n} {p}") for p, n in rules.positive]
    negatives = [(p.lower(), n, f"{n} {p}") for p, n in rules.negative]
    for i, matched in ((0, {"entry", "data"}), (1, set()), (2, {"senior", "napoli"}), (3, set())):
        combos = [(n, f"+{n} {r}") for ps, n, r in rules.combos if {p.lower() for p in ps} <= matched]
        assert got[i] == [(n, r) for p, n, r in singles if p in matched] + combos + [(n, r) for p, n, r in negatives if p in matched]
