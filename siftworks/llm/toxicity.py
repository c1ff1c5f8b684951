"""Toxicity by a weighted finite-state grammar of clauses.

Words become symbols: insult (with a learned weight), threat, target, negation, reported speech, clause end, other. Small transducers
read the symbols and pass factors on: negation weakens what follows within its reach, reported speech weakens the rest of its
clause, a target in the clause strengthens it, a threat counts once it has a target. They are composed into one machine whose state is the
tuple of theirs; the clause's score is the sum of insult weights times the factors, and a text's score a calibrated function of its clauses.

Learning. Insult weights are log-odds of words and word beginnings (stems, so that unseen endings count) in a bounded sample of labelled rows:
at most ``MOST_TOXIC`` toxic and ``MOST_CLEAN`` clean documents, smallest hash of the id first, one of each group of copies. The map from clause scores to 0..1 is a
logistic fit on the same rows. Scores depend on the text alone.

Defined cases. Null or empty text: the score of no toxic clause. No toxic or no clean labels: score 0 for all. A doc_id with both labels is
not learned from. Repeated rows: each its own, equal score. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_TOXIC, MOST_CLEAN = 6_000, 14_000
MOST_STEMS = 5_000
STEM_LENGTHS = (4, 5, 6)
LEAST_SHARE, LEAST_DOCS, LEAST_ODDS = 0.005, 3, 2.5
PREDICTED_FROM = 0.7
MEMO_WORDS = 200_000

# Closed word classes of the grammar (English, German, French, Spanish), reach and factors.
THREATS = frozenset("kill hurt destroy murder beat stab shoot burn hang töten umbringen schlagen tuer frapper brûler matar golpear quemar".split())
TARGETS = frozenset("you your yours he she they him her them u du dich dir ihr euch sie er tu toi vous il elle ils usted ustedes tú ti ellos".split())
NEGATIONS = frozenset("not never no none nobody nicht nie kein keine keinen pas jamais aucun nunca jamás ningún".split())
REPORTS = frozenset("said says say called calls wrote quoted claimed reported sagte sagt nannte schrieb dit disait écrit appelé dijo dice llamó escribió".split())
NEGATION_REACH = 3
NEGATED, REPORTED, TARGETED, THREAT_WEIGHT = 0.5, 0.7, 1.25, 2.0

SYMBOLS = re.compile(r"\w+|[.!?;\n]")
WORDS = re.compile(r"\w+")
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)


def negation_step(state: int, symbol: int) -> int:
    """State: words that the last negation still reaches."""
    return NEGATION_REACH if symbol == NEGATION else max(0, state - 1)


def report_step(state: int, symbol: int) -> int:
    return 1 if symbol == REPORT else state


def target_step(state: int, symbol: int) -> int:
    return 1 if symbol == TARGET else state


def threat_step(state: int, symbol: int) -> int:
    return 1 if symbol == THREAT else state


MACHINES = (negation_step, report_step, target_step, threat_step)


def compose() -> dict[tuple[tuple[int, ...], int], tuple[tuple[int, ...], float]]:
    """The product machine: (state, symbol) to (next state, factor on an insult that is read)."""
    table, todo = {}, [(0, 0, 0, 0)]
    while todo:
        state = todo.pop()
        for symbol in range(6):
            if (state, symbol) in table:
                continue
            after = tuple(step(s, symbol) for step, s in zip(MACHINES, state))
            factor = (NEGATED if state[0] else 1.0) * (REPORTED if state[1] else 1.0) if symbol == INSULT else 0.0
            table[state, symbol] = (after, factor)
            todo.append(after)
    return table


MACHINE = compose()
BEGIN = (0, 0, 0, 0)


class Grammar:
    """Learned weights of words and stems, and the calibration of text scores."""

    def __init__(self, weights: dict[str, float], slope: float = 0.0, level: float = 0.0):
        self.weights, self.slope, self.level = weights, slope, level
        self.memo: dict[str, tuple[int, float]] = {}

    def symbol(self, word: str) -> tuple[int, float]:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
            weight = self.weights.get("=" + word)
            for n in sorted(STEM_LENGTHS, reverse=True):
                if weight is None and len(word) >= n:
                    weight = self.weights.get(word[:n])
            found = ((INSULT, weight) if weight is not None else (THREAT, 0.0) if word in THREATS else (TARGET, 0.0) if word in TARGETS
                     else (NEGATION, 0.0) if word in NEGATIONS else (REPORT, 0.0) if word in REPORTS else (OTHER, 0.0))
            self.memo[word] = found
        return found

    def clauses(self, text: str | None) -> list[float]:
        """Scores of the clauses that match, in order."""
        if not text:
            return []
        lower = text.lower()
        if all(self.symbol(w)[0] > THREAT for w in set(WORDS.findall(lower))):
            return []
        out, state, score = [], BEGIN, 0.0
        for word in [*SYMBOLS.findall(lower), "\n"]:
            if word in ".!?;\n":
                if state[3] and state[2]:
                    score += THREAT_WEIGHT * (NEGATED if state[0] else 1.0)
                if score > 0:
                    out.append(score * (TARGETED if state[2] else 1.0))
                state, score = BEGIN, 0.0
                continue
            symbol, weight = self.symbol(word)
            state, factor = MACHINE[state, symbol]
            score += factor * weight
        return out

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-(self.level + self.slope * np.log1p(sum(self.clauses(text)))))))


def _features(text: str | None) -> set[str]:
    words = set(WORDS.findall(text.lower())) if text else set()
    return {"=" + w for w in words} | {w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n}


def _family(text: str | None) -> int:
    """The same number for copies, and mostly for near copies: the least hash of five consecutive words."""
    words = WORDS.findall(text.lower()) if text else []
    return min((xxhash.xxh3_64_intdigest(" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))), default=0) >> 1


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level by Newton steps with a small ridge on the slope."""
    a, b = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([((p - y) * x).sum() + 0.05 * a, (p - y).sum()])
        hessian = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def learn(docs: DataFrame, labels: DataFrame, keep: Column) -> Grammar | None:
    """The grammar from the labelled rows where ``keep`` (over doc_id) holds."""
    known = (labels.where(keep & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.min("toxic").alias("low"), F.max("toxic").alias("high")).where("low = high"))
    part = lambda toxic, most: (known.where(F.col("low") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
                                .select(F.col("doc_id").alias("id"), F.lit(toxic).alias("toxic")))
    chosen = part(1, MOST_TOXIC).unionByName(part(0, MOST_CLEAN))

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"id": frame["id"].to_numpy(), "toxic": frame["toxic"].to_numpy(), "family": [_family(t) for t in frame["text"]], "text": frame["text"]})

    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("id", "toxic", "text")
            .mapInPandas(mark, "id long, toxic int, family long, text string").groupBy("family", "toxic").agg(F.min_by("text", "id").alias("text")))
    rows = rows.persist()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(frame["text"], frame["toxic"]):
                counts[toxic].update(_features(text))
            yield pd.DataFrame([(f, toxic, n) for toxic, counter in counts.items() for f, n in counter.items()], columns=["stem", "toxic", "n"])

    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        rows.unpersist()
        return None
    least = max(LEAST_DOCS, LEAST_SHARE * toxic)
    counted = (rows.mapInPandas(count, "stem string, toxic int, n long").groupBy("stem")
               .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("fine")))
    odds = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("fine") + 0.5) / (clean + 1))
    found = counted.where(F.col("bad") >= least).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS).orderBy(F.desc("odds"), "stem").limit(MOST_STEMS).collect()
    grammar = Grammar({r["stem"]: r["odds"] for r in found})

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"toxic": frame["toxic"], "total": [float(np.log1p(sum(grammar.clauses(t)))) for t in frame["text"]]})

    points = rows.mapInPandas(measure, "toxic int, total double").toPandas()
    rows.unpersist()
    grammar.slope, grammar.level = _logistic(points["total"].to_numpy(), points["toxic"].to_numpy(np.float64))
    return Grammar(grammar.weights, grammar.slope, grammar.level)


def toxicity(docs: DataFrame, labels: DataFrame, keep: Column) -> DataFrame:
    """(doc_id, score, predicted, worst_clause, n_clauses) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, keep))

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = sent.value
        for frame in frames:
            clauses = [grammar.clauses(t) if grammar else [] for t in frame["text"]]
            total = np.log1p(np.array([sum(c) for c in clauses], np.float64))
            score = 1 / (1 + np.exp(-(grammar.level + grammar.slope * total))) if grammar else np.zeros(len(frame))
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "score": score, "predicted": (score >= PREDICTED_FROM).astype(np.int32),
                                "worst_clause": [max(c, default=0.0) for c in clauses], "n_clauses": [len(c) for c in clauses]})

    return docs.select("doc_id", "text").mapInPandas(judge, "doc_id long, score double, predicted int, worst_clause double, n_clauses long")
