"""Quality rules: rule statistics of each text, judged by an isolation forest with a threshold from labelled rows.

All labelled rows are measured: the box that the trees cut spans all of them, and the threshold is the score that best tells all
of the labelled classes apart while it rejects at most ``FALSE_REJECTS`` of the good ones. As the method has it, each tree then grows
on ``SUBSAMPLE`` good rows, drawn from the ``DRAWN`` of smallest hash (all of them, where there are fewer), as many as all trees
together can hold. Path lengths over random splits give the anomaly score. Base rules (too few words, too many repeated words) reject by themselves.

Defined cases. Null or empty text: all statistics 0, ``base_failed`` true. No labels, or labels of one class: the base rules
alone decide. A doc_id with both labels is not learned from. Repeated rows: each gets its own, equal verdict. Empty table: no rows.
Further columns are not read, unless rows are asked for, which come back as they were.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import WORD, kept_table
from siftworks.llm.ngram_join import word_hashes
from siftworks.llm.running import running

TREES, SUBSAMPLE, DEEPEST, SEED = 150, 256, 14, 7
# Good rows that the trees are drawn from.
DRAWN = TREES * SUBSAMPLE
FEATURES = 8
FALSE_REJECTS = 0.002
# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW, FEWEST_WORDS, REPEAT_PERCENT = 8, 20, 30

STATISTICS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, anomaly double"
_SPACE, _UPPER, _MARK, _SYMBOL, _OTHER = range(5)
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """Kind of every code point, made once per worker."""
    if not _KINDS:
        kinds = np.full(0x110000, _OTHER, np.uint8)
        for code in range(0x110000):
            category = unicodedata.category(chr(code))
            if category == "Lu":
                kinds[code] = _UPPER
            elif category[0] not in "LNM":
                kinds[code] = _MARK
        kinds[[ord(c) for c in SYMBOLS]] = _SYMBOL
        kinds[[0x20, *range(0x09, 0x0E)]] = _SPACE
        _KINDS.append(kinds)
    return _KINDS[0]


def _repeated(each: np.ndarray) -> int:
    """Words inside windows of 8 words that the text holds at least twice."""
    last = len(each) - WINDOW + 1
    if last < 2:
        return 0
    window = np.zeros(last, np.uint64)
    for i in range(WINDOW):
        window = window * np.uint64(0x9E3779B97F4A7C15) + each[i:i + last]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(last, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(each) + 1, np.int64)
    edge[:last] += twice
    edge[WINDOW:] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(text: str | None) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """The contract's five numbers and the vector that the forest sees: shares, those of repeated lines and words among them, no measure of length."""
    words = WORD.findall(text) if text else []
    if not words:
        return (0, 0, 0, 0, 0), [0.0] * FEATURES
    counts = np.bincount(_kinds()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)], minlength=5)
    chars = len(text) - int(counts[_SPACE])
    seen, repeated_lines, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            if line in seen:
                repeated_lines += 1
            else:
                seen.add(line)
    each = word_hashes(words)
    n, again = len(words), _repeated(each)
    adjacent = int((each[1:] == each[:-1]).sum())
    single = sum(1 for w in words if len(w) == 1 and not w.isalnum())
    vector = [counts[_SYMBOL] / n, chars / n, counts[_UPPER] / chars, counts[_MARK] / chars, adjacent / n, single / n,
              repeated_lines / lines, again / n]
    return (n, chars, int(counts[_SYMBOL]), repeated_lines, again), vector


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < FEWEST_WORDS or 100 * n_repeat_words > REPEAT_PERCENT * n_words


class Forest:
    """Isolation trees as arrays: feature (-1 at leaves), cut, children, and the path length at each node.

    Trees grow on usual rows, but their root spans the box of all rows, so that a cut may part a region where no usual row is: what
    falls there is isolated at once, and groups of alike bad rows cannot hide each other.
    """

    def __init__(self, usual: np.ndarray, box: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.subsample = min(subsample, len(usual))
        low, high = box.min(axis=0), box.max(axis=0)
        grown = [self._grow(usual[draw.choice(len(usual), self.subsample, replace=False)], low, high, draw) for _ in range(trees)]
        width = max(len(t) for t in grown)
        table = np.zeros((trees, width, 5))
        table[:, :, 0] = -1
        for k, tree in enumerate(grown):
            table[k, :len(tree)] = tree
        self.feature, self.left, self.right = (table[:, :, c].astype(np.int32) for c in (0, 2, 3))
        self.cut, self.length = table[:, :, 1], table[:, :, 4]

    @staticmethod
    def usual(n: int) -> float:
        """Mean path length of an unsuccessful search in a tree of n rows."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, draw) -> list[list[float]]:
        nodes: list[list[float]] = []

        def node(part: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0, 0, 0, depth + self.usual(len(part))])
            free = np.flatnonzero(high > low)
            if depth >= DEEPEST or len(part) < 2 or not len(free):
                return at
            feature = int(draw.choice(free))
            cut = draw.uniform(low[feature], high[feature])
            under = part[:, feature] <= cut
            below, above = high.copy(), low.copy()
            below[feature] = above[feature] = cut
            nodes[at][:2] = [feature, cut]
            nodes[at][2] = node(part[under], low, below, depth + 1)
            nodes[at][3] = node(part[~under], above, high, depth + 1)
            return at

        node(rows, low, high, 0)
        return nodes

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly in 0 to 1; shorter mean paths give higher scores."""
        trees = np.arange(len(self.feature))
        at = np.zeros((len(rows), len(trees)), np.int32)
        while True:
            feature = self.feature[trees, at]
            inner = feature >= 0
            if not inner.any():
                break
            value = np.take_along_axis(rows, np.maximum(feature, 0), axis=1)
            step = np.where(value <= self.cut[trees, at], self.left[trees, at], self.right[trees, at])
            at = np.where(inner, step, at)
        return 2.0 ** (-self.length[trees, at].mean(axis=1) / max(self.usual(self.subsample), 1e-9))


def threshold(scored: DataFrame, false_rejects: float = FALSE_REJECTS) -> float:
    """Score above which rows (score, good) are rejected: most bad rows caught with at most that share of good rows lost; ties keep.

    Counts of good and bad rows run over the ordered distinct scores on the executors; two scores come back.
    """
    each = scored.groupBy(F.lit(0).alias("all"), "score").agg(F.sum("good").alias("own_good"), F.sum(1 - F.col("good")).alias("own_bad"))
    cuts = kept_table(running(each, "all", [F.col("score")], ["below_good", "below_bad"], lambda row: (int(row.own_good), int(row.own_bad)),
                              lambda a, b: (a[0] + b[0], a[1] + b[1]), drop=("own_good", "own_bad")), "cuts")
    n = cuts.agg(F.max("below_good").alias("good"), F.max("below_bad").alias("bad")).first()
    lost, caught = 1 - F.col("below_good") / n["good"], 1 - F.col("below_bad") / n["bad"]
    gains = cuts.select("score", F.when(lost <= false_rejects, caught - lost).otherwise(-1.0).alias("gain"))
    best = gains.where(F.col("gain") == gains.agg(F.max("gain")).first()[0])
    middle = best.orderBy("score").offset(best.count() // 2).first()["score"]
    above = gains.where(F.col("score") > middle).agg(F.min("score")).first()[0]
    return float((middle + (middle if above is None else above)) / 2)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Forest, float] | None:
    """Forest and threshold from all labelled rows; None without two classes."""
    known = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high")
             .select(F.col("doc_id").alias("id"), F.col("low").alias("good")))

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [statistics(t) for t in frame["text"]]
            yield pd.DataFrame({"id": frame["id"].to_numpy(), "good": (frame["good"] == 1).to_numpy().astype(np.int32), "base": [base_failed(s[0], s[4]) for s, _ in found], "vector": [v for _, v in found]})

    # Of rows with one doc_id the smallest text counts.
    rows = kept_table(docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("id")).groupBy("id", "good").agg(F.min("text").alias("text"))
                      .mapInPandas(measure, "id long, good int, base boolean, vector array<double>").where("not base").drop("base"), "measured")
    sides = [side(F.get("vector", F.lit(i))) for side in (F.min, F.max) for i in range(FEATURES)]
    n, n_good, *box = rows.agg(F.count("*"), F.sum("good"), *sides).first()
    if not n_good or n_good == n:
        return None
    # Smallest hashes first; what lies far beyond them is left out before, so that few rows more than are drawn come to the driver.
    reach = min((1 << 63) - 1, int(1.2 * DRAWN / n_good * (1 << 64)) - (1 << 63))
    drawn = rows.where((F.col("good") == 1) & (F.xxhash64("id") <= reach)).orderBy(F.xxhash64("id"), "id").limit(DRAWN).toPandas().sort_values("id")
    forest = Forest(np.array(drawn["vector"].tolist()), np.array(box, np.float64).reshape(2, FEATURES))
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), 2000):
                part = frame.iloc[start:start + 2000]
                yield pd.DataFrame({"score": sent.value.score(np.array(part["vector"].tolist())), "good": part["good"].to_numpy()})

    return forest, threshold(rows.mapInPandas(score, "score double, good int"))


def quality_rules(docs: DataFrame, labels: DataFrame, rows: bool = False) -> DataFrame:
    """The verdict on every document (see ``STATISTICS``), or, with ``rows``, the kept rows of ``docs`` as they are."""
    model = fit(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for frame in frames:
            for start in range(0, len(frame), 2000):
                part = frame.iloc[start:start + 2000]
                found = [statistics(t) for t in part["text"]]
                numbers = np.array([s for s, _ in found], np.int64).reshape(-1, 5)
                failed = np.array([base_failed(s[0], s[4]) for s, _ in found], bool)
                score = np.zeros(len(part))
                if model is not None and len(part):
                    score = model[0].score(np.array([v for _, v in found]))
                kept = ~failed & ((score <= model[1]) if model is not None else True)
                if rows:
                    yield part[kept]
                else:
                    yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "n_words": numbers[:, 0], "word_chars": numbers[:, 1],
                                        "n_symbols": numbers[:, 2], "n_dup_lines": numbers[:, 3], "n_repeat_words": numbers[:, 4],
                                        "base_failed": failed, "kept": kept, "anomaly": score})

    if rows:
        return docs.mapInPandas(judge, docs.schema)
    return docs.select("doc_id", "text").mapInPandas(judge, STATISTICS)
