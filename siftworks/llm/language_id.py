"""Language identification of mixed texts: scripts narrow the candidates, then a Viterbi pass over word scores labels spans.

Learning. From a bounded sample (``SAMPLE`` documents of each language, smallest hash of the id first; folds that the caller holds out
are never read) come counts of letter 1- to 4-grams of words per language and the share of each script per language. So a rare language is
learned, too. The most frequent grams of each language are kept: ``MOST_GRAMS`` shared evenly, but at least ``LEAST_GRAMS`` for each.
Prediction. A word's score for a language is the mean log-probability of its grams times their number (at most 8), relative to the best language;
languages that do not write the word's script are out. Changing the language between words costs ``SWITCH``. All texts of a
batch advance together, word by word. The text's language is the one with most letters in words that speak for any; ties: the first by name. The score is its share of all letters.

Defined cases. Null text or no letter: ``und``, score 0. Words in a script that no language has: no evidence, their letters count
for no language; a text of such words only has the first language by name and score 0. Nothing to learn
from: ``und`` for all. Repeated rows: each its own, equal result. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.llm.common import kept_table

# Documents that are learned from, of each language.
SAMPLE = 3_000
MOST_GRAMS = 150_000
LEAST_GRAMS = 1_000
SWITCH = 8.0
SMOOTHING = 0.5
MEMO_WORDS = 300_000
MULTIPLIER = 0x9E3779B97F4A7C15
CHUNK_CHARS = 4_000_000

LETTERS = re.compile(r"[^\W\d_]+")
# First code points of Unicode ranges by script.
SCRIPT_STARTS = ((0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
                 (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
                 (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
                 (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
                 (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"))
_STARTS = [s for s, _ in SCRIPT_STARTS]
LEAST_SHARE = 0.01


def script(word: str) -> str:
    return SCRIPT_STARTS[bisect.bisect_right(_STARTS, ord(word[0])) - 1][1]


def grams(word: str) -> list[str]:
    """Letter 1- to 4-grams of a word with its ends marked."""
    marked = f"^{word}$"
    return [marked[i:i + n] for n in (2, 3, 4) for i in range(len(marked) - n + 1)] + list(word)


def _hash(gram: str) -> int:
    value = 0
    for c in gram:
        value = (value * MULTIPLIER + ord(c) + 1) & ((1 << 64) - 1)
    return value


class Model:
    """Log-probabilities of grams per language and the languages of each script."""

    def __init__(self, languages: list[str], table: dict[str, np.ndarray], unseen: np.ndarray, scripts: dict[str, np.ndarray]):
        self.languages, self.table, self.unseen, self.scripts = languages, table, unseen, scripts
        rows = list(table.values())
        hashes = np.array([_hash(g) for g in table], np.uint64)
        ranked = np.argsort(hashes)
        self.keys = hashes[ranked] if len(table) else np.zeros(1, np.uint64)
        self.lines = np.array([*(rows[k] for k in ranked.tolist()), *([unseen] if not table else []), unseen])
        self.allowed = np.array([scripts.get(name, np.zeros(len(languages), bool)) for _, name in SCRIPT_STARTS])
        self.memo: dict[str, int] = {}
        self.rows = np.zeros((1024, len(languages)), np.float32)
        self.sizes = np.zeros(1024, np.int64)

    def __reduce__(self):
        return Model, (self.languages, self.table, self.unseen, self.scripts)

    def score(self, word: str) -> np.ndarray:
        """Scores per language, 0 for the best; at most 8 grams' worth, so that one word cannot outvote a text."""
        found = grams(word)
        total = np.zeros(len(self.languages))
        for gram in found:
            total += self.table.get(gram, self.unseen)
        total *= min(8, len(found)) / len(found)
        allowed = self.scripts.get(script(word))
        if allowed is None:
            return np.zeros(len(self.languages))
        total = np.where(allowed, total, -np.inf)
        return np.maximum(total - total.max(), -30.0)

    def _score_alike(self, words: list[str]) -> np.ndarray:
        """As ``score``, for lower-case words of one length at once: hashes of all grams probe the sorted table."""
        n = len(words[0])
        codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n + 2).astype(np.uint64) + np.uint64(1)
        total, number = np.zeros((len(words), len(self.languages))), 0
        for size in (1, 2, 3, 4):
            part = codes[:, 1:-1] if size == 1 else codes
            wide = part.shape[1] - size + 1
            if wide < 1:
                continue
            key = np.zeros((len(words), wide), np.uint64)
            for k in range(size):
                key = key * np.uint64(MULTIPLIER) + part[:, k:k + wide]
            at = np.minimum(np.searchsorted(self.keys, key.ravel()), len(self.keys) - 1)
            line = np.where(self.keys[at] == key.ravel(), at, len(self.keys))
            total += self.lines[line].reshape(len(words), wide, -1).sum(axis=1)
            number += wide
        total *= min(8, number) / number
        scripts = np.searchsorted(_STARTS, codes[:, 1].astype(np.int64) - 1, side="right") - 1
        allowed = self.allowed[scripts]
        total = np.where(allowed, total, -np.inf)
        best = total.max(axis=1, keepdims=True)
        return np.where(np.isfinite(best), np.maximum(total - np.where(np.isfinite(best), best, 0), -30.0), 0.0)

    def places(self, words: list[list[str]]) -> np.ndarray:
        """Rows of the score table for all words, text after text; new words are scored by length."""
        memo = self.memo
        new: dict[int, list[str]] = {}
        for word in set(chain.from_iterable(words)).difference(memo):
            new.setdefault(len(word.lower()), []).append(word)
        for length, part in new.items():
            step = max(1, 400_000 // (length + 2))
            for begin in range(0, len(part), step):
                some = part[begin:begin + step]
                at = len(memo)
                while at + len(some) > len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                    self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
                self.rows[at:at + len(some)] = self._score_alike([w.lower() for w in some])
                self.sizes[at:at + len(some)] = [len(w) if script(w.lower()) in self.scripts else 0 for w in some]
                memo.update(zip(some, range(at, at + len(some))))
        return np.array(list(map(memo.__getitem__, chain.from_iterable(words))), np.int64)

    def label(self, texts: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray]:
        """For texts as word lists: label of each word, and letters per text and language of the words whose script a language has."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        flat = self.places([texts[i] for i in order])
        many = len(self.languages)
        best, rows = np.zeros((len(texts), many)), np.arange(len(texts))
        turns, origins = [], []
        longest = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(longest), side="left")
        for t in range(longest):
            n = active[t]
            now = self.rows[flat[offsets[:n] + t]]
            if t:
                state = best[:n]
                origin = state.argmax(axis=1)
                other = state[rows[:n], origin] - SWITCH
                turn = other[:, None] > state
                best[:n] = np.where(turn, other[:, None], state) + now
                turns.append(turn)
                origins.append(origin)
            else:
                best[:n] = now
        labels, current = np.zeros(len(flat), np.int64), np.zeros(len(texts), np.int64)
        final = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            n = active[t]
            ended = lengths[:n] == t + 1
            current[:n][ended] = final[:n][ended]
            labels[offsets[:n] + t] = current[:n]
            if t:
                turn = turns[t - 1][rows[:n], current[:n]]
                current[:n] = np.where(turn, origins[t - 1], current[:n])
        owner = np.repeat(np.arange(len(texts)), lengths)
        letters = np.bincount(owner * many + labels, weights=self.sizes[flat] if len(flat) else None, minlength=len(texts) * many).reshape(len(texts), many)
        back, counted = [np.empty(0, np.int64)] * len(texts), np.zeros((len(texts), many))
        for k, i in enumerate(order):
            back[i] = labels[offsets[k]:offsets[k] + lengths[k]]
            counted[i] = letters[k]
        return back, counted


def learn(docs: DataFrame, keep: Column) -> Model | None:
    """The model from the sample of documents where ``keep`` holds and the language is known."""
    # At most SAMPLE rows of each language leave a task, and as many are broadcast.
    by_hash = Window.partitionBy("known").orderBy(F.xxhash64("id"), "id")
    chosen = (docs.where(keep & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").alias("id"), F.col("lang").alias("known"))
              .distinct().withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= SAMPLE).drop("place"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts: dict[str, Counter] = {}
            for text, lang in zip(frame["text"], frame["lang"]):
                counter = counts.setdefault(lang, Counter())
                for word, n in Counter(LETTERS.findall(text.lower())).items():
                    for gram in grams(word):
                        counter[gram] += n
                    counter["#" + script(word)] += n * len(word)
            rows = [(lang, gram, n) for lang, counter in counts.items() for gram, n in counter.items()]
            yield pd.DataFrame(rows, columns=["lang", "gram", "n"])

    rows = docs.where(keep).select("doc_id", "text", "lang").join(F.broadcast(chosen), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("known"))).where("text is not null")
    counted = kept_table(rows.select("text", "lang").mapInPandas(count, "lang string, gram string, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n")), "grams")
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    if not languages:
        return None
    is_script = F.startswith("gram", F.lit("#"))
    often = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    most = max(LEAST_GRAMS, MOST_GRAMS // len(languages))
    best = counted.where(~is_script).withColumn("place", F.row_number().over(often)).where(F.col("place") <= most).select("gram").distinct()
    usual = counted.where(is_script).unionByName(counted.where(~is_script).join(best, "gram", "left_semi"))
    found = usual.groupBy("gram").agg(F.collect_list(F.struct("lang", "n")).alias("each")).orderBy("gram").collect()
    at = {lang: i for i, lang in enumerate(languages)}
    table, scripts = {}, {}
    for row in found:
        line = np.zeros(len(languages))
        for e in row["each"]:
            line[at[e["lang"]]] = e["n"]
        (scripts if row["gram"].startswith("#") else table)[row["gram"].removeprefix("#")] = line
    total = sum(table.values(), np.zeros(len(languages))) + SMOOTHING * (len(table) + 1)
    written = sum(scripts.values(), np.zeros(len(languages)))
    usable = {name: line >= LEAST_SHARE * np.maximum(written, 1) for name, line in scripts.items()}
    return Model(languages, {g: np.log((line + SMOOTHING) / total) for g, line in table.items()}, np.log(SMOOTHING / total),
                 {name: ok for name, ok in usable.items() if ok.any()})


def _spans(text: str, labels: np.ndarray, languages: list[str]) -> list[tuple[int, int, str]]:
    """(start, end, language) of runs of words with one label, in code points."""
    out: list[list] = []
    for match, label in zip(LETTERS.finditer(text), labels):
        if out and out[-1][2] == label:
            out[-1][1] = match.end()
        else:
            out.append([match.start(), match.end(), label])
    return [(a, b, languages[k]) for a, b, k in out]


def identify(docs: DataFrame, keep: Column) -> DataFrame:
    """(doc_id, lang_pred, score, spans): learned where ``keep`` holds, predicted for every row. Score: the language's share of the letters."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, keep))

    def predict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for frame in frames:
            # Texts of like length together: a group takes as many steps as its longest text has words.
            frame = frame.iloc[np.argsort(-frame["text"].str.len().fillna(0).to_numpy(np.int64), kind="stable")]
            texts = frame["text"].tolist()
            ids = frame["doc_id"].to_numpy()
            begin = 0
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and (end == begin or chars + len(texts[end] or "") <= CHUNK_CHARS):
                    chars += len(texts[end] or "")
                    end += 1
                part = [t or "" for t in texts[begin:end]]
                words = [LETTERS.findall(t) for t in part]
                langs, scores, spans = ["und"] * len(part), [0.0] * len(part), [[] for _ in part]
                if model is not None:
                    labels, letters = model.label(words)
                    for i, text in enumerate(part):
                        if words[i]:
                            k = int(letters[i].argmax())
                            langs[i], scores[i] = model.languages[k], float(letters[i][k] / sum(map(len, words[i])))
                            spans[i] = _spans(text, labels[i], model.languages) if scores[i] < 1 else [(text.index(words[i][0]), text.rindex(words[i][-1]) + len(words[i][-1]), langs[i])]
                yield pd.DataFrame({"doc_id": ids[begin:end], "lang_pred": langs, "score": scores,
                                    "spans": [[{"start": a, "end": b, "lang": c} for a, b, c in s] for s in spans]})
                begin = end

    return docs.select("doc_id", "text").mapInPandas(predict, "doc_id long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
