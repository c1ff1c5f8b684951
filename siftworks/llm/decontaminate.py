"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared as lower-case words joined by single blanks. An item of m characters may differ by
``percent * m // 100`` = k edits. Cut into k + 1 pieces, at least one piece occurs unchanged in every text that holds the item; one
automaton finds all pieces of all items in one pass over a text. Hits of an item on neighbouring diagonals are one window, which Myers'
bit-parallel distance verifies. Items are sent to the tasks in batches of bounded size, one pass over the texts for each.

Defined cases. Null or empty texts match nothing; null and empty items are not looked for. Items whose budget is 0, being short, are
found unchanged, from word boundary to word boundary; in scripts without blanks each letter is its own
boundary. Items without letters and digits are found as they are written, white space aside, by an automaton of their own. ``decontaminate`` needs no item_id;
``edit_matches`` names items by it, so rows without one have no match to give. Items with equal words are reported each. Repeated rows: each its own, equal matches. Empty tables:
no rows. Ties of the distance: the first place in the text. Other columns are not read, unless rows are asked for.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERCENT = 6
# Characters of items that are sent to the tasks at once.
BATCH_CHARS = 8_000_000

_TOKEN = re.compile(r"[^\W_]+")
# Fixed value: letters of scripts that put no blanks between words (Thai to Myanmar, Khmer, kana, Han).
_UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def plain(text: str | None) -> str:
    return " ".join(_TOKEN.findall(text)).lower() if text else ""


def written(text: str | None) -> str:
    return " ".join(text.split()) if text else ""


def on_boundaries(text: str, start: int, end: int) -> bool:
    """Whether a place of a plain text begins and ends where words may."""
    return all(at in (0, len(text)) or " " in text[at - 1:at + 1] or _UNSPACED.search(text[at - 1:at + 1]) is not None for at in (start, end))


def budget(length: int, percent: int) -> int:
    return percent * length // 100


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length with their offsets."""
    edges = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def myers(pattern: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """(least distance, first end) of the pattern in the text; anchored: at the text's start only."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | (1 << i)
    plus, minus, score, best, end = full, 0, m, m, 0
    for at, c in enumerate(text, 1):
        same = where.get(c, 0)
        vertical = same | minus
        horizontal = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up = ((up << 1) | anchored) & full
        down = (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, at
    return best, end


class Items:
    """The automaton of all pieces of a batch of items."""

    def __init__(self, rows: list[tuple[int, str]], percent: int):
        self.ids: dict[str, list[int]] = {}
        self.signs: dict[str, list[int]] = {}
        for item_id, text in rows:
            if plain(text):
                self.ids.setdefault(plain(text), []).append(item_id)
            elif written(text):
                self.signs.setdefault(written(text), []).append(item_id)
        self.texts = list(self.ids)
        self.budgets = [budget(len(t), percent) for t in self.texts]
        held: dict[str, list[tuple[int, int]]] = {}
        for i, text in enumerate(self.texts):
            for offset, piece in pieces(text, self.budgets[i]):
                held.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in held.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()
        self.sign_automaton = ahocorasick.Automaton()
        for item in self.signs:
            self.sign_automaton.add_word(item, item)
        self.sign_automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end) of each item within its budget, at its best place in the plain text."""
        if not self.texts or not text:
            return
        diagonals: dict[int, set[int]] = {}
        for last, (length, places) in self.automaton.iter(text):
            for i, offset in places:
                diagonals.setdefault(i, set()).add(last + 1 - length - offset)
        for i in sorted(diagonals):
            item, k, best = self.texts[i], self.budgets[i], None
            starts = sorted(diagonals[i])
            exact = next((s for s in starts if s >= 0 and text.startswith(item, s) and (k > 0 or on_boundaries(text, s, s + len(item)))), None)
            if exact is not None:
                yield i, 0, exact, exact + len(item)
                continue
            if not k:
                continue
            begin = 0
            for j in range(1, len(starts) + 1):
                if j < len(starts) and starts[j] - starts[j - 1] <= 2 * k:
                    continue
                low, high = max(0, starts[begin] - k), starts[j - 1] + len(item) + k
                begin = j
                distance, end = myers(item, text[low:high])
                if distance <= k and (best is None or distance < best[0]):
                    _, back = myers(item[::-1], text[low:low + end][::-1], True)
                    best = (distance, low + end - back, low + end)
            if best is not None:
                yield i, *best

    def find_signs(self, text: str | None) -> Iterator[tuple[str, int, int]]:
        """(item, start, end) of each item without letters and digits at its first place in the text as written."""
        if not self.signs or not text:
            return
        first: dict[str, int] = {}
        for last, item in self.sign_automaton.iter(written(text)):
            first.setdefault(item, last + 1 - len(item))
        if not first:
            return
        words = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
        begins = list(accumulate((b - a + 1 for a, b in words), initial=0))
        for item in sorted(first):
            start, last = first[item], first[item] + len(item) - 1
            i, j = bisect.bisect_right(begins, start) - 1, bisect.bisect_right(begins, last) - 1
            yield item, words[i][0] + start - begins[i], words[j][0] + last - begins[j] + 1

    def holds(self, text: str | None) -> bool:
        return next(self.find(plain(text)), None) is not None or next(self.find_signs(text), None) is not None


def _original(text: str, start: int, end: int) -> tuple[int, int]:
    """Code points of the text that the plain positions stand for."""
    at, first, last = 0, None, 0
    for match in _TOKEN.finditer(text):
        length = len(match[0].lower())
        if at + length > start and first is None:
            first = match.start() + max(0, start - at)
        if at < end:
            last = min(match.end(), match.start() + end - at)
        at += length + 1
    return first or 0, last


def _batches(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in batches of at most about BATCH_CHARS characters."""
    items = benchmark.where("text is not null").select("item_id", "text")
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    number = total // BATCH_CHARS + 1
    for part in range(number):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == part).distinct().orderBy("item_id", "text").collect()]


def edit_matches(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, distance, budget, start, end): each item that a text holds, at its best place (code points of the text)."""
    found = None
    for rows in _batches(benchmark.where("item_id is not null")):
        sent = docs.sparkSession.sparkContext.broadcast(rows)

        def match(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            items = Items(sent.value, percent)
            for frame in frames:
                out = []
                for doc_id, text in zip(frame["doc_id"], frame["text"]):
                    for i, distance, start, end in items.find(plain(text)):
                        a, b = _original(text, start, end)
                        out += [(doc_id, item_id, distance, items.budgets[i], a, b) for item_id in items.ids[items.texts[i]]]
                    for item, a, b in items.find_signs(text):
                        out += [(doc_id, item_id, 0, 0, a, b) for item_id in items.signs[item]]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "distance", "budget", "start", "end"])

        part = docs.select("doc_id", "text").mapInPandas(match, "doc_id long, item_id long, distance long, budget long, start long, end long")
        found = part if found is None else found.unionByName(part)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item."""
    for rows in _batches(benchmark.select(F.lit(None).cast("long").alias("item_id"), "text")):
        sent = docs.sparkSession.sparkContext.broadcast(rows)

        def clean(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            items = Items(sent.value, percent)
            for frame in frames:
                yield frame[np.array([not items.holds(t) for t in frame["text"]], bool)]

        docs = docs.mapInPandas(clean, docs.schema)
    return docs
