"""Collocations: frequent phrases of each language, found by mergeable Misra-Gries summaries and counted exactly in a second pass.

First pass: every block counts its n-grams and deals them by hash to slices, counts beside keys. A slice merges the counts of
its blocks in a Misra-Gries summary of more counters than its mass divided by the threshold: all that it takes off any counter is then
less than the threshold, so every phrase that occurs that often keeps a counter, and one whose counter and what was taken off stay
below it goes. Keys of equal hash share a counter, which can only keep a phrase more. Second pass: each block counts the phrases
whose keys are left, word by word, and the counts are summed, again slice by slice.

A phrase is scored at its weakest cut: ``1000 * f(phrase) * n / (f(first) * f(rest))``, the division in decimals of 38 digits. Its
parts occur at least as often as it does, so they are among the counted ones. A phrase goes when a longer one occurs as often; the
phrases between the two then occur as often as well, so it is enough to look one word further.

Within a block phrases are told apart by two hashes of 64 bits, between blocks by their words.

Defined cases. Null text: empty. Null lang: ``und``. Repeated rows count as often as they stand. Texts without words: nothing.
Ties in the ranking end with the phrase in byte order, which is unique in its language. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftworks.llm.blocks import key_bytes, keys_from, packed, slices_for, starts_of, text_blocks, unpacked
from siftworks.llm.common import kept_table, mix

# Fixed values of the contract: pieces end at the characters .,;:!? and from line feed to carriage return, words at blanks and tabs.
WORD, BLANK, STOP = 0, 1, 2
# Between two texts stands a byte that no text has in UTF-8.
BETWEEN = b"\xff"
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = BLANK
KIND[list(b".,;:!?\n\x0b\x0c\r" + BETWEEN)] = STOP
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MOST_WORDS = 5
UNKNOWN = "und"

# Groups that the word counts of the languages are summed in, before they meet.
TOTALS = 64
# Languages whose word counts may be sent to the tasks; beyond, they are joined by key.
MOST_LANGUAGES = 10_000
# Entries that are added to a summary at once, beside those it holds.
MERGED_AT_ONCE = 1 << 20


class Summary:
    """A Misra-Gries summary: counters of at most ``capacity`` keys, and what has been taken off all of them."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, taken: int = 0) -> None:
        """Add counters; the largest that finds no room is taken off all of them, each time from more than ``capacity`` keys."""
        both = np.concatenate([self.keys, keys])
        self.keys, at = np.unique(both, return_inverse=True)
        self.counts = np.bincount(at, np.concatenate([self.counts, counts]), len(self.keys)).astype(np.int64)
        self.taken += taken
        if len(self.keys) > self.capacity:
            least = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            self.taken += least
            left = self.counts > least
            self.keys, self.counts = self.keys[left], self.counts[left] - least

    def may_reach(self, threshold: int) -> np.ndarray:
        """Ascending keys that may occur so often; all that do are among them as long as less than the threshold was taken off."""
        if self.taken >= threshold:
            raise ValueError("the summary has too few counters for the threshold")
        return self.keys[self.counts + self.taken >= threshold]


class Phrases:
    """The words of a block's texts as arrays: where they begin and end, their pieces and languages, and two hashes of each."""

    def __init__(self, labels, sizes, body: bytes):
        text, at = unpacked(body), starts_of(sizes).tolist()
        self.text = BETWEEN.join([text[a:b] for a, b in zip(at[:-1], at[1:])]).translate(LOWER)
        each = np.frombuffer(self.text, np.uint8)
        kind = KIND[each]
        edge = np.diff((kind == WORD).view(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.begin, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == STOP, dtype=np.int32)[self.begin]
        names = [UNKNOWN if name is None else name for name in labels]
        self.langs = sorted(set(names))
        place = {name: i for i, name in enumerate(self.langs)}
        self.lang = np.array([place[name] for name in names], np.int32)[np.cumsum(each == BETWEEN[0], dtype=np.int32)[self.begin]]
        length = self.end - self.begin
        letters = each[kind == WORD]
        first = np.cumsum(length) - length
        in_word = np.arange(len(letters)) - np.repeat(first, length)
        self.word = [self._hashed(letters, in_word, first, length, base) for base in BASES]

    @staticmethod
    def _hashed(letters: np.ndarray, in_word: np.ndarray, first: np.ndarray, length: np.ndarray, base: int) -> np.ndarray:
        """Polynomials over the bytes of each word, modulo the word of the machine."""
        if not len(first):
            return np.empty(0, np.uint64)
        powers = np.full(int(length.max()), base, np.uint64)
        powers[0] = 1
        values = mix(np.arange(256, dtype=np.uint64) + np.uint64(base))[letters] * np.cumprod(powers)[in_word]
        return mix(np.add.reduceat(values, first) + length.astype(np.uint64))

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first word and length of every phrase in the pieces."""
        n, found = len(self.begin), []
        if not n:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int8)
        tongue = np.array([xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) for name in self.langs], np.uint64)
        state = tongue[self.lang]
        for k in range(min(n, MOST_WORDS)):
            state = mix(state[:n - k] * np.uint64(0x9E3779B97F4A7C15) + self.word[0][k:])
            whole = np.flatnonzero(self.piece[:n - k] == self.piece[k:])
            found.append((state[whole], whole, np.full(len(whole), k + 1, np.int8)))
        return tuple(np.concatenate(part) for part in zip(*found))

    def counted(self, hashes: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct phrases among those given, by hash and by a second hash of their words: hash, first word, length, count."""
        second = length.astype(np.uint64)
        for k in range(MOST_WORDS):
            more = length > k
            second[more] = mix(second[more] * np.uint64(0x9E3779B97F4A7C15) + self.word[1][at[more] + k])
        order = np.lexsort((second, hashes))
        new = np.append(True, (np.diff(hashes[order]) > 0) | (np.diff(second[order]) != 0))[:len(order)]
        begin = np.flatnonzero(new)
        first = order[begin]
        return hashes[first], at[first], length[first], np.diff(np.append(begin, len(order)))

    def phrase(self, at: int, length: int) -> tuple[str, str]:
        words = [self.text[a:b] for a, b in zip(self.begin[at:at + length].tolist(), self.end[at:at + length].tolist())]
        return self.langs[self.lang[at]], b" ".join(words).decode("utf-8", "surrogatepass")


def slice_bits(keys: int | None) -> int:
    """Slices are ranges of the hash, a power of two of them."""
    return (slices_for(keys) - 1).bit_length()


def _cells(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending hashes as ascending keys of 32 bits in their slices: the slices that have any, where each begins (with the end), keys."""
    have, begin = np.unique(hashes >> np.uint64(64 - bits), return_index=True)
    return have.astype(np.int64), np.append(begin, len(hashes)), (hashes << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)


def _first_pass(bits: int):
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, labels, sizes, body in zip(frame["block"], frame["labels"], frame["sizes"], frame["body"]):
                hashes, counts = np.unique(Phrases(labels, sizes, body).grams()[0], return_counts=True)
                have, begin, keys = _cells(hashes, bits)
                counts, pack = counts.astype(np.uint32), zstandard.ZstdCompressor(level=1).compress
                yield pd.DataFrame({"slice": have, "block": block, "keys": [key_bytes(keys[a:b]) for a, b in zip(begin[:-1], begin[1:])],
                                    "counts": [pack(counts[a:b].tobytes()) for a, b in zip(begin[:-1], begin[1:])]})
    return count


def _merged(threshold: int):
    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        cells = [(keys_from(k, 4), np.frombuffer(unpacked(c), np.uint32)) for k, c in zip(frame["keys"], frame["counts"])]
        mass = sum(int(counts.sum(dtype=np.int64)) for _, counts in cells)
        summary, held, size = Summary(mass // threshold + 1), [], 0
        for cell in cells:
            held.append(cell)
            size += len(cell[0])
            if size >= MERGED_AT_ONCE:
                summary.merge(*(np.concatenate(part) for part in zip(*held)))
                held, size = [], 0
        if held:
            summary.merge(*(np.concatenate(part) for part in zip(*held)))
        left = summary.may_reach(threshold)
        return pd.DataFrame({"block": frame["block"], "slice": frame["slice"], "left": [key_bytes(keys[np.isin(keys, left)]) for keys, _ in cells]})
    return merge


def _second_pass(bits: int):
    def count(frame: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        row = next(frame.itertuples())
        phrases = Phrases(row.labels, row.sizes, row.body)
        grams, at, length = phrases.grams()
        # Slice and key of what is left, first in a table of bits that most n-grams miss, then exactly.
        cell = np.uint64(32 - bits)
        left = np.concatenate([np.empty(0, np.uint64), *[(np.uint64(s) << np.uint64(32) | keys_from(k, 4)) for s, k in zip(answer["slice"], answer["left"])]])
        left.sort()
        seen, low = np.zeros(1 << 22, bool), np.uint64((1 << 22) - 1)
        seen[left & low] = True
        asked = grams >> cell
        maybe = np.flatnonzero(seen[asked & low])
        known = left[np.minimum(np.searchsorted(left, asked[maybe]), len(left) - 1)] == asked[maybe] if len(left) else np.empty(0, bool)
        hashes, first, size, counts = phrases.counted(*(part[maybe[known]] for part in (grams, at, length)))
        words = np.bincount(phrases.lang, minlength=len(phrases.langs))
        out = [(-1 - row.block % TOTALS, packed([json.dumps([(name, "", 0, int(n)) for name, n in zip(phrases.langs, words) if n]).encode()]))]
        found = [(*phrases.phrase(i, k), k, n) for i, k, n in zip(first.tolist(), size.tolist(), counts.tolist())]
        have, begin, _ = _cells(hashes, bits)
        out += [(s, packed([json.dumps(found[a:b]).encode()])) for s, a, b in zip(have.tolist(), begin[:-1], begin[1:])]
        return pd.DataFrame(out, columns=["slice", "counted"])
    return count


def _summed(threshold: int):
    def total(frame: pd.DataFrame) -> pd.DataFrame:
        sums = {}
        for body in frame["counted"]:
            for lang, phrase, words, n in json.loads(unpacked(body)):
                sums[lang, phrase, words] = sums.get((lang, phrase, words), 0) + n
        return pd.DataFrame([(*key, n) for key, n in sums.items() if n >= threshold or not key[2]], columns=["lang", "phrase", "words", "f"])
    return total


def phrase_counts(docs: DataFrame, threshold: int = 100) -> DataFrame:
    """(lang, phrase, words, f) of the phrases of up to five words that occur at least ``threshold`` times, and per language all words (words 0)."""
    if threshold < 1:
        raise ValueError("a phrase occurs once at least")
    blocks = text_blocks(docs, "lang")
    # Fewer n-grams than bytes: a word and its blank have some six bytes, and five n-grams at most begin with it.
    bits = slice_bits(blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0])
    asked = blocks.mapInPandas(_first_pass(bits), "slice long, block long, keys binary, counts binary")
    left = asked.groupBy("slice").applyInPandas(_merged(threshold), "block long, slice long, left binary")
    counted = blocks.groupBy("block").cogroup(left.groupBy("block")).applyInPandas(_second_pass(bits), "slice long, counted binary")
    summed = counted.groupBy("slice").applyInPandas(_summed(threshold), "lang string, phrase string, words long, f long")
    return kept_table(summed.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")), "phrases")


def collocations(docs: DataFrame, threshold: int = 100, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language that no longer one stands for."""
    counts = phrase_counts(docs, threshold)
    total = counts.where("words = 0").select(F.col("lang").alias("t_lang"), F.col("f").alias("n"))
    if total.limit(MOST_LANGUAGES + 1).count() <= MOST_LANGUAGES:
        total = F.broadcast(total)  # a join by few languages would be a join by hot keys
    parts = counts.where("words > 0").select("lang", "phrase", "f")
    phrases = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), (F.col("words") - 1).cast("int"))))
    split = F.split("phrase", " ", -1)
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice(split, 1, F.col("k")), " ").alias("first"),
                       F.array_join(F.slice(split, F.col("k") + 1, F.lit(MOST_WORDS)), " ").alias("rest"))
    first, rest = (parts.select(F.col("lang").alias(f"{x}_lang"), F.col("phrase").alias(f"{x}_phrase"), F.col("f").alias(x)) for x in "lr")
    cuts = (cuts.join(first, (F.col("lang") == F.col("l_lang")) & (F.col("first") == F.col("l_phrase")))
            .join(rest, (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("r_phrase")))
            .join(total, F.col("lang") == F.col("t_lang")))
    wide = [F.col(x).cast("decimal(38,0)") for x in ("a", "n", "l", "r")]
    score = F.call_function("div", F.lit(1000).cast("decimal(38,0)") * wide[0] * wide[1], wide[2] * wide[3])
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut")).select("lang", "phrase", "cut.*")

    # A phrase goes when one of one word more, which holds it, occurs as often.
    longer = phrases.where("words > 2").select("lang", "a", F.explode(F.array(
        F.array_join(F.slice(split, F.lit(1), (F.col("words") - 1).cast("int")), " "),
        F.array_join(F.slice(split, 2, MOST_WORDS), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    left = scored.join(longer, ["lang", "phrase"], "left").where("longest is null or longest < a")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return left.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
