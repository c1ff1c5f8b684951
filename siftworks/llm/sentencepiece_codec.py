"""SentencePiece encoding and decoding: a batched Viterbi lattice in numpy.

Words of equal length advance together. Hashes of their substrings probe the sorted keys of the pieces; at each position the best
way to end there is a vectorised maximum over piece lengths, and backpointers give the pieces. Unigram models add up piece scores. In
models whose scores are merge ranks, a step is open only where the piece may follow the one before it (merging the two
alone leaves them apart); a sequence whose neighbours all may is the one that merging gives, so the lattice has one open path and the
ids are those of the merge procedure. Few or very long words take the same steps one at a time.

Characters without a piece become their bytes, or the unknown piece where the model has no byte pieces. Decoding joins the pieces.

Defined cases. Null or empty text: no ids, decoded "". The character U+2581 stands for a blank in pieces, so it comes back as a blank; all
else comes back unchanged where the model has byte pieces. Repeated rows: each its own, equal ids. Empty table: no rows. Other
columns are not read, and are kept as they are where rows are asked for.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from siftworks.llm.common import fresh

BLANK = "▁"
MULTIPLIER = 0x9E3779B97F4A7C15
# Words remembered in each of two generations, slots of the table of pairs, slots of the filter before the sorted keys (powers of two).
MEMO_WORDS = 150_000
PAIR_BITS, FILTER_BITS = 21, 21
FEW_WORDS, LONG_WORD = 8, 64
CHUNK_CHARS = 1_500_000
_SEGMENT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_WRAP = (1 << 64) - 1


def _hash(text: str) -> int:
    value = 0
    for c in text:
        value = (value * MULTIPLIER + ord(c) + 1) & _WRAP
    return value


def _whole(part: str) -> str:
    """The part with its first blank; the mark of a part without one goes."""
    return part[1:] if part[:1] == "\0" else BLANK + part


@dataclass
class Vocabulary:
    """Pieces with ids, scores and byte ids; the tables of the lattice are made once per worker."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    byte_ids: list[int]
    unknown: int
    prefix: bool
    ranked: bool
    # Ids of words as 32-bit numbers, so that a text is joined from them.
    memo: dict[str, bytes] = field(default_factory=dict, repr=False)
    older: dict[str, bytes] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.normal[i]}
        self.longest = max(map(len, self.ids), default=1)
        keys = np.array([_hash(p) for p in self.ids], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(list(self.ids.values()), np.int64)[order]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces have the same hash")
        # A slot holds one of its keys; slots of several keys are marked.
        slots = self._slot(self.keys)
        uses = np.bincount(slots, minlength=1 << FILTER_BITS)
        self.filter, self.shared, self.key_at = uses > 0, uses > 1, np.zeros(1 << FILTER_BITS, np.int32)
        self.key_at[slots] = np.arange(len(slots))
        # Pairs that were tried: a slot holds the pair that was last put there, and whether the second may follow the first.
        self.pair_keys, self.pair_open = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)
        self.score = np.array(self.scores, np.float64)
        self.unknown_score = (min((self.scores[i] for i in self.ids.values()), default=0.0)) - 10.0
        self.lengths = sorted({len(p) for p in self.ids})
        self.apart = not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        self.bytes = [p.replace(BLANK, " ").encode("utf-8", "surrogatepass") if n else b"" for p, n in zip(self.pieces, self.normal)]
        for value, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([value])
        if 0 <= self.unknown < len(self.bytes):
            self.bytes[self.unknown] = " ⁇ ".encode()
        self.multi = {c for p in self.ids for c in p if len(p) > 1 and c not in self.ids}

    def __reduce__(self):
        return Vocabulary, (self.pieces, self.scores, self.normal, self.byte_ids, self.unknown, self.prefix, self.ranked)

    # A character without a piece is numbered behind the pieces by its code point.
    def text_of(self, piece: int) -> str:
        return self.pieces[piece] if piece < len(self.pieces) else chr(piece - len(self.pieces))

    def merge(self, text: str) -> list[str]:
        """The merge procedure: the adjacent pair whose joint piece scores best is joined first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, before: int, piece: int) -> bool:
        """Whether the piece may stand behind another (before: -1 at a word's start)."""
        right = self.text_of(piece)
        if before < 0:
            return self.merge(right) == [right]
        left = self.text_of(before)
        return self.merge(left + right) == [left, right]

    def _follow(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        keys = (before + 1) * 0x400000 + piece
        slots = ((keys.astype(np.uint64) * np.uint64(MULTIPLIER)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        found = self.pair_open[slots]
        new = np.flatnonzero(self.pair_keys[slots] != keys)
        if len(new):
            tried, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            fresh_ones = np.array([self.follows((k >> 22) - 1, k & 0x3FFFFF) for k in tried.tolist()], bool)
            found[new] = fresh_ones[back]
            self.pair_keys[slots[new][first]], self.pair_open[slots[new][first]] = tried, fresh_ones
        return found

    def _follows_one(self, before: int, piece: int) -> bool:
        key = (before + 1) * 0x400000 + piece
        slot = ((key * MULTIPLIER) & _WRAP) >> (64 - PAIR_BITS)
        if self.pair_keys[slot] != key:
            self.pair_open[slot], self.pair_keys[slot] = self.follows(before, piece), key
        return bool(self.pair_open[slot])

    def _one(self, word: str) -> list[int]:
        """The lattice of a single word."""
        n = len(word)
        total, last, back = [0.0] + [-np.inf] * n, [-1] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            for p in range(min(self.longest, i), 0, -1):
                if total[i - p] == -np.inf:
                    continue
                piece = self.ids.get(word[i - p:i])
                if piece is None:
                    if p > 1:
                        continue
                    piece, gain = len(self.pieces) + ord(word[i - 1]), self.unknown_score
                else:
                    gain = self.scores[piece]
                if total[i - p] + gain > total[i] and (not self.ranked or self._follows_one(last[i - p], piece)):
                    total[i], last[i], back[i] = total[i - p] + gain, piece, p
        out, i = [], n
        while i:
            out.append(last[i])
            i -= back[i]
        return out[::-1]

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        # The first bits of short pieces are all zero; the product spreads them.
        return ((key * np.uint64(MULTIPLIER)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def _find(self, key: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the sorted keys, and whether the key is there; slots of several keys are searched."""
        at = self.key_at[slot]
        hit = self.keys[at] == key
        more = np.flatnonzero(~hit & self.shared[slot])
        if len(more):
            at[more] = np.minimum(np.searchsorted(self.keys, key[more]), len(self.keys) - 1)
            hit[more] = self.keys[at[more]] == key[more]
        return at, hit

    def _paths(self, words: list[str]) -> np.ndarray:
        """The lattices of words of one length, advanced together: a row of pieces for each word, -1 where there is none."""
        n = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n).T.astype(np.uint64, order="C")
        # One row per position, so that what a step reads and writes lies together.
        prefix = np.zeros((n + 1, len(words)), np.uint64)
        power = [np.uint64(pow(MULTIPLIER, i, 1 << 64)) for i in range(n + 1)]
        for i in range(n):
            prefix[i + 1] = prefix[i] * np.uint64(MULTIPLIER) + codes[i] + np.uint64(1)
        total = np.full((n + 1, len(words)), -np.inf)
        total[0] = 0
        last = np.full((n + 1, len(words)), -1, np.int64)
        back = np.zeros((n + 1, len(words)), np.int64)
        every = np.arange(len(words))
        for i in range(1, n + 1):
            for p in reversed([p for p in self.lengths if p <= i] or [1]):
                key = prefix[i] - prefix[i - p] * power[p]
                slot = self._slot(key)
                if p == 1:
                    rows = every
                else:
                    rows = np.flatnonzero(self.filter[slot])
                    if not len(rows):
                        continue
                    key, slot = key[rows], slot[rows]
                at, hit = self._find(key, slot)
                if p == 1:
                    piece = np.where(hit, self.key_ids[at], len(self.pieces) + codes[i - 1].astype(np.int64))
                    gain = np.where(hit, self.score[self.key_ids[at]], self.unknown_score)
                else:
                    rows, piece = rows[hit], self.key_ids[at[hit]]
                    gain = self.score[piece]
                value = total[i - p][rows] + gain
                better = value > total[i][rows]
                rows, piece, value = rows[better], piece[better], value[better]
                if self.ranked and len(rows):
                    may = self._follow(last[i - p][rows], piece)
                    rows, piece, value = rows[may], piece[may], value[may]
                total[i][rows], last[i][rows], back[i][rows] = value, piece, p
        path = np.full((len(words), n), -1, np.int64)
        where, rows = np.full(len(words), n), every
        for place in range(n - 1, -1, -1):
            path[rows, place] = last[where[rows], rows]
            where[rows] -= back[where[rows], rows]
            rows = rows[where[rows] > 0]
            if not len(rows):
                break
        return path

    def _same_length(self, words: list[str]) -> list[list[int]]:
        """The pieces of words of one length."""
        return [row[row >= 0].tolist() for row in self._paths(words)]

    def _ids(self, words: list[str]) -> list[bytes]:
        """The ids of words of one length; only words with a character that has no piece are gone through."""
        path = self._paths(words)
        taken = path >= 0
        raw, ends = path[taken].astype(np.int32).tobytes(), (4 * np.cumsum(taken.sum(axis=1))).tolist()
        found = [raw[a:b] for a, b in zip([0, *ends], ends)]
        for k in np.flatnonzero((path >= len(self.pieces)).any(axis=1)).tolist():
            found[k] = self._final(path[k][taken[k]].tolist())
        return found

    def _final(self, pieces: list[int]) -> bytes:
        """The ids of pieces, with those of characters that have none."""
        out: list[int] = []
        for piece in pieces:
            if piece < len(self.pieces):
                out.append(piece)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in chr(piece - len(self.pieces)).encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, np.int32).tobytes()

    def segments(self, text: str) -> list[str]:
        """Parts that no piece crosses, each without its first blank; a part that has no blank in front is marked by a null."""
        if not self.apart:
            whole = (BLANK if self.prefix else "") + text.replace(" ", BLANK)
            return [whole[1:] if whole[:1] == BLANK else "\0" + whole]
        if self.prefix and text[0] != " " and text[-1] != " " and "  " not in text and BLANK not in text and "\0" not in text:
            return text.split(" ")
        parts = _SEGMENT.findall((BLANK if self.prefix else "") + text.replace(" ", BLANK))
        return [p[1:] if p[0] == BLANK else "\0" + p for p in parts]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; words that are not remembered are put through the lattice by length."""
        split = [self.segments(t) if t else [] for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        lengths: dict[int, list[str]] = {}
        for word in set(chain.from_iterable(split)).difference(memo):
            known = older.get(word)
            if known is None:
                lengths.setdefault(len(word) + (word[:1] != "\0"), []).append(word)
            else:
                memo[word] = known
        for length, words in lengths.items():
            if len(words) < FEW_WORDS or length > LONG_WORD:
                for word in words:
                    memo[word] = self._final(self._one(_whole(word)))
            else:
                for begin in range(0, len(words), 20_000):
                    part = words[begin:begin + 20_000]
                    memo.update(zip(part, self._ids([_whole(w) for w in part])))
        return [np.frombuffer(b"".join(map(memo.__getitem__, words)), np.int32) for words in split]

    def forget(self) -> None:
        """Give up the remembered words."""
        self.memo, self.older = {}, {}

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


def load_vocabulary(path: str) -> Vocabulary:
    """Read a model file on the driver (a bounded table: the vocabulary)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces, scores = [model.id_to_piece(i) for i in range(size)], [model.get_score(i) for i in range(size)]
    normal = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(size)]
    by_byte = {int(pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
    # Merge models have whole numbers, the negated ranks, as scores; unigram models logarithms of probabilities.
    ranked = all(float(scores[i]).is_integer() for i in range(size) if normal[i])
    return Vocabulary(pieces, scores, normal, [by_byte[b] for b in range(256)] if len(by_byte) == 256 else [], model.unk_id(),
                      model.decode(model.encode("a")) == "a" and model.id_to_piece(model.encode("a")[0]).startswith(BLANK), ranked)


def encode_documents(docs: DataFrame, path: str, rows: bool = False) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip) of every document; with ``rows`` the columns of ``docs`` and the other three."""
    vocabulary = load_vocabulary(path)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    source = docs if rows else docs.select("doc_id", "text")
    ids_name, number, same = fresh(source, "ids", "n_tokens", "round_trip")

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = sent.value
        gc.disable()  # the memory of words is large and has no cycles
        try:
            for frame in frames:
                texts, begin = frame["text"].tolist(), 0
                while begin < len(texts):
                    end, chars = begin, 0
                    while end < len(texts) and (end == begin or chars + len(texts[end] or "") <= CHUNK_CHARS):
                        chars += len(texts[end] or "")
                        end += 1
                    found = vocabulary.encode(texts[begin:end])
                    part = frame.iloc[begin:end] if rows else frame.iloc[begin:end][["doc_id"]]
                    yield part.assign(**{ids_name: found, number: [len(f) for f in found],
                                         same: [vocabulary.decode(f.tolist()) == (t or "") for f, t in zip(found, texts[begin:end])]})
                    begin = end
        finally:  # the worker goes on with other tasks
            vocabulary.forget()
            gc.enable()

    names = source.columns if rows else ["doc_id"]
    schema = ", ".join(f"`{n}` {source.schema[n].dataType.simpleString()}" for n in names) + f", {ids_name} array<int>, {number} long, {same} boolean"
    return source.mapInPandas(encode, schema)


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The text of every id list: the table with a column ``decoded`` (under a free name); null ids: null."""
    sent = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    name = fresh(encoded, "decoded")[0]

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(**{name: [None if i is None else sent.value.decode(i.tolist()) for i in frame[ids]]})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + f", {name} string"
    return encoded.mapInPandas(decode, schema)
