"""Removal of long repeated strings: suffixes sorted bucket by bucket, long ties settled by the ranks of a difference cover.

A byte goes when a string of ``length`` bytes that covers it begins somewhere else, too. Suffixes are compared on their first
``length`` bytes. For any two suffixes of different phase modulo ``PERIOD`` there is one shift below ``PERIOD`` that brings both to
a position of the cover (for equal phases, all shifts of the cover do). So:

1. The sample are the positions of the cover in each document. Their cores of ``length - PERIOD + 1`` bytes are ranked; a suffix
   none of whose sample positions within ``PERIOD`` has a core that occurs twice has no equal and takes part no more. Only the
   regions that hold the others go on.
2. Ties that go on for ``length + PERIOD - 1`` bytes are settled by the sample alone: such a sample position proves the ``PERIOD``
   suffixes from it on, and only its first occurrence is sent on to the buckets.
3. The suffixes that are left go to buckets by the hash of their first ``length`` bytes, and one bucket at a time is sorted.

Buckets are ranges of a hash and not of the bytes, as only equality at that depth is asked; the core ranks of step 1 are kept in
32 bits (an error there only sends a suffix on), steps 2 and 3 use 64 bits within a bucket that other 64 bits choose.

Defined cases. Null or empty text: 0 bytes, nothing removed. Shorter texts than ``length``: kept whole. Repeated rows of a
doc_id are documents of their own, so they remove each other. A null doc_id is kept as null. Empty table: no rows. Other columns are
not read. One document is held whole by a task, with up to 16 bytes for each position that is sent on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.blocks import QUESTION, answers, in_order, key_bytes, keys_from, packed, questions, slices_for, starts_of, text_blocks, unpacked
from siftworks.llm.common import kept_table

# A perfect difference set, every shift modulo 57 is a difference of two of its members.
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)

HASHED_AT_ONCE = 1 << 16

REGIONS = "block long, origins binary, sizes array<long>, body binary"
REGION_COLUMNS = ["block", "origins", "sizes", "body"]
DOCUMENT_COLUMNS = ["doc_id", "n_bytes", "spans", "kept_sha256", "kept"]


def hashes(text: bytes, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower half of the 128-bit hashes of the strings of one length at the given positions."""
    out, digest = np.empty((len(at), 2), np.uint64), xxhash.xxh3_128_digest
    for a in range(0, len(at), HASHED_AT_ONCE):
        some = b"".join([digest(text[i:i + length]) for i in at[a:a + HASHED_AT_ONCE].tolist()])
        out[a:a + HASHED_AT_ONCE] = np.frombuffer(some, ">u8").reshape(-1, 2)
    return out[:, 0], out[:, 1]


class Distinct:
    """The distinct strings of one length at the given positions of a block."""

    def __init__(self, text: bytes, at: np.ndarray, length: int):
        upper, lower = hashes(text, at, length)
        self.lower, self.index, self.inverse, counts = np.unique(lower, return_index=True, return_inverse=True, return_counts=True)
        self.upper, self.twice = upper[self.index], counts > 1

    def ask(self, block: int, slices: int, width: int) -> Iterator[pd.DataFrame]:
        return questions(block, self.upper, self.lower, slices, width)

    def repeated(self, answer: pd.DataFrame, slices: int) -> np.ndarray:
        """For each position: does its string occur anywhere else."""
        return (self.twice | in_order(answer, "repeated", self.upper, slices))[self.inverse]

    def first(self, answer: pd.DataFrame, slices: int) -> np.ndarray:
        """For each position: is it the first occurrence of its string."""
        out = np.zeros(len(self.inverse), bool)
        out[self.index[in_order(answer, "first", self.upper, slices)]] = True
        return out


def sample(starts: np.ndarray, core: int) -> np.ndarray:
    """Positions of the cover, counted from the start of each document, that have a whole core."""
    found = [np.empty(0, np.int64)]
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= core:
            at = (np.arange(0, b - a - core + 1, PERIOD)[:, None] + np.array(COVER)).ravel()
            found.append(a + at[at <= b - a - core])
    return np.concatenate(found)


def room(at: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which positions have so many bytes up to the end of their document."""
    return at + length <= starts[np.searchsorted(starts, at, "right")]


def covered(begins: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Mask of the positions in any of the ranges."""
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, begins, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps)[:size] > 0


def runs(at: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs of bytes that strings at the sorted positions cover; runs end with their owner."""
    breaks = np.flatnonzero((np.diff(at) > length) | (np.diff(owner) > 0))
    return np.append(at[:1], at[breaks + 1]), np.append(at[breaks], at[-1:]) + length


def owners(at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.searchsorted(starts, at, "right") - 1


def may_repeat(at: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Mask of the suffixes that have one of the given sample positions within a period."""
    nearest = np.maximum(at - (PERIOD - 1), starts[owners(at, starts)])
    return covered(nearest, at + 1, int(starts[-1]))


def _long(row, tie: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Text and starts of the regions, their sample positions, and those with room for a long tie."""
    text, starts, at = unpacked(row.body), starts_of(row.sizes), keys_from(row.at, 4).astype(np.int64)
    return text, starts, at, at[room(at, starts, tie)]


def _ask_ties(tie: int, slices: int, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples():
            text, _, _, long = _long(row, tie)
            yield from Distinct(text, long, tie).ask(row.block, slices, 8)


def remove_repeats(docs: DataFrame, length: int = 200, rows: bool = False) -> DataFrame:
    """(doc_id, n_bytes, spans, kept_sha256) of each document, spans as maximal runs of removed bytes; with ``rows`` also kept, the bytes left."""
    if length < PERIOD:
        raise ValueError(f"strings of at least {PERIOD} bytes can be looked for")
    core, tie = length - PERIOD + 1, length + PERIOD - 1

    # Step 1: sample cores that occur twice; only the regions around them stay.
    blocks = text_blocks(docs, "doc_id")
    total = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0]
    core_slices = slices_for((total or 0) * len(COVER) // PERIOD)

    def ask_cores(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, sizes, body in zip(frame["block"], frame["sizes"], frame["body"]):
                yield from Distinct(unpacked(body), sample(starts_of(sizes), core), core).ask(block, core_slices, 4)

    def sift(frame: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        row, out = next(frame.itertuples()), []
        text, starts = unpacked(row.body), starts_of(row.sizes)
        at = sample(starts, core)
        at = at[Distinct(text, at, core).repeated(answer, core_slices)]
        asked = np.flatnonzero(may_repeat(at, starts, length))
        asked = asked[room(asked, starts, length)]
        begins, ends = runs(asked, owners(asked, starts), length)
        if len(begins):
            region = np.searchsorted(begins, at, "right") - 1
            inside = (region >= 0) & (at < ends[region])
            moved = (at - begins[region] + starts_of(ends - begins)[region])[inside]
            body = packed([text[a:b] for a, b in zip(begins.tolist(), ends.tolist())])
            out.append((row.block, begins.tobytes(), ends - begins, body, key_bytes(moved.astype("u4")), len(moved)))
        return pd.DataFrame(out, columns=[*REGION_COLUMNS, "at", "n_at"])

    cores = answers(blocks.mapInPandas(ask_cores, QUESTION), 4)
    opened = kept_table(blocks.groupBy("block").cogroup(cores.groupBy("block")).applyInPandas(sift, f"{REGIONS}, at binary, n_at long"), "regions")

    # Step 2: long ties, settled by the sample.
    tie_slices = slices_for(opened.agg(F.sum("n_at")).first()[0])
    ties = kept_table(answers(opened.mapInPandas(partial(_ask_ties, tie, tie_slices), QUESTION), 8), "ties")

    def settle(row, answer: pd.DataFrame) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """Text and starts of the regions, sample positions that prove a period of suffixes, and the suffixes that are still asked for."""
        text, starts, at, long = _long(row, tie)
        strings = Distinct(text, long, tie)
        again = strings.repeated(answer, tie_slices)
        settled, sent = long[again], long[again & strings.first(answer, tie_slices)]
        proved = covered(settled, settled + PERIOD, len(text))
        asked = np.flatnonzero((may_repeat(at, starts, length) & ~proved) | covered(sent, sent + PERIOD, len(text)))
        return text, starts, settled, asked[room(asked, starts, length)]

    # Step 3: the suffixes that are left, bucket by bucket.
    buckets = slices_for((opened.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0) // 2)

    def ask_suffixes(frame: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        row = next(frame.itertuples())
        text, _, _, asked = settle(row, answer)
        return pd.concat(Distinct(text, asked, length).ask(row.block, buckets, 8))

    def find(frame: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        row, of_ties = next(frame.itertuples()), answer["ties"].astype(bool)
        text, starts, settled, asked = settle(row, answer[of_ties])
        gone = covered(settled, settled + PERIOD, len(text))
        gone[asked[Distinct(text, asked, length).repeated(answer[~of_ties], buckets)]] = True
        gone = np.flatnonzero(gone)
        begins, ends = runs(gone, owners(gone, starts), length)
        move = np.frombuffer(row.origins, np.int64)[owners(begins, starts)] - starts[owners(begins, starts)]
        return pd.DataFrame({"block": [row.block], "begins": [(begins + move).tobytes()], "ends": [(ends + move).tobytes()]})

    regions = opened.groupBy("block")
    suffixes = answers(regions.cogroup(ties.groupBy("block")).applyInPandas(ask_suffixes, QUESTION), 8)
    both = ties.withColumn("ties", F.lit(True)).unionByName(suffixes.withColumn("ties", F.lit(False)))
    found = kept_table(regions.cogroup(both.groupBy("block")).applyInPandas(find, "block long, begins binary, ends binary"), "spans")

    def remove(frame: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = next(frame.itertuples())
        text, starts = unpacked(row.body), starts_of(row.sizes)
        begins, ends = (np.frombuffer(b"".join(found[c]), np.int64) for c in ("begins", "ends"))
        at, out = np.searchsorted(begins, starts), []
        for i, name in enumerate(row.labels):
            a, b = int(starts[i]), int(starts[i + 1])
            spans = [(x - a, y - a) for x, y in zip(begins[at[i]:at[i + 1]].tolist(), ends[at[i]:at[i + 1]].tolist())]
            edges = [0, *(e for span in spans for e in span), b - a]
            kept = b"".join(text[a + x:a + y] for x, y in zip(edges[::2], edges[1::2]))
            out.append((None if name is None else int(name), b - a, [{"start": x, "end": y} for x, y in spans],
                        hashlib.sha256(kept).hexdigest(), kept if rows else None))
        return pd.DataFrame(out, columns=DOCUMENT_COLUMNS, dtype=object)

    out = blocks.groupBy("block").cogroup(found.groupBy("block")).applyInPandas(
        remove, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept_sha256 string, kept binary")
    return out if rows else out.drop("kept")
