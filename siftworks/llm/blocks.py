"""Texts packed into blocks, and questions that blocks ask about hashes of their strings.

A block is a row with whole documents of some four megabytes, compressed. Its hashes are dealt to slices by their upper
half; one task sorts one slice at a time and answers every block in bits, so neither a hash nor a document travels as a row of
its own. A block sends each distinct hash once, so a string that a third of all documents hold is at most one entry a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import kept_table

# Bytes of text in a block (one longer document is a block of its own) and hashes in a slice. Both bound the memory of a task;
# on larger clusters larger values make fewer and fuller cells of a block and a slice.
BLOCK_BYTES = 4 << 20
SLICE_KEYS = 2 << 20


def packed(texts: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=5).compress(b"".join(texts))


def unpacked(body: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body)


def key_bytes(keys: np.ndarray) -> bytes:
    """Ascending keys as their steps, byte by byte of the same weight, compressed: the upper bytes of the steps are mostly zero."""
    steps = np.diff(keys, prepend=keys.dtype.type(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(len(keys), keys.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def keys_from(body: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(unpacked(body), np.uint8).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(f"u{width}").ravel(), dtype=f"u{width}")


def text_blocks(docs: DataFrame, label: str, size: int = BLOCK_BYTES) -> DataFrame:
    """Write (block, labels, sizes, body) of the documents: ``label`` names a column that stays beside each text, as a string; null texts are empty."""
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, count = TaskContext.get().partitionId(), 0
        labels, texts, total = [], [], 0

        def row() -> pd.DataFrame:
            return pd.DataFrame({"block": [(part << 32) + count], "labels": [labels], "sizes": [[len(t) for t in texts]], "body": [packed(texts)]})

        for frame in frames:
            for name, text in zip(frame["label"], frame["body"]):
                text = text or b""
                if texts and total + len(text) > size:
                    yield row()
                    labels, texts, total, count = [], [], 0, count + 1
                labels.append(name)
                texts.append(text)
                total += len(text)
        if texts:
            yield row()

    rows = docs.select(F.col(label).cast("string").alias("label"), F.col("text").cast("binary").alias("body"))
    return kept_table(rows.mapInPandas(pack, "block long, labels array<string>, sizes array<long>, body binary"), "blocks")


def starts_of(sizes) -> np.ndarray:
    """Where each text of a block begins, and the end of the last."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(np.asarray(sizes, np.int64))])


def slices_for(keys: int | None) -> int:
    return max(8, -(-int(keys or 0) // SLICE_KEYS))


def dealt(upper: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of distinct hashes by slice, the slices that have any, and where each begins in that order (with the end)."""
    at = (upper % np.uint64(slices)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    have, begin = np.unique(at[order], return_index=True)
    return order, have, np.append(begin, len(at))


def questions(block: int, upper: np.ndarray, lower: np.ndarray, slices: int, width: int) -> Iterator[pd.DataFrame]:
    """Rows (slice, block, keys) of distinct ascending hashes in the order of ``dealt``; keys are the first ``width`` bytes of the lower halves."""
    order, have, begin = dealt(upper, slices)
    keys = (lower[order] >> np.uint64(64 - 8 * width)).astype(f"u{width}")
    yield pd.DataFrame({"slice": have, "block": block, "keys": [key_bytes(keys[a:b]) for a, b in zip(begin[:-1], begin[1:])]})


QUESTION = "slice long, block long, keys binary"
ANSWER = "block long, slice long, repeated binary, first binary"


def answers(asked: DataFrame, width: int) -> DataFrame:
    """For each question, in bits: does another entry of the slice have the same key, and is this the first one that has it."""
    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        cells = [keys_from(k, width) for k in frame["keys"]]
        keys = np.concatenate(cells)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        repeated, first = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        repeated[order[1:]] = same
        repeated[order[:-1]] |= same
        first[order] = np.append(True, ~same)
        ends = np.cumsum([len(c) for c in cells])
        begins = np.append(0, ends[:-1])
        return pd.DataFrame({"block": frame["block"].to_numpy(), "slice": frame["slice"].to_numpy(),
                             "repeated": [np.packbits(repeated[a:b]).tobytes() for a, b in zip(begins, ends)],
                             "first": [np.packbits(first[a:b]).tobytes() for a, b in zip(begins, ends)]})

    return asked.groupBy("slice").applyInPandas(judge, ANSWER)


def in_order(answer: pd.DataFrame, column: str, upper: np.ndarray, slices: int) -> np.ndarray:
    """The bits of a block's answers, back in the order of its distinct hashes."""
    order, have, begin = dealt(upper, slices)
    rows = dict(zip(answer["slice"], answer[column]))
    out = np.zeros(len(order), bool)
    for number, a, b in zip(have, begin[:-1], begin[1:]):
        out[order[a:b]] = np.unpackbits(np.frombuffer(rows[number], np.uint8), count=b - a).astype(bool)
    return out
