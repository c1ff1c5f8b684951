"""Similarity self join on sets of word n-grams: exact Jaccard links, the number of links of each document, and its class.

The join is a prefix join. Documents with the same set are one member. Shingles are ordered by a frequency
class and then by hash; two sets that reach the threshold share a shingle among the first ``n - ceil(t * n) + 1`` of each.
Posting lists of the prefixes hold members, not groups by size and prefix: lists with the same members are one list, and lists of one member go.
Within a list, sizes and parity bitmaps bound the overlap from above, so that only pairs which may link are expanded; they
are verified on the whole sets. For the classes, a first pass proposes a best-first spanning forest of each list, and a second
one, with the classes of the first known, every pair still open between two classes. Every link lies within a class, so the join
then compares the whole sets of each class with each other, in blocks; ``ngram_jaccard_components`` leaves that out.

Defined cases. Null or blank text: empty set, size 0, linked with nothing. Fewer words than ``n``: the whole sequence is
one shingle. Repeated rows of a doc_id: one row each, computed from its own text; classes are by set, so copies meet. A link is with
another row with a doc_id; rows of equal sets are linked, and a null doc_id has no links.
Ties: the smallest doc_id names a class. Empty table: no rows. A null doc_id never names a class of others. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftworks.llm.common import LOWER_AZ, WORD, kept_table, mix
from siftworks.llm.components import components

# One document in so many is counted to tell frequent shingles; the counts only order the shingles, so any rate is exact.
COUNTED_ONE_IN = 16
# At most so many frequent shingles are sent to the tasks (12 bytes each).
MOST_FREQUENT = 400_000
# Members of a posting list that one task compares with each other; longer lists are dealt as pairs of blocks.
BLOCK = 1024
# Pairs of a list that a task holds at once.
MOST_PAIRS = 50_000
# Sets of a class that one task compares with as many others, and shingles that it lays out at once.
BLOCK_SETS = 256
SHINGLES = 8192
# Sorted ids that may be sent to the tasks (8 bytes each); beyond, the texts are joined by shuffle.
MOST_SENT_IDS = 1_000_000
MEMO_WORDS = 100_000

_MEMO: dict[str, int] = {}


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, with a bounded memory of those seen."""
    if len(_MEMO) > MEMO_WORDS:
        _MEMO.clear()
    get = _MEMO.get
    found = []
    for word in words:
        value = get(word)
        if value is None:
            value = _MEMO[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        found.append(value)
    return np.array(found, dtype=np.uint64)


def forgetting(function):
    """The same function over a partition, after which its worker holds no words and no free Arrow memory."""
    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from function(frames)
        finally:
            _MEMO.clear()
            pa.default_memory_pool().release_unused()
    return call


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a text (lower case for A-Z only)."""
    words = WORD.findall(text.translate(LOWER_AZ)) if text else []
    if not words:
        return np.empty(0, np.uint64)
    each = word_hashes(words)
    span = min(n, len(words))
    last = len(each) - span + 1
    out = np.full(last, span, np.uint64)
    for i in range(span):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + each[i:i + last])
    return np.unique(out)


def bitmap(values: np.ndarray) -> bytes:
    """Parity of the hashes per slot; twice as many slots as hashes, a power of two, so that halves fold by exclusive or."""
    bits = 1 << max(9, int(2 * len(values) - 1).bit_length())
    parity = np.bincount((values >> np.uint64(11)).astype(np.int64) & (bits - 1), minlength=bits).astype(np.uint8) & 1
    return np.packbits(parity, bitorder="little").tobytes()


def prefix_length(n: int, percent: int) -> int:
    return n + (percent * n) // -100 + 1 if n else 0  # n - ceil(percent * n / 100) + 1


def links(overlap, left, right, percent: int):
    return 100 * overlap >= percent * (left + right - overlap)


def _counted(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of the counted documents and their class (bits of the count), sorted by shingle; bounded."""
    def expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["text"]:
                yield pd.DataFrame({"shingle": shingles(text, n).view(np.int64)})

    part = docs.where(F.abs(F.xxhash64("doc_id")) % COUNTED_ONE_IN == 0)
    top = (part.select("text").mapInPandas(forgetting(expand), "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
           .where("n > 2").orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).toPandas())
    order = np.argsort(top["shingle"].to_numpy(np.int64).view(np.uint64))
    keys = top["shingle"].to_numpy(np.int64).view(np.uint64)[order]
    return keys, np.ceil(np.log2(top["n"].to_numpy(np.float64)))[order].astype(np.uint8)


def features(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, size, digest, prefix, bits) of each document; bits and prefix are empty for empty sets."""
    keys, classes = _counted(docs, n)
    sent = docs.sparkSession.sparkContext.broadcast((keys, classes))

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, classes = sent.value
        for frame in frames:
            for start in range(0, len(frame), 500):
                part = frame.iloc[start:start + 500]
                sizes, digests, prefixes, bits = [], [], [], []
                for text in part["text"]:
                    found = shingles(text, n)
                    sizes.append(len(found))
                    digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                    bits.append(bitmap(found) if len(found) else b"")
                    length = prefix_length(len(found), percent)
                    if len(found) and len(keys):
                        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                        rank = np.where(keys[at] == found, classes[at], 0)
                        found = found[np.argsort(rank, kind="stable")]
                    prefixes.append(found[:length].view(np.int64))
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "size": sizes, "digest": digests, "prefix": prefixes, "bits": bits})

    return docs.select("doc_id", "text").mapInPandas(forgetting(describe), "doc_id long, size long, digest binary, prefix array<long>, bits binary")


def _apart(a: int, b: int, width_a: int, width_b: int) -> int:
    """Differing slots of two bitmaps held as integers, the wider one folded."""
    while width_a != width_b:
        if width_a > width_b:
            width_a //= 2
            a = (a >> width_a) ^ (a & ((1 << width_a) - 1))
        else:
            width_b //= 2
            b = (b >> width_b) ^ (b & ((1 << width_b) - 1))
    return (a ^ b).bit_count()


def _few_open(sizes, classes, bits, percent: int):
    """As _open_pairs, for lists of a few members: plain integers, made only where sizes and classes allow the pair."""
    found, made = [], {}

    def value(i: int) -> int:
        if i not in made:
            made[i] = int.from_bytes(bits[i], "little")
        return made[i]

    for i in range(len(sizes) - 1):
        for j in range(i + 1, len(sizes)):
            a, b = sizes[i], sizes[j]
            if classes[i] == classes[j] or 100 * min(a, b) < percent * max(a, b):
                continue
            apart = _apart(value(i), value(j), 8 * len(bits[i]), 8 * len(bits[j]))
            most = (a + b - apart) // 2
            if 100 * most >= percent * (a + b - most):
                found.append((i, j, apart))
    return (np.array([f[k] for f in found], np.int64) for k in range(3))


def _open_pairs(sizes, classes, bits, left, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (i, j) of one list that may link, a bounded number at once: other class, sizes and bitmaps allow it. left: only pairs across that mark."""
    if len(sizes) <= 12 and left is None:
        yield tuple(_few_open(sizes.tolist(), classes.tolist(), bits, percent))
        return
    found, held = [], 0
    widths = np.array([8 * len(b) for b in bits])
    values = [int.from_bytes(b, "little") for b in bits] if len(np.unique(widths)) > 1 else None
    stacked = np.stack([np.frombuffer(b, np.uint64) for b in bits]) if values is None else None
    for i in range(len(sizes) - 1):
        small, big = np.minimum(sizes[i], sizes[i + 1:]), np.maximum(sizes[i], sizes[i + 1:])
        ok = (100 * small >= percent * big) & (classes[i + 1:] != classes[i])
        if left is not None:
            ok &= left[i + 1:] != left[i]
        rest = np.flatnonzero(ok) + i + 1
        if not len(rest):
            continue
        if stacked is not None:
            apart = np.bitwise_count(stacked[rest] ^ stacked[i]).sum(axis=1, dtype=np.int64)
        else:
            apart = np.array([_apart(values[i], values[j], int(widths[i]), int(widths[j])) for j in rest], np.int64)
        ok = links((sizes[i] + sizes[rest] - apart) // 2, sizes[i], sizes[rest], percent)
        if ok.any():
            found.append((np.full(int(ok.sum()), i), rest[ok], apart[ok]))
            held += len(found[-1][0])
            if held >= MOST_PAIRS:
                yield tuple(map(np.concatenate, zip(*found)))
                found, held = [], 0
    if found:
        yield tuple(map(np.concatenate, zip(*found)))


def _forest(i: np.ndarray, j: np.ndarray, apart: np.ndarray, ids: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Positions of the pairs of a best-first spanning forest (Kruskal; ties by the ids)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    chosen, open_classes = [], len(np.unique(np.concatenate([classes[i], classes[j]])))
    for k in np.lexsort((ids[j], ids[i], apart)):
        a, b = root(int(classes[i[k]])), root(int(classes[j[k]]))
        if a != b:
            parent[a] = b
            chosen.append(k)
            open_classes -= 1
            if open_classes == 1:
                break
    return np.array(chosen, np.int64)


def _forest_of(parts, ids: np.ndarray, classes: np.ndarray):
    """The pairs of the best-first spanning forest of all parts: the order of the pairs is total, so a pair that a part leaves out is in no forest of more."""
    held = None
    for part in parts:
        held = part if held is None else tuple(map(np.concatenate, zip(held, part)))
        if len(held[0]) > 1:
            chosen = _forest(*held, ids, classes)
            held = tuple(column[chosen] for column in held)
    return [] if held is None else [held]


def _proposals(lists: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs (a, b), a < b, proposed by the lists (columns list, x, y, doc, size, class, bits; rows of a list and block pair together)."""
    def of_list(ids, sizes, classes, bits, left):
        if (classes == classes[0]).all():
            return
        order = np.lexsort((ids, sizes))
        ids, sizes, classes, bits = ids[order], sizes[order], classes[order], [bits[k] for k in order]
        parts = _open_pairs(sizes, classes, bits, None if left is None else left[order], percent)
        for i, j, _ in _forest_of(parts, ids, classes) if forest else parts:
            yield np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])

    def propose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        out_a, out_b = [], []

        def take(part: dict[str, np.ndarray], begin: int, end: int) -> Iterator[pd.DataFrame]:
            if end - begin > 1:
                at = slice(begin, end)
                left = part["mine"][at] == part["x"][begin] if part["x"][begin] != part["y"][begin] else None
                for a, b in of_list(part["doc"][at], part["size"][at], part["class"][at], part["bits"][at], left):
                    if len(a):
                        out_a.append(a)
                        out_b.append(b)
                    if len(a) >= MOST_PAIRS:
                        yield flush()

        def flush():
            a = np.concatenate(out_a) if out_a else np.empty(0, np.int64)
            b = np.concatenate(out_b) if out_b else np.empty(0, np.int64)
            out_a.clear()
            out_b.clear()
            return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

        for frame in frames:
            if held is not None:
                frame = pd.concat([held, frame], ignore_index=True)
            part = {c: frame[c].to_numpy() for c in frame.columns}
            change = np.zeros(max(0, len(frame) - 1), bool)
            for c in ("list", "x", "y"):
                change |= part[c][1:] != part[c][:-1]
            begin = 0
            for cut in (np.flatnonzero(change) + 1).tolist():
                yield from take(part, begin, cut)
                begin = cut
            held = frame.iloc[begin:]
            if sum(map(len, out_a)) > MOST_PAIRS:
                yield flush()
        if held is not None and len(held):
            yield from take({c: held[c].to_numpy() for c in held.columns}, 0, len(held))
        yield flush()

    dealt = lists.repartition("list", "x", "y").sortWithinPartitions("list", "x", "y")
    return dealt.mapInPandas(forgetting(propose), "a long, b long").distinct()


def _sets(needed: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(doc, digest, set): the whole sets of the documents needed (column doc), made again from their texts."""
    spark = docs.sparkSession
    number = needed.count()
    texts = docs.select("doc_id", "text")
    if number <= MOST_SENT_IDS:
        wanted = spark.sparkContext.broadcast(np.sort(needed.toPandas()["doc"].to_numpy(np.int64)))
    else:
        wanted = None
        texts = texts.join(needed, F.col("doc_id") == F.col("doc"), "left_semi")

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if wanted is not None:
                ids = frame["doc_id"].fillna(0).to_numpy(np.int64)
                at = np.minimum(np.searchsorted(wanted.value, ids), max(0, len(wanted.value) - 1))
                frame = frame[(wanted.value[at] == ids) & frame["doc_id"].notna().to_numpy()] if len(wanted.value) else frame.iloc[:0]
            for start in range(0, len(frame), 200):
                part = frame.iloc[start:start + 200]
                made = [shingles(t, n).tobytes() for t in part["text"]]
                yield pd.DataFrame({"doc": part["doc_id"].to_numpy(np.int64), "digest": [xxhash.xxh3_128_digest(v) for v in made], "set": made})

    return texts.mapInPandas(forgetting(sets), "doc long, digest binary, set binary")


def _verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose whole sets link. The sets are made again from the texts of the documents in the pairs only."""
    known = _sets(kept_table(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "needed"), docs, n)
    left = known.select(F.col("doc").alias("a"), F.col("set").alias("set_a"))
    right = known.select(F.col("doc").alias("b"), F.col("set").alias("set_b"))

    def confirm(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = []
            for a, b in zip(frame["set_a"], frame["set_b"]):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                keep.append(len(a) > 0 and len(b) > 0
                            and bool(links(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent)))
            yield frame.loc[keep, ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").mapInPandas(forgetting(confirm), "a long, b long").distinct()


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common shingles of each set on the left with each on the right."""
    values, column, often = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(v) for v in (*left, *right)])
    # Shingles of one set only are common to none.
    use = often[column] > 1
    row, column = row[use], (np.cumsum(often > 1) - 1)[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    found = np.zeros((len(left), len(right)), np.float64)
    for begin in range(0, int((often > 1).sum()), SHINGLES):
        at = slice(*np.searchsorted(column, (begin, begin + SHINGLES)))
        laid = np.zeros((len(left) + len(right), SHINGLES), np.float32)
        laid[row[at], column[at] - begin] = 1
        found += laid[:len(left)] @ laid[len(left):].T
    return found.astype(np.int64)


def _block_links(frame: pd.DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the linked sets of a block pair (columns x, y, mine, set), each pair once."""
    sets = [np.frombuffer(v, np.uint64) for v in frame["set"]]
    here = np.flatnonzero(frame["mine"] == frame["x"])
    there = here if frame["x"].iloc[0] == frame["y"].iloc[0] else np.flatnonzero(frame["mine"] != frame["x"])
    if not len(here) or not len(there):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    sizes = np.array([len(v) for v in sets])
    linked = links(_overlaps([sets[k] for k in here], [sets[k] for k in there]), sizes[here][:, None], sizes[there][None, :], percent)
    if there is here:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    return here[i], there[j]


def _in_blocks(members: DataFrame, classes: DataFrame, docs: DataFrame, n: int, answer, schema: str) -> DataFrame:
    """``answer`` of every block pair (class, x, y) of the sets of a class; each two sets of a class meet in one of them."""
    of_class = (members.join(classes, F.col("doc") == F.col("node"), "left")
                .select("digest", "doc", "members", F.coalesce("component", "doc").alias("class")))
    many = of_class.groupBy("class").agg(F.count("*").alias("m")).where("m > 1")
    dealt = (of_class.join(many, "class").withColumn("blocks", F.ceil(F.col("m") / BLOCK_SETS).cast("int"))
             .withColumn("mine", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
             .select("class", "digest", "doc", "members", "blocks", "mine"))
    dealt = kept_table(dealt, "dealt")
    pairs = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("class", "digest", "doc", "members", "mine", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y")))
    sets = _sets(dealt.select("doc").distinct(), docs, n).drop("doc")
    return pairs.join(sets, "digest").groupBy("class", "x", "y").applyInPandas(lambda frame: answer(frame.drop_duplicates("digest", ignore_index=True)), schema)


def ngram_jaccard_links(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(a, b, members_a, members_b): every link between two different sets, named by their smallest doc_ids (a < b), and the documents of each set.

    The documents of one set are linked with each other besides. Rows grow with the square of a group of near copies, as links do.
    """
    _, members, classes = _classes(docs, n, percent)

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = _block_links(frame, percent)
        ids, counts = frame["doc"].to_numpy(), frame["members"].to_numpy()
        i, j = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
        return pd.DataFrame({"a": ids[i], "b": ids[j], "members_a": counts[i], "members_b": counts[j]})

    return _in_blocks(members, classes, docs, n, answer, "a long, b long, members_a long, members_b long")


def ngram_jaccard_counts(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The columns of ``ngram_jaccard_join`` and n_links: the other rows that a row is linked with, from every pair of sets of its class."""
    known, members, classes = _classes(docs, n, percent)

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = _block_links(frame, percent)
        counts = frame["members"].to_numpy()
        found = np.bincount(i, counts[j], len(frame)) + np.bincount(j, counts[i], len(frame))
        return pd.DataFrame({"digest": frame["digest"], "n": found.astype(np.int64)})

    found = _in_blocks(members, classes, docs, n, answer, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    found = kept_table(found, "counts")
    named = (_named(members, classes).join(found, "digest", "left")
             .select("digest", "component_id", (F.col("members") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    return _answered(known, named).select("doc_id", "n_shingles", "component_id", F.when(F.expr(_USED), F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"))


def ngram_jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): the set size and the smallest doc_id reachable by links of Jaccard >= percent / 100.

    The contract's columns of the whole join; every link has been verified and counted.
    """
    return ngram_jaccard_counts(docs, n, percent).drop("n_links")


def ngram_jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """As ``ngram_jaccard_join``, of as many links as name the classes; the others are not verified."""
    known, members, classes = _classes(docs, n, percent)
    return _answered(known, _named(members, classes)).select("doc_id", "n_shingles", "component_id")


_USED = "n_shingles > 0 and doc_id is not null"


def _named(members: DataFrame, classes: DataFrame) -> DataFrame:
    return (members.select("digest", "doc", "members").join(classes, F.col("doc") == F.col("node"), "left")
            .select("digest", "members", F.coalesce("component", "doc").alias("component_id")))


def _answered(known: DataFrame, named: DataFrame) -> DataFrame:
    found = known.join(named, "digest", "left").withColumnRenamed("size", "n_shingles")
    return found.withColumn("component_id", F.when(F.expr(_USED), F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")))


def _classes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The features of the documents, the distinct sets, and the classes (node, component) of the sets that are linked."""
    known = kept_table(features(docs, n, percent), "features")
    own = known.where("size > 0 and doc_id is not null")
    each = own.groupBy("digest").agg(F.min("doc_id").alias("doc"), F.count("*").alias("members"), F.min_by(F.struct("size", "prefix", "bits"), "doc_id").alias("of"))
    members = kept_table(each.select("digest", "doc", "members", "of.*"), "members")
    postings = members.select("doc", "size", F.explode("prefix").alias("list"))
    # A member stays in a list where a neighbour by size may link; so lists of one go, too.
    by_size = Window.partitionBy("list").orderBy("size", "doc")
    shared = postings.withColumn("under", F.lag("size").over(by_size)).withColumn("over", F.lead("size").over(by_size))
    shared = kept_table(shared.where((100 * F.col("under") >= percent * F.col("size")) | (100 * F.col("size") >= percent * F.col("over")))
                        .select("list", "doc", "size"), "postings")
    # Lists with the same members are one list: a set digest finds them without gathering members.
    marks = shared.groupBy("list").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("doc")).alias("p"),
                                       F.bit_xor(F.xxhash64(F.lit(1), "doc")).alias("q"))
    chosen = marks.groupBy("m", "p", "q").agg(F.min("list").alias("list")).select("list", "m")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    dealt = (shared.join(chosen, "list").withColumn("blocks", blocks)
             .withColumn("mine", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("list", "doc", "size", "mine", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y")))
    lists = kept_table(dealt, "lists")
    bits = members.select("doc", "bits")

    first = kept_table(_proposals(lists.join(bits, "doc").withColumn("class", F.col("doc")), percent, True), "pairs")
    sure = kept_table(_verified(first, docs, n, percent), "links")
    classes = kept_table(components(sure.select(F.col("a").alias("u"), F.col("b").alias("v"))), "classes")
    again = (lists.join(classes.withColumnRenamed("node", "doc"), "doc", "left")
             .withColumn("class", F.coalesce("component", "doc")).drop("component"))
    mixed = again.groupBy("list", "x", "y").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select("list", "x", "y")
    second = _proposals(again.join(mixed, ["list", "x", "y"]).join(bits, "doc"), percent, False)
    second = kept_table(second.join(first, ["a", "b"], "left_anti"), "pairs")
    more = _verified(second, docs, n, percent)
    edges = more.select("a", "b").join(classes.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left") \
        .join(classes.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left") \
        .select(F.coalesce("ca", "a").alias("u"), F.coalesce("cb", "b").alias("v"))
    all_edges = edges.unionByName(classes.select(F.col("node").alias("u"), F.col("component").alias("v")))
    return known, members, kept_table(components(all_edges), "classes")
