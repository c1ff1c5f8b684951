"""The trie of rebuilt conversations, by fingerprints of turn sequences that are composed without their texts.

A turn is a 128-bit digest of its role and text. A sequence of turns is an element of a monoid: its length and, for two bases, the
polynomial of its digests modulo a prime; two neighbours join as ``left * base^length(right) + right``. The running elements of every
conversation are folded over ranges of its turns. A rebuilt conversation is the head of its base conversation and its own turns from
there on, so the element of each of its prefixes is that of the head joined with the difference of two running elements of its own:
no rebuilt text and no rebuilt list is made.

Prefixes with one depth and one element are a node. Each prefix refers to its last turn (its digest) and to the element one
turn shorter; if these are the same throughout every group, equal elements are equal sequences by induction on the depth. Else the
nodes are made again with other bases.

A node is named by its smallest member and its depth. The nodes that a conversation names are a path, and paths are a tree: what the
paths below a node hold is summed up the tree by pointer jumping, and along a path by a running sum. Ids of the members that
end in a node are hashed in one stream; they come to it joined in pieces.

Defined cases. Turns are ordered by turn (null first), then role and text; null role or text is empty; repeated rows are turns of
their own. Rows without a conv_id belong to no conversation. An absent base lends no turns. Empty table: no nodes. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import kept_table
from siftworks.llm.running import running

PRIME = (1 << 61) - 1
# Fixed values of the contract: a base lends up to eight turns, and serves the ids up to the next multiple of five.
HEADS, FAMILY = 9, 5
# Ids that are joined before they are sent to the stream of their node.
IDS_AT_ONCE = 1 << 14


def digest(role: str, text: str) -> int:
    """128 bits of a turn; the length of the role keeps role and text apart."""
    role, text = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
    return xxhash.xxh3_128_intdigest(len(role).to_bytes(8, "little") + role + text)


def joined(left: tuple, right: tuple, bases: tuple[int, int]) -> tuple:
    """The product of two elements (length, polynomial, polynomial)."""
    return (left[0] + right[0], *((a * pow(b, right[0], PRIME) + c) % PRIME for a, c, b in zip(left[1:], right[1:], bases)))


def own_turns(conversations: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """Every turn of every conversation: its number from 1 (n), the element up to it (h1, h2), its digest (d1, d2) and bytes."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [digest(role, text) for role, text in zip(frame["role"], frame["text"])]
            frame["d1"] = pd.array([(d >> 64) - (1 << 63) for d in found], "int64")
            frame["d2"] = pd.array([(d & ((1 << 64) - 1)) - (1 << 63) for d in found], "int64")
            frame["bytes"] = [len(text.encode("utf-8", "surrogatepass")) for text in frame["text"]]
            yield frame

    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                                                              F.coalesce("text", F.lit("")).alias("text"))
    kind = turns.schema["turn"].dataType.simpleString()
    read_turns = turns.mapInPandas(read, f"conv long, turn {kind}, role string, text string, d1 long, d2 long, bytes long")
    return running(read_turns, "conv", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], ["n", "h1", "h2"],
                   lambda row: (1, row.d1 % PRIME, row.d2 % PRIME), lambda a, b: joined(a, b, bases), drop=("turn", "role", "text"))


def _lent() -> Column:
    return (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("long")


def prefixes(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """(conv, depth, f1, f2, e1, e2, d1, d2, bytes, ends): every prefix of every rebuilt conversation; e is the element one turn shorter."""
    convs = turns.groupBy("conv").agg(F.max("n").alias("length")).select("conv", "length", _lent().alias("lent"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    convs = kept_table(convs, "conversations")
    heads = kept_table(turns.where((F.col("n") < HEADS) & (F.col("conv") % FAMILY == 0)), "heads")

    # Heads: a base serves FAMILY conversations, so the join makes that many rows of each of its turns at most.
    lent = kept_table(convs.join(heads.select(F.col("conv").alias("base"), F.col("n").alias("depth"), "h1", "h2", "d1", "d2", "bytes"), "base")
                      .where("depth <= lent").drop("base"), "lent")
    last = lent.groupBy("conv").agg(F.max(F.struct("depth", "h1", "h2")).alias("head"))
    before = turns.select("conv", F.col("n").alias("at"), F.col("h1").alias("s1"), F.col("h2").alias("s2")).where(F.col("at") < HEADS)
    plan = (convs.join(last, "conv", "left").join(before.withColumnRenamed("at", "lent"), ["conv", "lent"], "left")
            .select("conv", "length", "lent", *[F.coalesce(F.col(f"head.{a}"), F.lit(0)).alias(b) for a, b in (("depth", "head"), ("h1", "b1"), ("h2", "b2"))],
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in ("s1", "s2")]))
    plan = kept_table(plan, "plan")

    def compose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                k, element = r.n - r.lent, []
                for base, head, skipped, whole, value in ((bases[0], r.b1, r.s1, r.h1, r.d1), (bases[1], r.b2, r.s2, r.h2, r.d2)):
                    # head * base^k + (whole - skipped * base^k), and the same one turn earlier.
                    element.append(((head - skipped) * pow(base, k, PRIME) + whole) % PRIME)
                    element.append((element[-1] - value % PRIME) * pow(base, -1, PRIME) % PRIME)
                out.append((r.conv, r.head + k, element[0], element[2], element[1], element[3], r.d1, r.d2, r.bytes, r.n == r.length))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PREFIX.split(", ")])

    def shorter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for base, i in zip(bases, "12"):
                frame[f"e{i}"] = [(h - d % PRIME) * pow(base, -1, PRIME) % PRIME for h, d in zip(frame[f"h{i}"].tolist(), frame[f"d{i}"].tolist())]
            yield frame

    own = turns.join(plan, "conv").where("n > lent").mapInPandas(compose, PREFIX)
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lent.schema)
    head = lent.mapInPandas(shorter, f"{shape}, e1 long, e2 long").join(last, "conv").select(
        "conv", "depth", F.col("h1").alias("f1"), F.col("h2").alias("f2"), "e1", "e2", "d1", "d2", "bytes",
        ((F.col("depth") == F.col("head.depth")) & (F.col("length") <= F.col("lent"))).alias("ends"))
    none = F.lit(0).cast("long")
    root = plan.select("conv", none.alias("depth"), *[none.alias(c) for c in ("f1", "f2", "e1", "e2", "d1", "d2", "bytes")],
                       ((F.col("head") == 0) & (F.col("length") <= F.col("lent"))).alias("ends"))
    return own.unionByName(head).unionByName(root)


PREFIX = "conv long, depth long, f1 long, f2 long, e1 long, e2 long, d1 long, d2 long, bytes long, ends boolean"


def _nodes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefixes and nodes, with bases under which every group of prefixes is proved to be one sequence."""
    draw = random.Random(20)
    while True:
        bases = (draw.randrange(1 << 32, PRIME), draw.randrange(1 << 32, PRIME))
        found = kept_table(prefixes(own_turns(conversations, bases), bases), "prefixes")
        nodes = kept_table(found.groupBy("depth", "f1", "f2").agg(
            F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("e1").alias("e1"), F.max("e2").alias("e2"),
            *[(F.max(c) == F.min(c)).alias(f"same_{c}") for c in ("e1", "e2", "d1", "d2")]), "nodes")
        if nodes.where("not (same_e1 and same_e2 and same_d1 and same_d2)").isEmpty():
            return found, nodes


def _summed_up(paths: DataFrame) -> DataFrame:
    """(path, leaves, saved) of each path with all paths below it; a round doubles the distance that the pointers reach."""
    tree = kept_table(paths.select("path", F.col("parent").alias("up"), "leaves", "saved"), "paths")
    while not tree.where("up is not null").isEmpty():
        more = tree.where("up is not null").groupBy(F.col("up").alias("path")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = tree.select(F.col("path").alias("up"), F.col("up").alias("next"))
        tree = kept_table(tree.join(more, "path", "left").join(above, "up", "left").select(
            "path", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "paths")
    return tree.select("path", "leaves", "saved")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) over the ids of the conversations that end in a node, ascending."""
    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out, node = [], (frame["conv_id"].to_numpy(), frame["depth"].to_numpy())
            at = np.append(0, np.flatnonzero((np.diff(node[0]) != 0) | (np.diff(node[1]) != 0)) + 1).tolist()
            ids = frame["conv"].tolist()
            for a, end in zip(at, [*at[1:], len(ids)]):
                out += [(node[0][a], node[1][a], ids[i], ",".join(map(str, ids[i:min(i + IDS_AT_ONCE, end)]))) for i in range(a, end, IDS_AT_ONCE)]
            yield pd.DataFrame(out, columns=["conv_id", "depth", "least", "ids"])

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for frame in frames:
            done = []
            for conv, depth, ids in zip(frame["conv_id"].tolist(), frame["depth"].tolist(), frame["ids"]):
                if (conv, depth) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (conv, depth), hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["conv_id", "depth", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["conv_id", "depth", "ends_sha256"])

    cut = (ends.repartitionByRange("conv_id", "depth", "conv").sortWithinPartitions("conv_id", "depth", "conv")
           .mapInPandas(pieces, "conv_id long, depth long, least long, ids string"))
    return cut.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "least").mapInPandas(stream, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node."""
    found, nodes = _nodes(conversations)
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("e1"), F.col("f2").alias("e2"), F.col("conv").alias("parent"))
    below = nodes.where("depth > 0").join(above, ["depth", "e1", "e2"]).select("conv", "depth", "parent", "n_convs", "bytes")
    tops = nodes.where("depth = 0").select("conv", "depth", F.lit(None).cast("long").alias("parent"), "n_convs", "bytes")
    named = kept_table(below.unionByName(tops), "named")

    children = named.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    single = kept_table(named.join(children, ["conv", "depth"], "left").select(
        "conv", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saves")), "single")

    # A path begins where its conversation is no longer named by its parent.
    begins = single.where("parent is null or parent <> conv").select(F.col("conv").alias("path"), "parent", F.col("depth").alias("begin"))
    sums = single.groupBy(F.col("conv").alias("path")).agg(F.sum("leaf").alias("leaves"), F.sum("saves").alias("saved"))
    begins = kept_table(begins, "begins")
    totals = _summed_up(begins.join(sums, "path"))
    hung = (begins.where("parent is not null").join(totals, "path").groupBy(F.col("parent").alias("conv"), (F.col("begin") - 1).alias("depth"))
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    parts = single.join(hung, ["conv", "depth"], "left").select(
        "conv", "depth", "parent", "n_convs", "n_children", (F.col("leaf") + F.coalesce("leaves", F.lit(0))).alias("leaf"), (F.col("saves") + F.coalesce("saved", F.lit(0))).alias("saves"))
    whole = running(parts, "conv", [F.col("depth").desc()], ["n_leaves", "saved_tokens"], lambda row: (row.leaf, row.saves), lambda a, b: (a[0] + b[0], a[1] + b[1]),
                    drop=("leaf", "saves"))

    ends = found.where("ends").select("conv", "depth", "f1", "f2").join(nodes.select("depth", "f1", "f2", F.col("conv").alias("conv_id")), ["depth", "f1", "f2"])
    hashed = _end_hashes(ends.select("conv_id", "depth", "conv"))
    return whole.withColumnRenamed("conv", "conv_id").join(hashed, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
