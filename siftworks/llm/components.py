"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import kept_table


def _edges(df: DataFrame) -> DataFrame:
    return df.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction. Large: a node hands its larger neighbours to its smallest one; small: its smaller ones."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        return _edges(joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(least.select("u", F.col("m").alias("v"))))
    return _edges(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); a component is named by its smallest node.

    Runs until a round changes nothing; rounds grow with the logarithm of the longest chain. Hot nodes only ever meet in
    partial minima and in equi joins that adaptive execution may split.
    """
    current, mark = kept_table(_edges(edges), "edges"), None
    while True:
        found = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
        if found[0] == 0:
            break
        current = kept_table(_star(_star(current, True), False), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
