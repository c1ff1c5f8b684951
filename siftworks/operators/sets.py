"""Unions of source tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def union_sources(frames: Sequence[DataFrame], order: str = "seq") -> DataFrame:
    """Concatenate source tables in a fixed order.

    ``source_seq`` keeps the position of the table; together with the row order
    inside the table it replaces the implicit order of concatenated frames.
    """
    tagged = [frame.withColumn("source_seq", F.lit(i)) for i, frame in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_collectors(frames: dict[str, DataFrame | None]) -> DataFrame:
    """Append collector outputs in order, each tagged with its collector.

    A collector without output (None) contributes no rows; the others go on.
    Without any output the table is empty, with the two tags as its columns.
    """
    present = [(i, name, frame) for i, (name, frame) in enumerate(frames.items()) if frame is not None]
    if not present:
        return SparkSession.active().createDataFrame([], "collector string, source_seq int")
    tagged = [f.withColumn("collector", F.lit(n)).withColumn("source_seq", F.lit(i)) for i, n, f in present]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_else_fallback(primary: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """Fallback rows only for keys (sites) that have no primary row."""
    found = primary.select(key).distinct()
    return primary.unionByName(fallback.join(found, key, "left_anti"), allowMissingColumns=True)
