"""First-wins and last-wins rules on an explicit order column."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from siftworks.functions import identity as ident, text as tx, urls
from siftworks.operators.skew import salted_left_join
from siftworks.session import scratch_path, written


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """First row per key in the given order.

    ``row_number() = 1`` becomes a group limit before the shuffle, so a task
    sends at most one row per key however many it holds: a hot key costs no more
    than a rare one.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def keep_last(df: DataFrame, keys: list[Column | str], order: str) -> DataFrame:
    return keep_first(df, keys, [F.col(order).desc()])


def dedup_postings(df: DataFrame, order: str = "seq") -> DataFrame:
    """First posting per canonical URL, else per title|company|location."""
    return keep_first(df.withColumn("_key", ident.dedup_key(df)), ["_key"], [order]).drop("_key")


def dedup_hits(df: DataFrame, order: str = "seq") -> DataFrame:
    """First hit per canonical URL, else per title|query."""
    return keep_first(df.withColumn("_key", ident.query_dedup_key(df)), ["_key"], [order]).drop("_key")


def dedup_two_stage(df: DataFrame, order: str = "seq") -> DataFrame:
    """First per URL, then first per (source, title, company).

    Missing URLs equal each other, so all rows without URL collapse to one in the
    first stage; :func:`dedup_postings` is the variant without that effect.  Both
    stages rank key columns only; the rows are taken by the unique order column.
    """
    narrow = df.select(order, "url", "source", "title", "company")
    first = keep_first(keep_first(narrow, ["url"], [order]), ["source", "title", "company"], [order])
    return df.join(first.select(order), order, "left_semi")


def dedup_source_urls(df: DataFrame, order: str = "seq") -> DataFrame:
    """First per exact URL inside each source."""
    return keep_first(df, ["source", "url"], [order])


def dedup_issues(df: DataFrame, order: str = "seq") -> DataFrame:
    """First per URL, else per title|company."""
    key = tx.first_filled(tx.field(df, "url"), F.concat_ws("|", tx.field(df, "title"), tx.field(df, "company")))
    return keep_first(df.withColumn("_key", key), ["_key"], [order]).drop("_key")


def flag_duplicates(df: DataFrame, key: Column, order: str = "seq", name: str = "duplicate") -> DataFrame:
    """Mark second and later rows of a key; all rows are kept.

    The first row of each key is found by a partial minimum and joined back on
    the unique order column, so no task ever holds all rows of a hot key.
    """
    firsts = df.select(key.alias("_key"), order).groupBy("_key").agg(F.min(order).alias(order)).select(
        order, F.lit(False).alias(name))
    return df.join(firsts, order, "left").withColumn(name, F.coalesce(F.col(name), F.lit(True)))


def count_duplicates(df: DataFrame, key: Column) -> DataFrame:
    """One row: distinct keys kept and later rows skipped."""
    per_key = df.groupBy(key.alias("_key")).count()
    return per_key.agg(F.count("*").alias("kept"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("skipped"))


def first_across_queries(df: DataFrame, url: str = "url") -> DataFrame:
    """First hit of a URL over all queries, in query order then hit order."""
    return keep_first(df.filter(tx.nz(F.col(url)) != ""), [url], ["query_seq", "hit_seq"])


def accepted_per_query(df: DataFrame, url: str = "url") -> DataFrame:
    return first_across_queries(df, url).groupBy("query").agg(F.count("*").alias("accepted"))


def post_keys(df: DataFrame) -> Column:
    """Non-empty keys of a post: URL, title|author, title|subreddit (one shared key set)."""
    pair = lambda other: F.lower(F.concat_ws("|", tx.field(df, "title"), tx.field(df, other)))
    return F.array_distinct(F.filter(
        F.array(tx.field(df, "url"), pair("author"), pair("subreddit")), lambda k: k != ""))


def _first_come(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Winners among rows that arrive in order with all their keys."""
    taken: set[str] = set()
    for frame in frames:
        won = []
        for number, keys in zip(frame["_order"], frame["_keys"]):
            if taken.isdisjoint(keys):
                taken.update(keys)
                won.append(number)
        yield pd.DataFrame({"_order": won})


def dedup_greedy(df: DataFrame, keys: Column, order: str = "seq", at_once: int = 100_000) -> DataFrame:
    """Order-dependent dedup on several keys at once.

    A row is dropped when one of its keys was taken by an earlier kept row; only
    kept rows take keys.  Rows whose keys nobody else has are set aside; the
    others are decided in steps over a narrow (order, key) table, of two kinds:

    * side by side: rows that come first for every one of their keys are kept;
    * in order: the first ``at_once`` undecided rows depend on each other only, so
      one task walks through them (their orders and keys are all that it holds).

    After both, rows that share a key with a kept one are dropped.  Steps are side
    by side while each decides at least half of the rows that are left; after one that
    does not, and for the last ``at_once`` rows, comes a step in order.  A chain of n rows
    thus takes about 2 n / ``at_once`` steps, not n.  Rows without keys are kept;
    repeated keys of a row count once; an empty table stays empty.
    """
    spark, kind = df.sparkSession, df.schema[order].dataType
    every = written(df.select(F.col(order).alias("_order"), F.explode(F.array_distinct(keys)).alias("_key")).filter("_key is not null"), "keys")
    shared = every.groupBy("_key").agg(F.min("_order").alias("_low"), F.max("_order").alias("_high")).filter("_low < _high").select("_key")
    contested = written(every.join(shared, "_key", "left_semi").select("_order").distinct(), "contested")
    pairs, left, in_order = written(every.join(contested, "_order", "left_semi"), "pairs"), contested.count(), False
    # The winners of all steps lie in one folder and are read by one scan at the end.
    won, steps = scratch_path(spark, "winners"), 0
    while left:
        in_order = in_order or left <= at_once
        if in_order:
            first = pairs.groupBy("_order").agg(F.collect_list("_key").alias("_keys")).orderBy("_order").limit(at_once)
            found = first.coalesce(1).sortWithinPartitions("_order").mapInPandas(_first_come, contested.schema)
        else:
            # A row wins when it is first for as many keys as it has left.
            wins = pairs.groupBy("_key").agg(F.min("_order").alias("_order")).groupBy("_order").agg(F.count("*").alias("_wins"))
            sizes = pairs.groupBy("_order").agg(F.count("*").alias("_all"))
            found = wins.join(sizes, "_order").filter("_wins = _all").select("_order")
        found.write.parquet(f"{won}/_step={steps}")
        winners = spark.read.schema(contested.schema).parquet(f"{won}/_step={steps}")
        steps += 1
        if in_order and left <= at_once:
            break
        taken = pairs.join(winners, "_order", "left_semi").select("_key").distinct()
        hit = salted_left_join(pairs, taken, "_key", "_order", how="left_semi").select("_order").distinct()
        pairs = written(pairs.join(hit, "_order", "left_anti"), "pairs")
        before, left = left, pairs.select("_order").distinct().count()
        in_order = not in_order and 2 * left > before
    lost = contested
    if steps:
        lost = contested.join(spark.read.schema(contested.schema).parquet(*[f"{won}/_step={i}" for i in range(steps)]), "_order", "left_anti")
    return df.join(lost.select(F.col("_order").cast(kind).alias(order)), order, "left_anti")
