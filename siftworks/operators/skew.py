"""Work that stays balanced: over few large row groups, and in joins where one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siftworks.session import cut

MAX_HOT_KEYS = 256


def spread_rows(df: DataFrame, *by: str) -> DataFrame:
    """The same rows, dealt over the shuffle partitions by a hash of ``by``.

    A row group of a Parquet file is read by one task, and what follows the read stays
    in that task: texts of one large row group would be labelled one after the other.
    ``by`` should be short columns that together differ from row to row.
    """
    return df.repartition(*by)


def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """The most frequent values of a key with at least ``min_rows`` rows.

    One pass with a mergeable frequent-items sketch; the result never has more
    than ``MAX_HOT_KEYS`` rows, whatever the table, so it can be broadcast.  The
    sketch only steers the distribution of rows, never the result.
    """
    items = df.filter(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {MAX_HOT_KEYS})").alias("items"))
    return (
        items.select(F.explode("items").alias("i"))
        .filter(F.col("i.count") >= min_rows)
        .select(F.col("i.item").alias("_hot"))
    )


def salted_left_join(left: DataFrame, right: DataFrame, key: str, spread_by: str,
                     how: str = "left", salts: int = 64, min_rows: int = 100_000) -> DataFrame:
    """Equi join on ``key`` with the rows of hot left keys spread over ``salts`` buckets.

    Right rows of hot keys are repeated once per bucket; all other rows are
    shuffled as usual.  ``right`` must not itself have hot keys (all callers
    join to one row per key).  ``how`` is left, left_semi or left_anti.
    """
    # At most MAX_HOT_KEYS rows; materialised so that the sketch is built once.
    found = cut(hot_keys(left, key, min_rows))
    if found.isEmpty():
        return left.join(right, key, how)
    hot = F.broadcast(found)
    bucket = F.pmod(F.xxhash64(F.col(spread_by)), F.lit(salts)).cast("int")
    spread = (
        left.join(hot, left[key] == hot["_hot"], "left")
        .withColumn("_salt", F.when(F.col("_hot").isNotNull(), bucket).otherwise(F.lit(0)))
        .drop("_hot")
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    repeated = (
        right.join(hot, right[key] == hot["_hot"], "left")
        .withColumn("_salt", F.explode(F.when(F.col("_hot").isNotNull(), every).otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return spread.join(repeated, [key, "_salt"], how).drop("_salt")
