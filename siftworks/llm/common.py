"""Shared pieces: words, folds, column names that cannot clash, intermediate tables."""

from __future__ import annotations

import os
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.session import scratch_path

# Fixed values of the contracts: white space is the space and the characters from tab to carriage return.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package although the driver was started in another folder."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", REPO)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % parts


def kept_table(df: DataFrame, label: str) -> DataFrame:
    """Write a narrow intermediate table to the shared folder once and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of the table has (without regard to case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) for arrays of hashes."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
