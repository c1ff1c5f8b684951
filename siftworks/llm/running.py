"""Running values over sorted rows, spread over tasks: a key may hold any share of the rows.

Rows are dealt by ranges of (key, order), so a large key goes over many tasks. Each task folds its own rows from the start of each
key; what a key has gathered in earlier tasks is then joined from the left, which is all that an associative fold needs. One row
per task, not per key, goes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import kept_table


def running(df: DataFrame, key: str, order: list[Column], state: list[str], lift: Callable, join: Callable, drop: tuple[str, ...] = ()) -> DataFrame:
    """Add the columns ``state`` (longs): the fold of the rows of a key up to and with each row.

    ``lift`` gives the state of one row (as a named tuple), ``join`` that of two neighbours. Columns of ``drop`` are read by ``lift`` only.
    """
    kept = [f for f in df.schema.fields if f.name not in drop]
    names = [f.name for f in kept]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "part int", "place long", *(f"{c} long" for c in state)])

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, place, last, held = TaskContext.get().partitionId(), 0, None, None
        for frame in frames:
            states = []
            for row in frame.itertuples(index=False):
                own = getattr(row, key)
                held = lift(row) if own != last else join(held, lift(row))
                last = own
                states.append(held)
            out = frame[names].copy()
            out["part"], out["place"] = part, range(place, place + len(frame))
            for i, column in enumerate(state):
                out[column] = [s[i] for s in states]
            place += len(frame)
            yield out

    local = kept_table(df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).mapInPandas(fold, schema), "running")
    ends = local.groupBy("part").agg(F.min_by(key, "place").alias("first"), F.max_by(F.struct(key, *state), "place").alias("last")).collect()
    before, carried = None, {}
    for row in sorted(ends, key=lambda r: r["part"]):
        own, value = row["last"][0], tuple(row["last"][1:])
        if before is not None and before[0] == row["first"]:
            carried[row["part"]] = before
            if own == row["first"]:
                value = join(before[1], value)
        before = (own, value)

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in frame.index:
                found = carried.get(frame.at[i, "part"])
                if found is not None and found[0] == frame.at[i, key]:
                    for column, value in zip(state, join(found[1], tuple(int(frame.at[i, c]) for c in state))):
                        frame.at[i, column] = value
            yield frame

    plain = [*names, *state]
    if not carried:
        return local.select(*plain)
    hot = F.col("part").isin(list(carried)) & F.col(key).isin([k for k, _ in carried.values()])
    return local.where(~hot).select(*plain).unionByName(local.where(hot).mapInPandas(add, local.schema).select(*plain))
