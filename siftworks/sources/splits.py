"""Quoted CSV and JSON files read by many tasks: files are cut into pieces anywhere, and what state a piece begins in is composed.

A piece is what stands between two separators (line feeds in CSV, closing braces in JSON), with the file, the block of the
file that a task reads, and its place. Whether a piece begins inside quotes depends on all pieces before it. A piece keeps, swaps or
sets that state; such steps compose, so each block is composed for itself, the blocks of a file (a row each) after it, and the state at
the start of each block goes back to its pieces. A record that crosses pieces or blocks is put together again; all others stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

FILE_BLOCK = ("_file", "_block")


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(_file, _block, _at, value, _size): the parts between separators; ``_at`` orders the parts of a block."""
    texts = spark.read.option("lineSep", separator).text(path)
    return texts.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_at"), "value", F.col("_metadata.file_size").alias("_size"))


def _before(keys: list[str], order: str, swap: Column, fixed: Column, start: Column) -> Column:
    """State (0 or 1) before a row: the last one that was set, or the start, swapped as often as rows since then say.

    ``fixed`` is the state that a row sets, null where it sets none; there ``swap`` is 1 if it swaps the state.
    """
    window = Window.partitionBy(*keys).orderBy(order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum(swap).over(earlier), F.lit(0))
    total = F.sum(swap).over(window.rowsBetween(Window.unboundedPreceding, 0))
    last = F.last(F.when(fixed.isNotNull(), (fixed + total) % 2), ignorenulls=True).over(earlier)
    return ((F.coalesce(last, start) + swaps) % 2).cast("int")


def with_state(parts: DataFrame, swap: Column, fixed: Column) -> DataFrame:
    """The parts with ``_inside``, the state before each (0 at the start of a file)."""
    stepped = parts.withColumns({"_swap": F.when(fixed.isNull(), swap).otherwise(0).cast("int"), "_fixed": fixed.cast("int")})
    alone = stepped.withColumns({"_zero": _before([*FILE_BLOCK], "_at", F.col("_swap"), F.col("_fixed"), F.lit(0)),
                                 "_one": _before([*FILE_BLOCK], "_at", F.col("_swap"), F.col("_fixed"), F.lit(1))})
    after = lambda state: F.coalesce(F.col("_fixed"), (F.col(state) + F.col("_swap")) % 2)
    ends = alone.groupBy(*FILE_BLOCK).agg(F.max_by(F.struct(after("_zero").alias("zero"), after("_one").alias("one")), "_at").alias("end"))
    # A block that ends in the same state from either start sets it; one that keeps the difference swaps or keeps it.
    sets = F.when(F.col("end.zero") == F.col("end.one"), F.col("end.zero"))
    blocks = ends.withColumns({"_swap": F.when(sets.isNull(), F.col("end.zero")).otherwise(0).cast("int"), "_fixed": sets.cast("int")})
    starts = blocks.select(*FILE_BLOCK, _before(["_file"], "_block", F.col("_swap"), F.col("_fixed"), F.lit(0)).alias("_start"))
    return alone.join(starts, [*FILE_BLOCK]).withColumn("_inside", F.when(F.col("_start") == 0, F.col("_zero")).otherwise(F.col("_one"))).drop(
        "_swap", "_fixed", "_zero", "_one", "_start")


def _first_of(parts: DataFrame, begins: Column) -> DataFrame:
    """The parts with ``_record``, the block and place of the nearest part up to each at which a record begins."""
    here = F.when(begins, F.struct("_block", "_at"))
    within = F.last(here, ignorenulls=True).over(Window.partitionBy(*FILE_BLOCK).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    known = parts.withColumn("_record", within)
    lasts = parts.groupBy(*FILE_BLOCK).agg(F.max(here).alias("_last"))
    carried = F.last("_last", ignorenulls=True).over(Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    return known.join(lasts.select(*FILE_BLOCK, carried.alias("_carried")), [*FILE_BLOCK]).withColumn("_record", F.coalesce("_record", "_carried")).drop("_carried")


def _together(parts: DataFrame, alone: Column, whole: Column, glue: str) -> DataFrame:
    """(_file, _record, value, whole) of the records; only parts that are no record of their own are grouped. A record is whole if one of its parts says so."""
    some = parts.where(~alone).groupBy("_file", "_record").agg(
        F.sort_array(F.collect_list(F.struct("_block", "_at", "value"))).alias("_parts"), F.max(whole).alias("whole"))
    joined = some.select("_file", "_record", F.array_join(F.transform("_parts", lambda p: p["value"]), glue).alias("value"), "whole")
    return parts.where(alone).select("_file", "_record", "value", F.lit(True).alias("whole")).unionByName(joined)


# --- CSV ---------------------------------------------------------------------------

def _ends_inside(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside them; doubled quotes are taken out. A quote opens only where a field begins."""
    closed = F.regexp_replace(line, '(?:^|(?<=,))"[^"]*"', "q")
    return F.when(closed.rlike('(?:^|,)"'), 1).otherwise(0)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _record, value): the records of CSV files, headers included; blank lines between records are no records."""
    lines = pieces(spark, path, "\n")
    bare = F.replace("value", F.lit('""'), F.lit(""))
    quote = F.instr(bare, '"')
    outside = F.when(F.contains("value", F.lit('"')), _ends_inside(bare)).otherwise(0)
    # Inside quotes the first quote closes the field; what follows it up to the next comma is part of the field.
    inside = F.when(quote == 0, 1).otherwise(_ends_inside(F.concat(F.lit("q"), F.expr("substring(replace(value, '\"\"', ''), instr(replace(value, '\"\"', ''), '\"') + 1)"))))
    known = lines.withColumns({"_out": outside, "_in": inside})
    known = with_state(known, F.col("_out"), F.when(F.col("_out") == F.col("_in"), F.col("_out")))
    known = _first_of(known, F.col("_inside") == 0)
    records = _together(known, (F.col("_inside") == 0) & (F.col("_out") == 0), F.lit(True), "\n").drop("whole")
    return records.withColumn("value", F.regexp_replace("value", "\r$", "")).where(F.trim("value") != "")


def csv_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Rows of CSV files whose first records name the columns; another header is an error."""
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1", "emptyValue": "", "maxColumns": "100000"}
    records = csv_records(spark, path)
    first = records.groupBy("_file").agg(F.min("_record").alias("_header"))
    rows = records.join(first, "_file")
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(wanted) + 1)])
    found = F.from_csv(F.regexp_replace("value", "^﻿", ""), names.simpleString()[7:-1].replace(":", " "), options)
    right = F.lit(True)
    for i, field in enumerate(wanted):
        right = right & F.lower(F.trim(F.coalesce(found[f"c{i}"], F.lit("")))).eqNullSafe(field.name.lower())
    right = right & found[f"c{len(wanted)}"].isNull()
    is_header = F.col("_record") == F.col("_header")
    wrong = F.raise_error(F.concat(F.lit("the header is not that of the schema: "), "value")).cast("boolean")
    left = rows.where(~F.when(is_header & ~right, wrong).otherwise(is_header))  # one expression, so that the check cannot be left out
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted)
    return left.select(F.from_csv("value", ddl, options).alias("_row")).select("_row.*")


# --- JSON --------------------------------------------------------------------------

def json_elements(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(_file, _record, opener, value): the objects of one JSON list per file, or of one mapping as mappings of an entry or some.

    Parts end at closing braces. A file that holds neither, ends before its list or mapping does or goes on behind it is an
    error, or, if not ``strict``, gives no rows.
    """
    parts = pieces(spark, path, "}")
    # An escape never spans a closing brace, so each part has whole escapes.
    parts = parts.withColumn("_plain", F.regexp_replace("value", r"\\.", ""))
    quotes = F.length("_plain") - F.length(F.replace("_plain", F.lit('"'), F.lit("")))
    known = with_state(parts, quotes % 2, F.lit(None).cast("int"))
    known = known.withColumn("_quoted", F.pmod(F.col("_inside") + quotes, F.lit(2)))  # the state at the closing brace
    opened = F.when(F.col("_inside") == 1, F.concat(F.lit('"'), "_plain")).otherwise(F.col("_plain"))
    bones = F.regexp_replace(F.regexp_replace(opened, '"[^"]*"', ""), '"[^"]*$', "")
    known = known.withColumn("_bones", bones).drop("_plain")
    count = lambda c: F.length("_bones") - F.length(F.replace("_bones", F.lit(c), F.lit("")))
    known = known.withColumn("_step", (count("{") + count("[") - count("]") - F.when(F.col("_quoted") == 0, 1).otherwise(0)).cast("long"))

    # Depth after each part: within its block, and what the blocks before it add.
    inner = F.sum("_step").over(Window.partitionBy(*FILE_BLOCK).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    blocks = known.groupBy(*FILE_BLOCK).agg(F.sum("_step").alias("_step"))
    outer = F.coalesce(F.sum("_step").over(Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = known.withColumn("_inner", inner).join(blocks.select(*FILE_BLOCK, outer.alias("_outer")), [*FILE_BLOCK])
    known = known.withColumn("_depth", F.col("_inner") + F.col("_outer")).drop("_inner", "_outer", "_step")

    # Whether the last part has a closing brace shows in the size of the file (a mark of the byte order, three bytes, is not in the parts).
    place, mark = F.struct("_block", "_at"), r"^[\ufeff\s]*"
    ends = known.groupBy("_file").agg(
        F.min_by("value", place).alias("_head"), F.max_by(F.struct("_depth", "_quoted", "value"), place).alias("_tail"),
        F.pmod(F.sum(F.octet_length("value") + 1) - F.max("_size"), F.lit(3)).alias("_open"))
    ends = ends.withColumn("opener", F.substring(F.regexp_replace("_head", mark, ""), 1, 1))
    closed = F.when(F.col("opener") == "[", (F.col("_open") == 1) & (F.col("_tail._depth") == -1) & F.col("_tail.value").rlike(r"\]\s*$")).otherwise(
        F.when(F.col("_open") == 1, (F.col("_tail._depth") == -1) & F.col("_tail.value").rlike(r"^\s*$")).otherwise(F.col("_tail._depth") == 0))
    ends = ends.select("_file", "opener", (F.col("opener").isin("[", "{") & (F.col("_tail._quoted") == 0) & closed).alias("_whole"))
    other = F.raise_error(F.concat(F.lit("expected one JSON list or mapping: "), "_file")).cast("boolean") if strict else F.lit(False)
    files = ends.where(F.when(F.col("_whole"), True).otherwise(other)).drop("_whole")

    # A part at depth 1 ends an element; the part after it begins the next one.
    known = known.withColumn("_done", (F.col("_quoted") == 0) & (F.col("_depth") == 1))
    lasts = known.groupBy(*FILE_BLOCK).agg(F.max_by("_done", "_at").alias("_done"))
    before = F.coalesce(F.lag("_done").over(Window.partitionBy("_file").orderBy("_block")), F.lit(True))
    known = known.withColumn("_begins", F.lag("_done").over(Window.partitionBy(*FILE_BLOCK).orderBy("_at")))
    known = known.join(lasts.select(*FILE_BLOCK, before.alias("_before")), [*FILE_BLOCK]).withColumn("_begins", F.coalesce("_begins", "_before")).drop("_before")
    known = _first_of(known, F.col("_begins")).withColumn("value", F.concat("value", F.lit("}")))
    records = files.join(_together(known, F.col("_done") & F.col("_begins"), F.col("_done"), ""), "_file", "left").where(F.col("value").isNotNull())

    # What follows the last element closes the file; in a mapping it may hold entries that are no objects.
    text = F.regexp_replace(F.regexp_replace("value", mark + r"[\[{,]?\s*", ""), r"^,\s*", "")
    rest = F.regexp_replace(text, r"\}[\s}]*$", "")
    records = records.withColumn("value", F.when(F.col("opener") == "[", F.when(F.col("whole"), text).when(rest.rlike(r"^\s*\]?\s*$"), "").otherwise(
        F.raise_error(F.concat(F.lit("a list of objects holds something else: "), "_file")))).otherwise(
        F.when(F.col("whole"), F.concat(F.lit("{"), text, F.lit("}"))).when(F.trim(rest) == "", "").otherwise(F.concat(F.lit("{"), rest, F.lit("}")))))
    return records.where(F.col("value") != "").select("_file", "_record", "opener", "value")


def json_list_rows(spark: SparkSession, path: str, row: str) -> DataFrame:
    """Rows of JSON files that hold one list of objects each; ``row`` is the type of an object. A mapping is an error."""
    found = json_elements(spark, path)
    parsed = F.when(F.col("opener") == "[", F.from_json("value", row)).otherwise(F.raise_error(F.lit("expected a JSON list")))
    return found.select(parsed.alias("_row")).select("_row.*")


def run_stats(spark: SparkSession, path: str) -> DataFrame:
    """(_file, name, value): the counters of a run's statistics object, as texts; nested objects and lists as JSON."""
    found = json_elements(spark, path)
    entries = F.when(F.col("opener") == "{", F.from_json("value", "map<string,string>")).otherwise(F.raise_error(F.lit("expected a JSON object")))
    return found.select("_file", F.explode(entries).alias("name", "value"))
