"""WARC archives as tables: written as exact bytes by the text writer, read back by verifying the chain of record boundaries.

Reading. The files are cut at every occurrence of the version line, so each piece is a candidate record; sums of piece lengths per
block of a file, and of blocks per file, give byte offsets. A candidate names its successor: its offset plus header, content length and the
closing line ends. Records are the candidates that a file's start reaches; pointer jumping finds them in a logarithmic number of joins.
A version line inside a payload is never reached, and its piece is given back to the record around it.

Defined cases. Null html: an empty payload. Equal payloads of at least ``least_bytes``: the smallest page_id is the response, the others are
revisits of it; smaller payloads are all responses. Repeated rows of a page_id: a record each (of equal payloads one is the response only if
the ids differ; the same id twice gives two responses). Null page_id: a record without id, never referred to. An empty table: no files, no rows.
A broken chain ends the file's records there. Other columns are not read. The url is written without line ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftworks.llm.common import kept_table
from siftworks.session import scratch_path

# Fixed values of the format.
VERSION = "WARC/1.0\r\n"
CLOSE = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: eight groups of 20 bits, four letters each."""
    digest = F.sha1(payload)
    letters = []
    for group in range(8):
        value = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the revisits. Narrow; written once, so that the join knows its size."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = kept_table(pages.select("page_id", F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("payload_digest")), "digests")
    large = narrow.where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
    first = large.groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last").drop("last")
    return kept_table(large.join(first, ["payload_digest", "payload_bytes"]).where("page_id <> refers_to").select("page_id", "payload_digest", "refers_to").distinct(), "revisits")


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """One WARC record per page, in files of the scan's partitions."""
    revisits = plan_records(pages, least_bytes)
    payload = F.coalesce(F.col("html"), F.lit(""))
    digest = F.col("payload_digest")
    whole = (pages.select("page_id", "url", payload.alias("payload")).withColumn("payload_digest", base32_sha1(F.col("payload").cast("binary")))
             .join(revisits, ["page_id", "payload_digest"], "left").withColumn("is_revisit", F.col("refers_to").isNotNull()))
    block = F.concat(F.lit(HTTP_HEAD), F.when(F.col("is_revisit"), "").otherwise(F.col("payload")))
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\\r\\n]+", " ")
    header = F.concat(
        F.lit(VERSION), F.lit("WARC-Type: "), F.when(F.col("is_revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"),
        F.when(F.col("is_revisit"), F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nWARC-Target-URI: "), uri, F.lit("\r\nWARC-Date: 2000-01-01T00:00:00Z"), F.lit("\r\nWARC-Payload-Digest: sha1:"), digest,
        F.lit("\r\nX-Payload-Length: "), F.octet_length("payload").cast("string"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(CLOSE))
    # The writer ends each value with a line feed: the last of the record's own line ends.
    whole.select(F.concat(header, block, F.lit(CLOSE[:-1])).alias("value")).write.option("lineSep", "\n").text(path)


def scan_pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files cut at each version line: file, block, row (order within a block), value."""
    return (spark.read.option("lineSep", VERSION).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"), "value"))


def header_value(name: str) -> Column:
    return F.nullif(F.regexp_extract("head", f"(?:^|\r\n){name}: ([^\r]*)", 1), F.lit(""))


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, at) of the candidates (file, at, next) that the offset 0 of their file reaches: pointer jumping."""
    reached = candidates.where("at = 0").select("file", "at")
    state = kept_table(reached.select("file", F.lit(True).alias("seen"), "at", F.lit(None).cast("long").alias("next"))
                       .unionByName(candidates.select("file", F.lit(False).alias("seen"), "at", "next")), "jumps")
    while True:
        seen, jump = state.where("seen").select("file", "at"), state.where("not seen").select("file", "at", "next")
        if jump.isEmpty():
            return seen
        further = seen.unionByName(seen.join(jump, ["file", "at"]).select("file", F.col("next").alias("at"))).distinct()
        doubled = jump.join(jump.select("file", F.col("at").alias("next"), F.col("next").alias("far")), ["file", "next"]).select("file", "at", F.col("far").alias("next"))
        state = kept_table(further.select("file", F.lit(True).alias("seen"), "at", F.lit(None).cast("long").alias("next"))
                           .unionByName(doubled.select("file", F.lit(False).alias("seen"), "at", "next")), "jumps")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, type, record_id, refers_to, uri, payload_bytes, payload_digest, stated_digest, body_bytes) of every record.

    ``payload_digest`` is made again from the payload that was read (for revisits it is the stated one).
    """
    version, close, http = len(VERSION), len(CLOSE), len(HTTP_HEAD)
    split = F.instr("value", CLOSE)
    pieces = scan_pieces(spark, path).withColumn("cut", split).withColumn("head", F.when(F.col("cut") > 0, F.substring(F.col("value"), F.lit(1), F.col("cut") - 1)))
    length = header_value("Content-Length").cast("long")
    head_bytes = F.octet_length("head") + close
    is_candidate = F.col("cut").isNotNull() & (F.col("cut") > 0) & length.isNotNull()
    body = F.substring(F.col("value").cast("binary"), head_bytes + http + 1, F.greatest(length - http, F.lit(0)).cast("int"))
    whole = F.octet_length("value") >= head_bytes + length + close
    narrow = kept_table(pieces.select(
        "file", "block", "row", F.octet_length("value").cast("long").alias("bytes"), F.xxhash64("value").alias("hash"),
        F.when(is_candidate, F.struct(
            header_value("WARC-Type").alias("type"), header_value("WARC-Record-ID").alias("record_id"), header_value("WARC-Refers-To").alias("refers_to"),
            header_value("WARC-Target-URI").alias("uri"), header_value("X-Payload-Length").cast("long").alias("payload_bytes"),
            F.regexp_replace(header_value("WARC-Payload-Digest"), "^sha1:", "").alias("stated_digest"), head_bytes.cast("long").alias("head_bytes"), length.alias("length"),
            F.when(whole, base32_sha1(body)).alias("digest"))).alias("record")), "pieces")
    # A file's first piece is what stands before its first version line: empty, and not followed by another cut of its own.
    order = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    blocks = narrow.groupBy("file", "block").agg(F.sum(F.col("bytes") + version).alias("size"))
    base = blocks.withColumn("base", F.coalesce(F.sum("size").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = (narrow.withColumn("before", F.coalesce(F.sum(F.col("bytes") + version).over(order), F.lit(0)))
              .join(base.select("file", "block", "base"), ["file", "block"])
              .select("file", (F.col("base") + F.col("before") - version).alias("at"), "bytes", "hash", "record"))
    placed = kept_table(placed, "placed")
    candidates = placed.where("record is not null and at >= 0").select("file", "at", (F.col("at") + version + F.col("record.head_bytes") + F.col("record.length") + close).alias("next"))
    reached = reachable(candidates)
    records = kept_table(placed.join(reached.where("at >= 0"), ["file", "at"]).where("record is not null"), "records")
    complete = records.where("record.digest is not null")
    broken = records.where("record.digest is null")
    repaired = _repaired(spark, path, placed, broken)
    every = complete.select("file", "at", "record", F.col("record.digest").alias("digest")).unionByName(repaired)
    revisit = F.col("record.type") == "revisit"
    return every.select("file", F.col("at").alias("offset"), F.col("record.type").alias("type"), F.col("record.record_id").alias("record_id"),
                        F.col("record.refers_to").alias("refers_to"), F.col("record.uri").alias("uri"),
                        F.when(revisit, F.col("record.payload_bytes")).otherwise(F.col("record.length") - http).alias("payload_bytes"),
                        F.when(revisit, F.col("record.stated_digest")).otherwise(F.col("digest")).alias("payload_digest"),
                        F.col("record.stated_digest").alias("stated_digest"))


def _repaired(spark: SparkSession, path: str, placed: DataFrame, broken: DataFrame) -> DataFrame:
    """Records whose payload holds version lines: the texts of their pieces only are read again and joined in order of offset."""
    spans = broken.select("file", F.col("at").alias("start"), (F.col("at") + F.col("record.head_bytes") + F.col("record.length") + len(VERSION)).alias("stop"), F.col("record").alias("whole"))
    marks = placed.select("file", "at", "bytes", "hash", F.lit(None).cast("long").alias("stop")).join(spans.select("file", F.col("start").alias("at"), F.col("stop").alias("limit")), ["file", "at"], "left")
    behind = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owned = (marks.withColumn("owner", F.last(F.when(F.col("limit").isNotNull(), F.struct("at", "limit")), ignorenulls=True).over(behind))
             .where("at < owner.limit").select("file", F.col("owner.at").alias("start"), "at", "bytes", "hash"))
    owned = kept_table(owned, "owned")
    if owned.isEmpty():
        return broken.select("file", "at", "record", F.lit(None).cast("string").alias("digest")).limit(0)
    wanted = owned.select("file", "bytes", "hash").distinct()
    texts = (scan_pieces(spark, path).select("file", F.octet_length("value").cast("long").alias("bytes"), F.xxhash64("value").alias("hash"), "value")
             .join(wanted, ["file", "bytes", "hash"], "left_semi").dropDuplicates(["file", "bytes", "hash"]))
    joined = (owned.join(texts, ["file", "bytes", "hash"]).groupBy("file", "start")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda p: p["value"]), VERSION).alias("all")))
    both = joined.join(spans, ["file", "start"])
    body = F.substring(F.col("all").cast("binary"), (F.col("whole.head_bytes") + len(HTTP_HEAD) + 1).cast("int"), (F.col("whole.length") - len(HTTP_HEAD)).cast("int"))
    return both.select("file", F.col("start").alias("at"), F.col("whole").alias("record"), base32_sha1(body).alias("digest"))


def archive_round_trip(pages: DataFrame, least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write the pages as an archive, read it back: (page_id, payload_bytes, payload_digest, record_type, refers_to, verified)."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path, least_bytes)
    read = read_archive(pages.sparkSession, path)
    number = lambda name: F.nullif(F.regexp_extract(name, "<urn:page:(-?[0-9]*)>", 1), F.lit("")).cast("long")
    return read.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                       number("refers_to").alias("refers_to"), (F.col("payload_digest") == F.col("stated_digest")).alias("verified"))
