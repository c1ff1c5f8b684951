"""A history that a run neither shuffles nor rewrites as a whole.

The records lie in a table that is partitioned by a hash of the job_id (``part``) and bucketed by the job_id inside each
part. A batch names the parts that its jobs fall in (at most ``parts`` numbers); only those are read, and as the scan
already delivers them by job_id, a join shuffles the batch alone. An upsert overwrites the touched parts, each as a whole;
the files of all others stay as they are. The table holds one record per job_id.

The layout is written beside the records, so that a session with an empty catalog opens the table as it was made. One
writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftworks.operators import history as hs
from siftworks.session import written

COLUMNS = ("job_id string, url string, title string, source string, first_seen string, last_seen string, last_sent string, "
           "sent_count int, content_hash string, match_score int")


@dataclass(frozen=True)
class HistoryTable:
    spark: SparkSession
    name: str
    path: str
    parts: int
    buckets: int

    @classmethod
    def create(cls, spark: SparkSession, name: str, path: str, history: DataFrame, parts: int = 64, buckets: int = 64) -> HistoryTable:
        """Lay a history out; of several records of a job_id the one sent last stays. The path must be new."""
        spark.createDataFrame([(parts, buckets)], "parts int, buckets int").coalesce(1).write.mode("error").json(f"{path}/layout")
        made = cls.open(spark, name, path)
        made._write(hs.renewed(hs.one_record(history.select(*hs.HISTORY_FIELDS)).withColumn("_new", F.lit(None).cast(_NEW))).repartition(buckets, "job_id"))
        return made

    @classmethod
    def open(cls, spark: SparkSession, name: str, path: str) -> HistoryTable:
        layout = spark.read.schema("parts int, buckets int").json(f"{path}/layout").first()
        context = spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{path}/records")
        folder.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(folder)  # absent as long as there are no records
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}, part int) USING parquet PARTITIONED BY (part) "
                  f"CLUSTERED BY (job_id) SORTED BY (job_id) INTO {layout['buckets']} BUCKETS LOCATION '{path}/records'")
        made = cls(spark, name, path, layout["parts"], layout["buckets"])
        made._refresh()
        return made

    def _refresh(self) -> None:
        self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
        self.spark.catalog.refreshTable(self.name)

    def part(self) -> Column:
        # Another hash than that of the buckets, so that a part fills all its buckets.
        return F.pmod(F.xxhash64("job_id"), F.lit(self.parts)).cast("int")

    def touched(self, batch: DataFrame) -> list[int]:
        """The parts that the job_ids of a batch fall in: at most ``parts`` numbers."""
        return sorted(r[0] for r in batch.where("job_id is not null").select(self.part().alias("part")).distinct().collect())

    def read(self, batch: DataFrame | None = None) -> DataFrame:
        """All records, or those of the parts that a batch (with a job_id) touches."""
        records = self.spark.table(self.name)
        return (records if batch is None else records.where(F.col("part").isin(self.touched(batch)))).drop("part")

    def upsert(self, sent: DataFrame, now: Column, order: str = "seq") -> list[int]:
        """Write the rows sent in a run into their parts; gives the touched parts.

        Records of other jobs in those parts come from the scan as they lie, so nothing of the history is shuffled.
        """
        fresh = written(hs.sent_records(sent.where("job_id is not null"), now, order), "sent-records")
        parts = self.touched(fresh)
        if parts:
            self._write(self.after(fresh, parts))
        return parts

    def after(self, fresh: DataFrame, parts: list[int]) -> DataFrame:
        """The touched parts after an upsert of sent records."""
        old = self.spark.table(self.name).where(F.col("part").isin(parts)).drop("part")
        changed = fresh.join(old.select("job_id", F.struct(*old.columns[1:]).alias("_rec")), "job_id", "left")
        return old.join(fresh.select("job_id"), "job_id", "left_anti").unionByName(hs.renewed(changed))

    def _write(self, records: DataFrame) -> None:
        mode, before = "spark.sql.sources.partitionOverwriteMode", self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set(mode, "dynamic")
        try:
            records.withColumn("part", self.part()).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)
        self._refresh()


_NEW = ("struct<url:string,title:string,source:string,content_hash:string,match_score:int,found_at:string,times:int,sent_at:string>")
