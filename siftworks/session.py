"""Session helpers: local sessions for tests and bench, shared scratch space."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "siftworks") -> SparkSession:
    """A local session for tests and measurements; clusters bring their own."""
    session = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    atexit.register(clear_scratch, session)
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, else one in the warehouse, which all executors share too."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/siftworks-scratch"
    return folder.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/siftworks-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application; a stopped session is left alone."""
    context = spark.sparkContext
    if context._jsc is None:
        return
    path = context._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written intermediate table."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise and cut lineage with a reliable checkpoint."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_own_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table of few columns to the shared folder, by column, and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
