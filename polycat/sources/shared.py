"""Tables that are written once and read again while a plan is worked on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows that a task sorts or gathers, where a step deals its rows itself.
TASK_ROWS = 250_000


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a temporary one will do if all of Spark is one process; on a cluster that raises."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not re.fullmatch(r"local(\[[^,]*(,.*)?\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='spark-')}")
        given = spark.sparkContext.getCheckpointDir()
    return given.rstrip("/")


def new(spark: SparkSession, kind: str) -> str:
    """A path of its own in the shared folder."""
    return f"{folder(spark)}/{kind}-{uuid.uuid4().hex}"


def tasks(spark: SparkSession, rows: int) -> int:
    """How many tasks share rows: as many as there are cores, and more as the rows grow, so that what one task holds does not."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back, so that a lost executor costs its own tasks only."""
    at = new(df.sparkSession, "table")
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p
