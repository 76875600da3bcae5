"""Intermediate tables, written where every executor can read them again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="spark-casebook-", dir="/tmp")


class Work:
    """Keeps results that several later steps read, so they are computed once.

    A kept table is plain parquet: it outlives lost executors, and later readers still prune
    its columns. ``drop`` removes all of them once the results built on them are written.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{work_dir(spark)}/casebook-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """``df``, written; with ``by`` in a folder for each value of that column, so that readers of some open those only."""
        self.count += 1
        path = f"{self.path}/{self.count:03d}-{name}"
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
