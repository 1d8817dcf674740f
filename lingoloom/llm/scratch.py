"""Intermediate tables in the folder that all executors share.

Long jobs cut their lineage by writing a table below ``spark.checkpoint.dir``
and reading it again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where unset, a fresh temporary folder in local mode (tests), an error on a cluster."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.sparkContext.setCheckpointDir(known)
    return known


class Scratch:
    """Tables of one operator run; ``drop`` frees those whose readers are done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(t)))
            path.getFileSystem(conf).delete(path, True)
