"""Tables that several jobs read: written below the checkpoint folder where the session names one, else cached."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


class Kept:
    """What ``kept(df)`` returns is computed once, however often it is read.

    In a session with a checkpoint folder it is written there as compressed
    Parquet, of which readers read their columns, and survives lost executors.
    ``free``, or the end of a ``with`` block, removes it; else it stays as long
    as the folder.
    """

    def __init__(self) -> None:
        self.cached: list[DataFrame] = []
        self.paths: dict[int, str] = {}

    def __enter__(self) -> Kept:
        return self

    def __exit__(self, *error: object) -> None:
        self.free(*self.cached)

    def __call__(self, df: DataFrame) -> DataFrame:
        folder = df.sparkSession.sparkContext.getCheckpointDir()
        if folder and "void" not in df.schema.simpleString():  # which Parquet can't hold
            path = f"{folder.rstrip('/')}/kept-{uuid.uuid4().hex}"
            df.write.option("compression", "zstd").parquet(path)
            df = df.sparkSession.read.schema(df.schema).parquet(path)
            self.paths[id(df)] = path
        else:
            df.persist()
        self.cached.append(df)
        return df

    def free(self, *tables: DataFrame) -> None:
        for df in tables:
            if any(df is c for c in self.cached):
                self._remove(df, self.paths.pop(id(df), None))
        self.cached = [c for c in self.cached if not any(c is df for df in tables)]

    @staticmethod
    def _remove(df: DataFrame, path: str | None) -> None:
        if path is None:
            df.unpersist()
            return
        at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
