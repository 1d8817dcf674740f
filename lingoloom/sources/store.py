"""Several Parquet tables that change together: versioned folders, and one small commit file that is renamed last.

Below the store's root, ``data`` holds a folder for each write and ``commits``
a numbered file for each commit, which names every table's folder. The highest
number counts. So readers see all old or all new tables whatever fails on the
way, and of two writers that began at one version the later one is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


class ConcurrentCommit(RuntimeError):
    """The store has moved on since the version that a commit was made for."""


class SchemaMismatch(ValueError):
    """A stored column can't become the wanted one without losing values."""


#: Types a stored one may widen to, without a loss. fixed values
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp",),
    "void": (),
}


class TableStore:
    """The tables below ``root``, in any file system that Spark writes to and that renames files atomically."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path().getFileSystem(self.conf)

    def _path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def version(self) -> int:
        """The number of the last commit; 0 before the first."""
        folder = self._path("commits")
        if not self.fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return max((int(n[:-5]) for n in names if n[:-5].isdigit() and n.endswith(".json")), default=0)

    def tables(self, version: int | None = None) -> dict[str, str]:
        """Each table's folder, relative to the root, at a version (the last)."""
        version = self.version() if version is None else version
        if not version:
            return {}
        stream = self.fs.open(self._path("commits", f"{version:012}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def has(self, name: str) -> bool:
        return name in self.tables() or self.fs.exists(self._path(name))

    def folder(self, name: str, version: int | None = None) -> str:
        """Where a table's Parquet files are; a folder of the table's own name, from before the first commit, counts where no commit names it."""
        return f"{self.root}/{self.tables(version).get(name, name)}"

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.folder(name, version))

    def commit(self, outputs: Mapping[str, DataFrame], since: int | None = None, replace: bool = True) -> int:
        """Writes the tables and makes them current at once; others stay. Returns the new version.

        ``since`` is the version that the outputs were made from; if the store
        has moved on, or moves on meanwhile, ConcurrentCommit is raised and
        nothing changes. Without ``replace`` an existing table is an error.
        """
        began = self.version()
        if since is not None and since != began:
            raise ConcurrentCommit(f"version {since} was read, the store is at {began}")
        if not replace and (there := [n for n in outputs if self.has(n)]):
            raise FileExistsError(", ".join(there))
        attempt = f"data/{uuid.uuid4().hex}"
        try:
            for name, df in outputs.items():
                df.write.parquet(f"{self.root}/{attempt}/{name}")
            self._publish(began + 1, self.tables(began) | {name: f"{attempt}/{name}" for name in outputs})
        except BaseException:
            self.fs.delete(self._path(attempt), True)
            raise
        return began + 1

    def _publish(self, version: int, tables: dict[str, str]) -> None:
        """The commit: a finished file gets its number, unless another has it."""
        hidden, final = self._path("commits", f".{uuid.uuid4().hex}"), self._path("commits", f"{version:012}.json")
        stream = self.fs.create(hidden, False)
        stream.write(bytearray(json.dumps(tables, sort_keys=True, indent=1).encode()))
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(hidden, final, options)  # refuses a name that is there
        except Exception as error:
            self.fs.delete(hidden, False)
            if self.fs.exists(final):
                raise ConcurrentCommit(f"version {version} was committed by another writer") from error
            raise

    def vacuum(self, keep: int = 1) -> int:
        """Deletes folders that none of the last ``keep`` commits names; returns how many. Not while a commit is being written."""
        last = self.version()
        live = {f.split("/")[1] for v in range(max(1, last - keep + 1), last + 1) for f in self.tables(v).values() if f.startswith("data/")}
        folder = self._path("data")
        dead = [s.getPath() for s in self.fs.listStatus(folder) if s.getPath().getName() not in live] if self.fs.exists(folder) else []
        for path in dead:
            self.fs.delete(path, True)
        for v in range(1, last - keep + 1):
            self.fs.delete(self._path("commits", f"{v:012}.json"), False)
        return len(dead)

    def ensured(self, name: str, schema: str | StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
        """A table as ``conformed`` to a schema; an empty one where it doesn't exist yet."""
        wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if not self.has(name):
            return self.spark.createDataFrame([], wanted)
        return conformed(self.read(name), wanted, defaults)


def _fits(stored: DataType, wanted: DataType) -> bool:
    if isinstance(stored, ArrayType) and isinstance(wanted, ArrayType):
        return _fits(stored.elementType, wanted.elementType)
    if isinstance(stored, StructType) and isinstance(wanted, StructType):
        return stored.fieldNames() == wanted.fieldNames() and all(_fits(a.dataType, b.dataType) for a, b in zip(stored, wanted, strict=True))
    a, b = stored.simpleString(), wanted.simpleString()
    return a == b or a == "void" or b in WIDER.get(a, ())


def conformed(table: DataFrame, schema: str | StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """``table`` with the columns of ``schema``, in its order, then any of its own that the schema doesn't name.

    A missing column is added with its default, or null; a narrower stored type
    is widened. Any other difference, such as a long where an int is wanted or
    a null default for a column that mustn't be null, is a SchemaMismatch.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    defaults = defaults or {}
    stored = {f.name: f for f in table.schema}
    columns = []
    for field in wanted:
        if field.name not in stored:
            if not field.nullable and defaults.get(field.name) is None:
                raise SchemaMismatch(f"{field.name} is missing and has no default")
            columns.append(F.lit(defaults.get(field.name)).cast(field.dataType).alias(field.name))
        elif _fits(stored[field.name].dataType, field.dataType):
            columns.append(F.col(f"`{field.name}`").cast(field.dataType).alias(field.name))
        else:
            raise SchemaMismatch(f"{field.name} is stored as {stored[field.name].dataType.simpleString()}, wanted {field.dataType.simpleString()}")
    return table.select(*columns, *[F.col(f"`{c}`") for c in table.columns if c not in wanted.fieldNames()])
