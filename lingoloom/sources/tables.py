"""Readers and writers: JSON lines, Parquet, JSON documents, and pairs of outputs that appear together."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lingoloom.functions.variant import items
from lingoloom.operators.kept import Kept

from .store import TableStore

SAMPLES = "id string, source_id string, text string"
STATE = "sample_id string, status string, tatar int, tokens_json string, attempts int, last_error string, updated_at string"
#: States as they are kept since models are named; older tables get the column when they are read.
STATE_WITH_MODEL = STATE + ", annotated_by_model string"
REVIEWED = "normalized_word string, zamanalif_dsl string, origin string, updated_at string"
EXPORTED = "normalized_word string, exported_at string"


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Blank lines are skipped; a malformed line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_review_export(spark: SparkSession, path: str) -> DataFrame:
    """(nth, task variant) of a JSON array of review tasks, whatever their shapes; (-1, variant) of a file that holds something else.

    One file is parsed by one task, as JSON has no place to cut; its tasks are dealt out from there.
    """
    whole = spark.read.option("multiLine", True).option("singleVariantColumn", "v").option("mode", "FAILFAST").json(path)
    tasks = F.when(items(F.col("v")).isNull(), F.array(F.struct(F.lit(-1).alias("nth"), F.col("v").alias("task")))).otherwise(F.transform(items(F.col("v")), lambda t, i: F.struct(i.alias("nth"), t.alias("task"))))
    return whole.select(F.explode(tasks).alias("t")).select("t.*").repartition(spark.sparkContext.defaultParallelism)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object a line with its keys in order."""
    df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)]).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_document(row: DataFrame, path: str) -> None:
    """A report of a single row as an indented JSON file."""
    data = row.select(F.to_json(F.struct("*")).alias("j")).first()["j"]
    Path(path).write_text(json.dumps(json.loads(data), indent=2, sort_keys=True, ensure_ascii=False) + "\n")


def write_report(report: dict, path: str) -> None:
    """A report as an indented JSON file."""
    Path(path).write_text(json.dumps(report, indent=2, ensure_ascii=False) + "\n")


def write_json_array(rows: DataFrame, path: str, *order: str) -> None:
    """One JSON array file of the rows, in order, below ``path``: ranges of lines are sorted by a stage of their own, then one task writes them as they stream by."""
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([("[]",)], "value string").coalesce(1).write.mode("overwrite").text(path)
    lines = rows.orderBy(*order).select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in order])).alias("j")) if order else rows.select(F.to_json(F.struct("*")).alias("j"))

    def bracketed(frames):  # noqa: ANN001, ANN202
        import pandas as pd

        before = "["
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"value": [before + frame["j"].iloc[0], *("," + j for j in frame["j"].iloc[1:])]})
                before = ","
        yield pd.DataFrame({"value": ["]"]})

    with Kept() as kept:
        lines = kept(lines)
        lines.count()  # sorts in parallel; what follows reads finished ranges
        lines.coalesce(1).mapInPandas(bracketed, "value string").write.mode("overwrite").text(path)


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` dealt over all cores when they are read in fewer splits than there are cores, as one row group is one task."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, *by) if rows.rdd.getNumPartitions() < 4 * cores else rows


def selected_tables(selected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, state) of (rank, id, sentence): ids sent_000001... in rank order, all pending."""
    samples = selected.select(F.format_string("sent_%06d", "rank").alias("id"), F.col("id").cast("string").alias("source_id"), F.col("sentence").alias("text"))
    none = lambda kind: F.lit(None).cast(kind)
    state = samples.select(F.col("id").alias("sample_id"), F.lit("pending").alias("status"), none("int").alias("tatar"), none("string").alias("tokens_json"), F.lit(0).alias("attempts"), none("string").alias("last_error"), none("string").alias("updated_at"))
    return samples, state


def write_together(outputs: dict[str, DataFrame], root: str, force: bool = False, since: int | None = None) -> int:
    """Commits all tables to the store at ``root`` at once (see ``store``); other tables there stay. Returns the version.

    Without ``force`` an existing table is an error. With ``since``, so is a
    store that has changed since that version.
    """
    return TableStore(next(iter(outputs.values())).sparkSession, root).commit(outputs, since, replace=force)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the store at ``root``, as of its last commit."""
    return TableStore(spark, root).read(name)
