"""The bounded samples of labelled documents that the classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, seed: int) -> DataFrame:
    """(doc_id, text, label) of up to ``per_class`` labelled documents of either class.

    Those with the least hash of (seed, id) are taken, whatever their number.
    Only ids and labels are sorted; the texts are picked out where they lie,
    as 2 * per_class ids at most are broadcast. Null ids, null labels and
    labels other than 0 and 1 are never taken; of contradicting labels of one
    id the greater counts, and of several texts of one id the least.
    """
    clean = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").where(learn)
    clean = clean.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    picked = [clean.where(F.col("label") == k).orderBy(order, "doc_id").limit(per_class) for k in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).select("doc_id", "text", "label")
