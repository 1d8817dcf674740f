"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingoloom.operators.ranges import join_split

#: Sources up to this many are broadcast with their rates; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000
#: A mean above this is split into equal parts with a draw each, as exp(-mean) underflows beyond 700.
PART = 64


def uniform(*key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the SHA-256 of the key's parts joined by |."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("null")) for k in key]), 256), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson(mean: Column, *key: Column) -> Column:
    """The Poisson count at the quantile that the key's hash names; its own draw for every PART of the mean.

    Walks the distribution up to a count that is exceeded with probability
    below 1e-16, which a 52-bit quantile cannot reach.
    """
    parts = F.greatest(F.lit(1), F.ceil(mean / PART).cast("int"))

    def draw(part: Column) -> Column:
        lam = mean / parts
        top = (lam + 12 * F.sqrt(lam) + 40).cast("int")

        def count(u: Column) -> Column:
            start = F.struct(F.lit(0).alias("k"), F.exp(-lam).alias("p"), F.exp(-lam).alias("cdf"))
            step = lambda s, i: F.when(s["cdf"] > u, s).otherwise(F.struct(i.alias("k"), (s["p"] * lam / i).alias("p"), (s["cdf"] + s["p"] * lam / i).alias("cdf")))
            return F.aggregate(F.sequence(F.lit(1), top), start, step, lambda s: s["k"])

        # the draw is bound by a lambda so that it is hashed once
        return F.element_at(F.transform(F.array(uniform(*key, part)), count), 1)

    return F.aggregate(F.transform(F.sequence(F.lit(1), parts), draw), F.lit(0), lambda a, b: a + b)


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None, epochs: float, source_col: str, text_col: str) -> DataFrame:
    """(source, rate, frequent): mean copies of a document so that each source's expected characters meet its weight; frequent is a thousandth of all documents."""
    sizes = docs.groupBy(F.col(f"`{source_col}`").alias("source")).agg(F.sum(F.coalesce(F.length(F.col(f"`{text_col}`")), F.lit(0)).cast("long")).alias("chars"), F.count("*").alias("docs"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.sqrt(F.col("chars").cast("double")))
    else:
        pairs = [F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]
        sizes = sizes.withColumn("weight", F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)) if pairs else F.lit(0.0))
    weight = F.when(F.col("chars") > 0, F.col("weight")).otherwise(0.0).cast("decimal(38,12)")
    total = sizes.agg(F.sum("chars").alias("chars"), F.sum("docs").alias("docs"), F.sum(weight).cast("double").alias("weight")).first()
    alone = F.when(F.col("weight") > 0, 1.0).otherwise(float(weights is None))
    rate = F.lit(0.0) if not total["weight"] else F.lit(float(epochs)) * F.col("weight") / F.lit(total["weight"]) * F.lit(total["chars"]) / F.col("chars")
    rate = F.when(F.col("chars") == 0, alone).otherwise(rate)
    return sizes.select("source", rate.alias("rate"), (F.col("docs") * 1000 > F.lit(total["docs"] or 0)).alias("frequent"))


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = 1.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", copy_col: str | None = "copy_no") -> DataFrame:
    """``docs`` replicated to target weights and shuffled globally, plus copy_no (long, from 1), or another ``copy_col``, or none.

    A source's mean rate is epochs * weight share * all characters / its
    characters; each document is emitted as often as the Poisson distribution
    with that mean says at the quantile that the hash of (seed, id) names, and
    the copies are dealt to partitions, and sorted within them, by a hash of
    (seed, id, copy). Without ``weights`` a source weighs the square root of its
    characters. A source missing from ``weights`` weighs nothing.

    A null source is a source of its own (weight 0 where weights are given). A
    source without characters has the rate 1 if it weighs anything, or if no
    weights are given.
    Rows that repeat an id get the same count each. Null ids share one draw. A
    column of ``docs`` named as ``copy_col`` is replaced; other columns stay.
    """
    kept = [c for c in docs.columns if c != copy_col]
    rates = source_rates(docs, weights, epochs, source_col, text_col).select(_key("source"), "rate", "frequent")
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{id_col}`").alias("id"), _key(source_col))
    if rates.count() <= BROADCAST_SOURCES:
        rated = nested.join(F.broadcast(rates.drop("frequent")), "key")
    else:
        rated = join_split(nested, rates, "key")
    copies = poisson(F.col("rate"), F.lit(seed), F.col("id"))
    numbered = rated.select("row", "id", copies.alias("n")).where("n > 0").select("row", "id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long"))).alias("copy_no"))
    place = F.xxhash64(F.lit(seed), F.col("id"), F.col("copy_no"))
    return numbered.withColumn("place", place).repartition("place").sortWithinPartitions("place").select("row.*", *([F.col("copy_no").alias(copy_col)] if copy_col else []))


def _key(source_col: str) -> Column:
    source = F.col(f"`{source_col}`").cast("string")
    return F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name")).alias("key")
