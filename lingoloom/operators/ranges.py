"""Global order and skewed joins without a single task: running totals over ranges, joins that broadcast frequent keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges at most, rows in a range about, keys looked at for the cuts about.
RANGES, ROWS, LOOKED_AT = 256, 50_000, 4096


def _cuts(rows: DataFrame, keys: list[Column], ranges: int) -> list:
    """Keys that cut ``rows`` into about equal ranges, from the rows with the least hashes of their keys."""
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    some = rows.select(*named).orderBy(F.xxhash64(*keys)).limit(LOOKED_AT).collect()  # bounded by LOOKED_AT
    some = sorted(t for t in map(tuple, some) if None not in t)
    return sorted({some[len(some) * k // ranges] for k in range(1, ranges)} if some else ())


def range_of(keys: list[Column], cuts: list[tuple], types: list[str]) -> Column:
    """How many of the sorted ``cuts`` are not above the keys, by bisection: the same for the same keys in every plan. Null keys come first."""
    if not cuts:
        return F.lit(0)
    at = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(c, types, strict=True))]) for c in cuts])
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when((n + s <= len(cuts)) & (F.get(at, n + s - 1) <= key), n + s).otherwise(n))


def running_total(rows: DataFrame, order: list[Column], value: Column, name: str, ranges: int | None = None) -> DataFrame:
    """``rows`` plus ``name`` (long): the sum of ``value`` over the rows before each, in ascending ``order`` (at most 2**63).

    Rows are dealt into ranges whose cuts are fixed first, so a row's range
    follows from its key alone, however often and under whatever plan it is
    computed. Rows of equal keys must be few; their order is not defined.
    """
    nested = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *[k.alias(f"k{i}") for i, k in enumerate(order)], value.cast("long").alias("value"))
    keys = [F.col(f"k{i}") for i in range(len(order))]
    if ranges is None:
        ranges = max(1, min(RANGES, nested.count() // ROWS))
    types = [nested.schema[f"k{i}"].dataType.simpleString() for i in range(len(order))]
    cuts = _cuts(nested, keys, ranges) if ranges > 1 else []
    nested = nested.withColumn("part", range_of(keys, cuts, types))
    sums = nested.groupBy("part").agg(F.sum("value").alias("sum"))
    before = sums.select("part", (F.sum("sum").over(Window.orderBy("part")) - F.col("sum")).alias("before"))  # a row a range
    inside = F.sum("value").over(Window.partitionBy("part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)) - F.col("value")
    return nested.withColumn("inside", inside).join(F.broadcast(before), "part").select("row.*", (F.col("inside") + F.col("before")).alias(name))


def join_split(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``left`` joined (inner or left) with ``right``, which has one row a key and a column ``frequent``; frequent keys, of which there must be a bounded number, are broadcast instead of landing in one task each."""
    common, rest = F.broadcast(right.where("frequent").drop("frequent")), right.where("not frequent").drop("frequent")
    return left.join(common, on).unionByName(left.join(common.select(on), on, "left_anti").join(rest, on, how))
