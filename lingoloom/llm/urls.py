"""URL filter rules by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingoloom.operators.ranges import join_split

#: Rule lists up to this many rows are broadcast; longer ones are joined by a shuffle.
BROADCAST_RULES = 100_000
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z in lower case; empty where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return _lowered(host)


def _lowered(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame | Sequence[tuple[str, str, str]] = RULES, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict.

    A rule (host, path, verdict) fits its host and all subdomains if the url's
    path begins with the rule's. Every distinct URL is expanded into its host
    suffixes of as many labels as rules have, combined with its path prefixes
    of the lengths that rules have,
    joined to the rules on the first 8 hex digits of SHA-256, confirmed on the
    full digest. The longest rule (host and path) wins, block before allow
    among equals. Without a rule the verdict is ``default``.

    A null URL or one without :// has an empty host and path, no rule, and the
    default verdict. Repeated rows stay. Repeated rules count once. Other
    columns are ignored.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    rules = rules.select(_lowered(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")).distinct()
    digest = _digest(F.col("rule_host"), F.col("rule_path"))
    hashed = rules.withColumn("full", digest).withColumn("short", F.substring(digest, 1, 8))
    bounds = rules.agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.length("rule_path"))).alias("lengths"), F.array_sort(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("labels")).first()  # as many as there are different lengths
    if bounds["n"] <= BROADCAST_RULES:
        hashed = F.broadcast(hashed)
    pages = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    total = pages.count()
    distinct = pages.where("url is not null").groupBy("url").agg((F.count("*") * 1000 > total).alias("frequent"))
    urls = distinct.select("url", "frequent", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where("host <> ''")
    numbers = lambda known: F.array(*map(F.lit, known)) if known else F.array().cast("array<int>")
    lengths = numbers(bounds["lengths"])
    suffix = lambda n: F.substring_index(F.col("host"), ".", -n)
    n_labels = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit(""))) + 1
    suffixes = F.array(*[F.when(n_labels >= n, suffix(n)) for n in bounds["labels"]]) if bounds["labels"] else F.array().cast("array<string>")
    suffixes = F.filter(suffixes, lambda s: s.isNotNull())
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = urls.select("url", "frequent", F.explode(suffixes).alias("host_part"), prefixes.alias("prefixes")).select("url", "frequent", "host_part", F.explode("prefixes").alias("path_part"))
    expressions = expressions.withColumn("full", _digest(F.col("host_part"), F.col("path_part"))).withColumn("short", F.substring("full", 1, 8))
    hits = expressions.join(hashed, "short").where((expressions["full"] == hashed["full"]) & (F.col("host_part") == F.col("rule_host")) & (F.col("path_part") == F.col("rule_path")))
    best = hits.groupBy("url").agg(F.first("frequent").alias("frequent"), F.max(F.struct((F.length("rule_host") + F.length("rule_path")).alias("size"), (F.col("rule_verdict") == "block").alias("block"), F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict"))).alias("best"))
    best = best.select("url", "frequent", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    known = join_split(pages.where("url is not null"), best, "url", "left")
    nothing = F.lit(None).cast("string")
    known = known.unionByName(pages.where("url is null").select("url", "page_id", nothing.alias("rule"), nothing.alias("verdict")))
    return known.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
