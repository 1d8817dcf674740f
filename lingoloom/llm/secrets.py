"""Secrets in whole texts, and how widely each candidate is owned across the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingoloom.operators.ranges import join_split

from .scratch import Scratch

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Kinds in the order that breaks ties; ``owned`` are the method's own candidates.
KINDS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("owned", r"[A-Za-z0-9_-]{24,}"))
#: Values that occur in documentation: never live.
PLACEHOLDER = "example|changeme|placeholder|dummy|sample|your[_-]|xxxx"
#: Owners and repositories that an owner-specific credential has at most.
MAX_OWNERS, MAX_REPOSITORIES = 2, 4


def live_looking(value: Column) -> Column:
    """Letters and digits, eight different characters at least, and no placeholder."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 8) & ~F.lower(value).rlike(PLACEHOLDER)


def _found(docs: DataFrame) -> DataFrame:
    """A row a match: doc_id, text_hash, owner, repository, kind_no, start, end (code points), value."""
    per_kind = F.array(*[F.struct(F.lit(k).alias("kind_no"), F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias("hits"), (F.regexp_extract_all("text", F.lit(p), F.lit(2)) if k == 0 else F.lit(None).cast("array<string>")).alias("inner")) for k, (_, p) in enumerate(KINDS)])
    kinds = docs.select("doc_id", "text_hash", "owner", "repository", "text", F.explode(per_kind).alias("k")).where("size(k.hits) > 0")
    gaps = F.lit(None).cast("array<string>")
    for k, (_, p) in enumerate(KINDS):
        gaps = F.when(F.col("k.kind_no") == k, F.split("text", p, -1)).otherwise(gaps)
    lengths = F.transform(gaps, F.length)
    rows = kinds.select("doc_id", "text_hash", "owner", "repository", "k.kind_no", F.posexplode(F.arrays_zip(lengths.alias("gap"), F.col("k.hits").alias("hit"), F.coalesce("k.inner", "k.hits").alias("value"))).alias("place", "m"))
    rows = rows.select("doc_id", "text_hash", "owner", "repository", "kind_no", "place", F.col("m.gap").alias("gap"), F.col("m.hit").alias("hit"), F.col("m.value").alias("value")).where("hit is not null")
    # rows that repeat a document count once
    rows = rows.dropDuplicates(["doc_id", "text_hash", "owner", "repository", "kind_no", "place"])
    so_far = Window.partitionBy("doc_id", "text_hash", "owner", "repository", "kind_no").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("hit")).over(so_far)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit")).where("kind_no <> 0 or length(value) >= 12")
    live = (F.col("kind_no") < 3) | (live_looking(F.col("value")) & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]"))
    return rows.where(live).select("doc_id", "text_hash", "owner", "repository", "kind_no", "start", "end", "value")


def scan_secrets(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row a document: doc_id, spans array<struct<start,kind_no,end,kind,live,copied,n_owners,n_repositories>>.

    Three base kinds are always reported: assignments, access ids and long hex
    runs, leftmost without overlap per kind; positions are code points, the end
    is exclusive. Every candidate's SHA-256 is counted by distinct repositories
    and owners over the whole corpus. A candidate that more than ``max_owners``
    owners or more than ``max_repositories`` repositories hold is a widely
    copied example, even if one owner made all the copies; one that fewer hold
    and that looks live is a credential. Mixed tokens of 24 characters or more outside the base
    spans are reported as kind ``owned`` in that case only.

    Null and empty texts have no spans. Rows that repeat id, text, owner and
    repository are one document, each gets its spans. A null owner or
    repository is one of its own. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    hashed = lambda *cs: F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in cs])
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"), hashed(owner_col).alias("owner"), hashed(*repository_cols).alias("repository"))
    found = scratch.save(_found(docs).withColumn("secret", F.sha2("value", 256)))
    # distinct (secret, owner, repository) first: a secret that a third of all rows hold is small by then
    total = found.count()
    held = found.groupBy("secret", "owner", "repository").agg(F.count("*").alias("times")).groupBy("secret", "owner").agg(F.count("*").alias("n"), F.sum("times").alias("times"))
    owners = held.groupBy("secret").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"), (F.sum("times") * 1000 > total).alias("frequent"))
    spans = join_split(found, owners, "secret")
    kind = F.element_at(F.array(*[F.lit(k) for k, _ in KINDS]), F.col("kind_no") + 1)
    copied = (F.col("n_owners") > max_owners) | (F.col("n_repositories") > max_repositories)
    live = live_looking(F.col("value")) & ~copied
    spans = spans.where((F.col("kind_no") < 3) | live).select("doc_id", "text_hash", "owner", "repository", F.struct("start", "kind_no", "end", kind.alias("kind"), live.alias("live"), copied.alias("copied"), "n_owners", "n_repositories").alias("span"))
    grouped = spans.groupBy("doc_id", "text_hash", "owner", "repository").agg(F.sort_array(F.collect_list("span")).alias("all"))
    base = F.filter("all", lambda s: s["kind_no"] < 3)
    apart = F.filter("all", lambda s: (s["kind_no"] < 3) | ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    grouped = grouped.withColumn("base", base).select("doc_id", "text_hash", "owner", "repository", apart.alias("spans"))
    keys = docs.select("doc_id", "text_hash", "owner", "repository")
    same = keys["text_hash"].eqNullSafe(grouped["text_hash"]) & keys["doc_id"].eqNullSafe(grouped["doc_id"]) & (keys["owner"] == grouped["owner"]) & (keys["repository"] == grouped["repository"])
    return keys.join(grouped, same, "left").select(keys["doc_id"], F.coalesce(grouped["spans"], F.array().cast(grouped.schema["spans"].dataType)).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(found: DataFrame) -> DataFrame:
    """Counts, digest and text of the spans of ``scan_secrets``."""
    base = F.filter("spans", lambda s: s["kind_no"] < 3)
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda k: count(lambda s: s["kind_no"] == k)
    return found.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{name}") for k, (name, _) in enumerate(KINDS[:3])],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: s["copied"]).alias("n_copied"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["n_repositories"])), F.lit(0)).cast("long").alias("most_repositories"),
    )
