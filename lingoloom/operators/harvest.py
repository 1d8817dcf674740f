"""From documents to candidate sentences: windows, segmentation, filters, duplicates and caps."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingoloom.functions.profile import TATAR, LanguageProfile
from lingoloom.functions.segment import document_windows, sentences
from lingoloom.functions.sentence_quality import sentence_quality
from lingoloom.functions.text import count_specific, distinct_letters, harmony_class, has_conditional, hash_uniform, sentence_key, words_in

from .kept import Kept
from .ranges import RANGES, ROWS, _cuts, join_split, range_of, running_total


@dataclass(frozen=True)
class HarvestConfig:
    min_chars: int = 20
    max_chars: int = 400
    seed: int = 13
    max_docs: int | None = None
    max_candidates: int | None = 250_000
    max_candidates_per_doc: int = 30
    max_doc_chars: int = 20_000
    window_chars: int = 4_000
    windows_per_doc: int = 5
    general_keep_probability: float = 0.03
    min_specific_letters: int = 2
    exhaustive: bool = False
    #: A sentence of several documents belongs to the first that keeps it under its cap; without this, to the first that has it as a candidate.
    owners_keep: bool = True
    profile: LanguageProfile = TATAR


#: Order in which a document's sentences are kept. fixed values
PRIORITY = {"conditional": 0, "mixed_harmony": 1, "general_sample": 2, "exhaustive": 3}


def keep_reason(sentence: Column, draw: Column, config: HarvestConfig = HarvestConfig()) -> Column:
    """Why a sentence is kept; null where it isn't. ``draw`` is its number in [0, 1)."""
    if config.exhaustive:
        return F.lit("exhaustive")
    words = words_in(sentence, config.profile)
    return (
        F.when(F.exists(words, lambda w: has_conditional(w, config.profile)), "conditional")
        .when(F.exists(words, lambda w: harmony_class(w, config.profile) == "mixed_front_back"), "mixed_harmony")
        .when(draw < config.general_keep_probability, "general_sample")
    )


def segment_documents(docs: DataFrame, config: HarvestConfig = HarvestConfig()) -> DataFrame:
    """(id, window, window_start, position, sentence, start, end, reason): every sentence of every window."""
    windows = docs.select("id", F.explode(document_windows(F.coalesce("text", F.lit("")), config.max_doc_chars, config.window_chars, config.windows_per_doc, config.exhaustive)).alias("w"))
    found = F.posexplode(sentences(F.col("w.text"), config.min_chars, config.max_chars, config.profile)).alias("position", "s")
    return windows.select("id", F.col("w.index").alias("window"), F.col("w.start").alias("window_start"), found).select("id", "window", "window_start", "position", "s.*")


def judge_sentences(segments: DataFrame, config: HarvestConfig = HarvestConfig()) -> DataFrame:
    """``segments`` plus keep_reason, quality, key and disposition: the first rule that drops a sentence, or ``candidate``."""
    draw = hash_uniform(config.seed, F.col("id"), F.col("sentence"))
    judged = segments.withColumn("keep_reason", keep_reason(F.col("sentence"), draw, config)).withColumn("quality", sentence_quality(F.col("sentence"), config.profile)).withColumn("key", sentence_key(F.col("sentence")))
    language = F.lit(False) if config.exhaustive else count_specific(F.col("sentence"), config.profile) < config.min_specific_letters
    artifact = F.lit(False) if config.exhaustive else F.col("quality.is_artifact")
    disposition = F.when(F.col("reason") != "accepted", F.col("reason")).when(F.col("keep_reason").isNull(), "skipped_general").when(language, "skipped_language").when(artifact, "skipped_quality").otherwise("candidate")
    return judged.withColumn("disposition", disposition)


def _shared(rows: DataFrame) -> DataFrame:
    """(key, owner, frequent) of the keys of ``rows`` (id, key) that several documents have, with the first of these."""
    keys = rows.groupBy("key").agg(F.min("id").alias("owner"), F.max("id").alias("last"), F.count("*").alias("times"))
    return keys.where("owner < last").select("key", "owner", (F.col("times") * 1000 > rows.count()).alias("frequent"))


def _scanned(frame: pd.DataFrame) -> pd.DataFrame:
    """(key, block, keeper) that a block's documents keep, read one after another: rows (id, key, at, own, block, cap, taken).

    ``own`` counts the rows before this one that no other document has, ``taken``
    says that an earlier block keeps the key.
    """
    kept: dict[object, object] = {}
    doc, free = None, 0
    frame = frame.sort_values(["id", "at"], kind="stable")
    cap, block = int(frame["cap"].iloc[0]), frame["block"].iloc[0]
    for i, key, own, taken in zip(frame["id"], frame["key"], frame["own"], frame["taken"], strict=True):
        if i != doc:
            doc, free = i, 0
        if taken or key in kept:
            continue
        free += 1
        if own + free <= cap:
            kept[key] = i
    return pd.DataFrame({"key": pd.Series(list(kept), dtype=object), "block": [block] * len(kept), "keeper": pd.Series(list(kept.values()), dtype=frame["id"].dtype)})


def _keepers(rows: DataFrame, cap: int, blocks: int | None = None) -> DataFrame:
    """(key, owner, frequent) of the keys that several documents of ``rows`` (id, key, place) share: the first document that keeps each.

    Documents keep, in their order, their first ``cap`` rows by place whose key
    no earlier document has kept. Only rows with shared keys are in question;
    they are cut into blocks of whole documents in order. Each round every
    block is scanned once, given what the blocks before it kept in the last
    round; as a block is right once those before it are, there are at most as
    many rounds as blocks, however long a chain of documents is, and few where
    chains don't run through all of them. A key that nobody keeps has no owner.
    The outcome, a row a shared key, stays cached in sessions without a
    checkpoint folder.
    """
    kept = Kept()
    shared = kept(_shared(rows))
    marked = join_split(rows, shared.select("key", F.lit(True).alias("several"), "frequent"), "key", "left").repartition("id")
    by_place = Window.partitionBy("id").orderBy("place")
    alone = F.when(F.col("several"), 0).otherwise(1)
    asked = marked.select("id", "key", "several", F.row_number().over(by_place).alias("at"), F.sum(alone).over(by_place.rowsBetween(Window.unboundedPreceding, 0)).alias("own")).where("several").drop("several")
    asked = kept(asked)
    n = max(1, min(RANGES, asked.count() // ROWS)) if blocks is None else blocks
    cuts = _cuts(asked, [F.col("id")], n) if n > 1 else []
    asked = asked.withColumn("block", range_of([F.col("id")], cuts, [asked.schema["id"].dataType.simpleString()])).withColumn("cap", F.lit(cap))
    schema = f"key {asked.schema['key'].dataType.simpleString()}, block int, keeper {asked.schema['id'].dataType.simpleString()}"
    keepers = kept(shared.select("key", F.lit(None).cast("int").alias("block"), F.lit(None).cast(asked.schema["id"].dataType).alias("keeper"), "frequent"))
    for _ in range(len(cuts) + 2):
        taken = join_split(asked, keepers.select("key", F.col("block").alias("first"), "frequent"), "key", "left").withColumn("taken", F.coalesce(F.col("first") < F.col("block"), F.lit(False)))
        found = taken.drop("first").groupBy("block").applyInPandas(_scanned, schema)
        first = found.groupBy("key").agg(F.min(F.struct("block", "keeper")).alias("now"))
        moved = keepers.join(first, "key", "left").select("key", F.col("now.block").alias("block"), F.col("now.keeper").alias("keeper"), "frequent", (~F.col("now.keeper").eqNullSafe(F.col("keeper"))).alias("moved"))
        moved = kept(moved)
        at_rest = moved.where("moved").isEmpty()
        kept.free(keepers)
        keepers = moved
        if at_rest:
            break
    kept.free(shared, asked)
    return keepers.select("key", F.col("keeper").alias("owner"), "frequent")


def _windows_overlap(config: HarvestConfig) -> bool:
    """Whether two windows of a text may share characters (see ``document_windows``); sentences of one window begin at different places."""
    if config.exhaustive or config.window_chars <= 0:
        return False
    budget = min(config.max_doc_chars, config.window_chars * config.windows_per_doc)
    return config.window_chars * max(1, min(config.windows_per_doc, -(-budget // config.window_chars))) > config.max_doc_chars


def dedup_and_cap(judged: DataFrame, config: HarvestConfig) -> DataFrame:
    """Dispositions ``doc_duplicate``, ``global_duplicate`` and ``doc_cap``; ``kept`` for the rest of the candidates, with their rank.

    As if documents were read one after another by id: a sentence counts as a
    duplicate once an earlier document has kept it, cap included. Without
    ``owners_keep`` it does once an earlier document has it, and what a document
    repeats is a ``doc_duplicate`` first.

    The judged sentences are kept, as segmenting is dear. Only keys and places
    of candidates are shuffled; texts, where the table has them, meet their
    fates once. A table without ``sentence`` is taken for one of few narrow
    columns, which go along.
    """
    candidate = F.col("disposition") == "candidate"
    digest = F.coalesce(F.when(F.length("key") == 64, F.unhex("key")), F.encode("key", "utf-8"))  # half as long
    judged = Kept()(judged.withColumn("key", F.when(candidate, digest)).withColumn("row", F.monotonically_increasing_id()))
    priority = F.coalesce(*[F.when(F.col("keep_reason") == k, F.lit(v)) for k, v in PRIORITY.items()])
    wide, order = "sentence" in judged.columns, ["window", "position"]
    order = ["sentence", *order] if wide and _windows_overlap(config) else order
    place = F.struct(priority.alias("priority"), (F.col("window_start") + F.col("start")).alias("at"), *order)
    along = [] if wide else [c for c in judged.columns if c not in ("row", "id", "window", "position", "key", "disposition")]
    rows = judged.where(candidate).select("row", "id", "window", "position", "key", place.alias("place"), *along)
    cap = None if config.exhaustive else config.max_candidates_per_doc
    in_doc = Window.partitionBy("id", "key").orderBy("window", "position")
    if cap is None or not config.owners_keep:
        owners = Kept()(_shared(rows.select("id", "key")))
    else:
        first = rows.select("id", "key", "window", "position", "place").repartition("id").withColumn("nth", F.row_number().over(in_doc)).where("nth = 1")
        owners = _keepers(first.select("id", "key", "place"), cap)
    # dealt out by id once, which serves both windows
    once = join_split(rows, owners.select("key", "owner", "frequent"), "key", "left").repartition("id")
    once = once.withColumn("nth", F.row_number().over(in_doc)).withColumn("place", F.when(F.col("nth") == 1, F.col("place")))
    earlier, repeated = F.coalesce(F.col("owner") < F.col("id"), F.lit(False)), F.col("nth") > 1
    fate = F.when(earlier, "global_duplicate").when(repeated, "doc_duplicate") if config.owners_keep else F.when(repeated, "doc_duplicate").when(earlier, "global_duplicate")
    ranked = once.withColumn("fate", fate).withColumn("rank", F.row_number().over(Window.partitionBy("id", "fate").orderBy("place")))
    over = F.lit(False) if cap is None else F.col("rank") > cap
    ranked = ranked.withColumn("disposition", F.when(F.col("fate").isNotNull(), F.col("fate")).when(over, "doc_cap").otherwise("kept"))
    if wide:
        ranked = judged.where(candidate).drop("disposition").join(ranked.select("row", "disposition", "rank"), "row")
    columns = [c for c in judged.columns if c not in ("row", "key")]
    rest = judged.where(~F.coalesce(candidate, F.lit(False))).withColumn("rank", F.lit(None).cast("int"))
    return ranked.select(*columns, "rank").unionByName(rest.select(*columns, "rank"))


def within_total(kept: DataFrame, config: HarvestConfig) -> DataFrame:
    """The first ``max_candidates`` kept sentences in document order, by counts per document."""
    if config.max_candidates is None or config.exhaustive:
        return kept
    counts = kept.groupBy("id").agg(F.count("*").alias("n"))
    start = running_total(counts, [F.col("id")], F.col("n"), "before").where(F.col("before") < config.max_candidates).select("id", "before")
    return kept.join(start, "id").where(F.col("before") + F.col("rank") <= config.max_candidates).drop("before")


def prepare(docs: DataFrame, config: HarvestConfig = HarvestConfig()) -> DataFrame:
    """Candidate sentences of ``docs`` (id, text), in the schema that selection reads.

    Of a document, sentences with conditional letters come first, then those
    with mixed harmony, then a hash sample of the others. A sentence that several
    documents have is a candidate of the first that keeps it under its cap. With
    ``exhaustive`` whole texts are read and no sample, filter or cap applies.
    """
    if config.max_docs is not None:
        docs = docs.orderBy("id").limit(config.max_docs)
    kept = dedup_and_cap(judge_sentences(segment_documents(docs, config), config), config).where("disposition = 'kept'")
    kept = within_total(kept, config)
    letters = distinct_letters(F.col("sentence"), config.profile.specific)
    return kept.select(
        F.col("id").cast("string").alias("id"),
        (F.col("rank") - 1).alias("source_sentence_index"),
        (F.col("window_start") + F.col("start")).alias("source_start_char"),
        (F.col("window_start") + F.col("end")).alias("source_end_char"),
        F.col("keep_reason").alias("reason"),
        F.col("window").alias("index"),
        count_specific(F.col("sentence"), config.profile).alias("tatar_specific_letter_count"),
        letters.alias("tatar_specific_letters"),
        F.col("quality.penalty").alias("quality_penalty"),
        F.array_join("quality.reasons", ",").alias("quality_reasons"),
        "sentence",
    )


def diagnostics(docs: DataFrame, config: HarvestConfig = HarvestConfig()) -> DataFrame:
    """(counter, n): what became of every sentence, and each quality reason."""
    return counters(dedup_and_cap(narrow(judge_sentences(segment_documents(docs, config), config), reasons()), config))


def reasons() -> Column:
    """The reasons of sentences that fail by their quality, as ``counters`` reads them."""
    return F.struct(F.when(F.col("disposition") == "skipped_quality", F.col("quality.reasons")).alias("reasons")).alias("quality")


def narrow(judged: DataFrame, *columns: Column) -> DataFrame:
    """What ``dedup_and_cap`` needs of judged sentences where no texts are wanted, and ``columns``."""
    return judged.select("id", "window", "window_start", "position", "start", "keep_reason", "key", "disposition", *columns)


def counters(fates: DataFrame) -> DataFrame:
    """(counter, n) of judged sentences with their dispositions."""
    named = F.concat(F.array("disposition"), F.when(F.col("disposition") == "skipped_quality", F.transform("quality.reasons", lambda r: F.concat(F.lit("skipped_quality:"), r))).otherwise(F.array().cast("array<string>")), F.when(F.col("disposition") == "kept", F.array(F.concat(F.lit("kept:"), "keep_reason"))).otherwise(F.array().cast("array<string>")))
    return fates.select(F.explode(named).alias("counter")).groupBy("counter").agg(F.count("*").alias("n"))
