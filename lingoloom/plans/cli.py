"""Command line: one command a stage, tables in and out."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lingoloom.functions.dsl import PREFERRED, policy
from lingoloom.operators import dictionary, harvest, lexicon, report, training
from lingoloom.operators import features as feats
from lingoloom.operators import select as choose
from lingoloom.functions.sentence_quality import sentence_quality
from lingoloom.functions.text import count_specific, sentence_key, stable_sort_key
from lingoloom.sources import tables
from lingoloom.sources.store import TableStore, conformed

#: Columns of the tables of a database; those in EMPTY may not exist yet.
SCHEMAS = {"samples": tables.SAMPLES, "preannotation_state": tables.STATE_WITH_MODEL, "reviewed_words": tables.REVIEWED, "exported_words": tables.EXPORTED}
DEFAULTS = {"preannotation_state": {"attempts": 0}}
EMPTY = ("reviewed_words", "exported_words")


def _select(spark: SparkSession, a: argparse.Namespace) -> None:
    allowed = (count_specific(F.col("sentence")) >= a.min_specific_letters) & ~sentence_quality(F.col("sentence"))["is_artifact"]
    rows = spark.read.parquet(a.candidates).where(allowed).withColumn("key", stable_sort_key(a.seed, F.col("id"), F.col("source_sentence_index"), F.col("sentence"))).dropDuplicates(["key"])
    n = rows.count()
    band = (a.min_word_frequency, a.max_word_frequency)
    counts = feats.corpus_counts(rows)
    df = feats.corpus_document_frequencies(rows, *band, weighted_only=True, counts=counts, key="key").persist()
    scores = feats.corpus_scores(rows, "key", n, *band, counts=counts, frequencies=df).join(rows.select("key", F.col("id").alias("source"), "quality_penalty", sentence_key(F.col("sentence")).alias("text_key")), "key")
    scores = scores.withColumn("score", F.col("base_score") + F.col("diversity_score") - F.col("quality_penalty")).withColumn("sort_key", F.col("key"))
    short = choose.shortlist(scores, a.target_size, a.shortlist_size).persist()  # bounded by its size
    words = counts.where("code < 0").select("word", "frequency")
    features = feats.feature_table(rows.join(short.select("key"), "key", "left_semi"), "key", *band, words)
    chosen = choose.adaptive_selection(short, features, n, a.target_size, a.conditional_target_ratio, a.multi_conditional_target_ratio, a.source_penalty, frequencies=df)
    selected = rows.join(chosen, "key").join(short.select("key", "conditional_letter_count"), "key").persist()  # target_size rows
    samples, state = tables.selected_tables(selected)
    tables.write_together({"samples": samples, "preannotation_state": state, "selected": selected}, a.output, a.force)
    if a.report:
        own = feats.feature_table(selected, "key", *band, words)
        config = {"selection_strategy": "adaptive_greedy", "language_filter": "tatar_specific_letters", "min_tatar_specific_letters": a.min_specific_letters, "target_size": a.target_size}
        tables.write_report(report.selection_report(selected, own, a.seed, config), a.report)
    selected.unpersist()
    for kept in (short, df, counts):
        kept.unpersist()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lingoloom")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("prepare")
    c.add_argument("--documents", required=True)
    c.add_argument("--output", required=True)
    for name, default in (("min-chars", 20), ("max-chars", 400), ("seed", 13), ("max-candidates", 250_000), ("max-candidates-per-doc", 30), ("max-doc-chars", 20_000), ("window-chars", 4_000), ("windows-per-doc", 5), ("min-specific-letters", 2)):
        c.add_argument(f"--{name}", type=int, default=default)
    c.add_argument("--max-docs", type=int)
    c.add_argument("--general-keep-probability", type=float, default=0.03)
    c.add_argument("--exhaustive", action="store_true")
    c = sub.add_parser("select")
    c.add_argument("--candidates", required=True)
    c.add_argument("--output", required=True)
    for name, default in (("target-size", 10_000), ("seed", 13), ("min-word-frequency", 2), ("max-word-frequency", 10_000), ("shortlist-size", 250_000), ("min-specific-letters", 2)):
        c.add_argument(f"--{name}", type=int, default=default)
    for name, default in (("conditional-target-ratio", 0.85), ("multi-conditional-target-ratio", 0.5), ("source-penalty", 0.15)):
        c.add_argument(f"--{name}", type=float, default=default)
    c.add_argument("--force", action="store_true")
    c.add_argument("--report")
    c = sub.add_parser("report")
    c.add_argument("--selected", required=True)
    c.add_argument("--output", required=True)
    c = sub.add_parser("annotation-export")
    c.add_argument("--db", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--max-items", type=int)
    c.add_argument("--min-frequency", type=int, default=1)
    c.add_argument("--sort-by", default="frequency_desc")
    c.add_argument("--include-rl", action="store_true")
    c.add_argument("--include-unknown", action="store_true")
    c.add_argument("--track-exported", action="store_true")
    c.add_argument("--now", default="")
    c.add_argument("--report")
    c = sub.add_parser("annotation-import")
    c.add_argument("--db", required=True)
    c.add_argument("--input", required=True)
    c.add_argument("--now", required=True)
    c = sub.add_parser("training-export")
    c.add_argument("--db", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--choice", action="append", default=[])
    c.add_argument("--manifest")
    c = sub.add_parser("coverage")
    c.add_argument("--alignment", required=True)
    c.add_argument("--left", required=True)
    c.add_argument("--right", required=True)
    c.add_argument("--output", required=True)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("lingoloom").getOrCreate()
    store = TableStore(spark, a.db) if hasattr(a, "db") else None
    since = store.version() if store else None  # what this command reads, and must still hold when it commits
    table = lambda name: store.ensured(name, SCHEMAS[name], DEFAULTS.get(name)) if name in EMPTY else conformed(store.read(name, since), SCHEMAS[name], DEFAULTS.get(name))
    if a.command == "prepare":
        config = harvest.HarvestConfig(a.min_chars, a.max_chars, a.seed, a.max_docs, a.max_candidates, a.max_candidates_per_doc, a.max_doc_chars, a.window_chars, a.windows_per_doc, a.general_keep_probability, a.min_specific_letters, a.exhaustive)
        harvest.prepare(spark.read.parquet(a.documents), config).write.parquet(a.output)
    elif a.command == "select":
        _select(spark, a)
    elif a.command == "report":
        rows = tables.read_table(spark, a.selected, "selected")
        tables.write_together({"headline": report.headline(rows), "letters": report.letter_coverage(rows, "id"), "harmony": report.harmony_coverage(rows, "id"), "quality": report.quality_summary(rows)}, a.output, force=True)
    elif a.command == "annotation-export":
        tokens = dictionary.labelled_tokens(table("samples"), table("preannotation_state"))
        exported = table("exported_words")
        judged = dictionary.dispositions(dictionary.word_stats(tokens), table("reviewed_words"), exported if a.track_exported else exported.limit(0), a.include_rl, a.include_unknown, a.min_frequency)
        tasks = dictionary.review_tasks(judged, a.max_items, a.sort_by).select("number", F.struct("id", "cyrl_word", "auto_zamanalif", F.col("origin").alias("gemini_origin"), "hints_html").alias("data"))
        tables.write_json_array(tasks, a.output, "number")
        if a.report:
            tables.write_report(dictionary.full_export_report(judged, tokens, table("samples").count()), a.report)
        if a.track_exported:
            tables.write_together({"exported_words": dictionary.exported_now(exported, judged, a.max_items, a.sort_by, a.now)}, a.db, force=True, since=since)
    elif a.command == "annotation-import":
        merged = dictionary.import_reviews(table("reviewed_words"), tables.read_review_export(spark, a.input), a.now)
        tables.write_together({"reviewed_words": merged}, a.db, force=True, since=since)
    elif a.command == "training-export":
        dictionary_table = table("reviewed_words")
        training.check_reviewed(dictionary_table)
        in_force = policy(PREFERRED, *a.choice)
        pairs = training.training_pairs(table("samples"), table("preannotation_state"), dictionary_table, in_force)
        if bad := pairs.where("error is not null").limit(5).collect():
            raise SystemExit("; ".join(f"{r.id}: {r.error}" for r in bad))
        counts = training.manifest(table("samples"), table("preannotation_state"), pairs)
        tables.write_together({"training": pairs.where("reason is null").select("id", "cyrillic", "zamanalif"), "manifest": counts}, a.output, force=True)
        if a.manifest:
            chosen = dict(c.split("=", 1) for c in a.choice)
            tables.write_report(training.manifest_document(counts, in_force, chosen), a.manifest)
    elif a.command == "coverage":
        pairs = lexicon.distinct_pairs(lexicon.word_pairs(spark.read.parquet(a.alignment), spark.read.parquet(a.left), spark.read.parquet(a.right)))
        lexicon.coverage_summary(lexicon.coverage(pairs)).write.parquet(a.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
