"""Duplicates and caps as if documents were read one after another."""

import random

import pytest

from lingoloom.operators.harvest import HarvestConfig, dedup_and_cap, within_total

SCHEMA = "id long, window int, window_start int, position int, sentence string, start int, reason string, keep_reason string, key string, disposition string"
RANK = {"conditional": 0, "mixed_harmony": 1, "general_sample": 2}


def sequential(rows, cap, total):
    """(id, window, position) kept, by one scan over the documents in order."""
    seen, out, counts = set(), [], {}
    for doc in sorted({r[0] for r in rows}):
        own, found = set(), []
        for r in sorted((r for r in rows if r[0] == doc), key=lambda r: (r[1], r[3])):
            if r[9] != "candidate":
                fate = r[9]
            elif r[8] in own:
                fate = "doc_duplicate"
            elif r[8] in seen:
                fate = "global_duplicate"
            else:
                own.add(r[8])
                found.append(r)
                continue
            counts[fate] = counts.get(fate, 0) + 1
        found.sort(key=lambda r: (RANK[r[7]], r[2] + r[5], r[4]))
        kept = found if cap is None else found[:cap]
        counts["doc_cap"] = counts.get("doc_cap", 0) + len(found) - len(kept)
        counts["kept"] = counts.get("kept", 0) + len(kept)
        kept = kept if total is None else kept[: max(0, total - len(out))]
        out += [(r[0], r[1], r[3]) for r in kept]
        seen |= {r[8] for r in kept}
    return sorted(out), {k: v for k, v in counts.items() if v}


def drawn(docs, keys, seed):
    """Documents over few keys; one key in nearly every document, some rows that other rules drop."""
    rng = random.Random(seed)
    rows = []
    for d in range(docs):
        for i in range(rng.randrange(12)):
            key = "common" if rng.random() < 0.2 else f"k{rng.randrange(keys)}"
            rows.append((d, i // 5, 100 * (i // 5), i % 5, f"s {key}", i * 7 % 50, "accepted", rng.choice(list(RANK)), key, rng.choice(["candidate"] * 5 + ["skipped_quality"])))
    return rows


@pytest.mark.parametrize(("seed", "cap", "total"), [(1, 2, None), (2, 1, None), (3, 3, 20), (4, None, None), (5, 100, None)])
def test_equals_a_sequential_scan(spark, seed, cap, total):
    rows = drawn(25, 14, seed)
    config = HarvestConfig(max_candidates_per_doc=cap or 0, max_candidates=total, exhaustive=cap is None)
    fates = dedup_and_cap(spark.createDataFrame(rows, SCHEMA).repartition(3), config)
    want, counts = sequential(rows, cap, None if total is None else total)
    got = within_total(fates.where("disposition = 'kept'"), config)
    assert sorted((r.id, r.window, r.position) for r in got.collect()) == want
    if total is None:
        assert {r.disposition: r["count"] for r in fates.groupBy("disposition").count().collect()} == counts


def test_a_chain_of_documents(spark):
    """Each document's cap frees a key for the next, so the owners move along all of them."""
    rows = [(d, 0, 0, i, f"s{k:02}", i, "accepted", "conditional", f"k{k:02}", "candidate") for d in range(8) for i, k in enumerate((d, d + 1))]
    fates = dedup_and_cap(spark.createDataFrame(rows, SCHEMA), HarvestConfig(max_candidates_per_doc=1))
    want, counts = sequential(rows, 1, None)
    assert sorted((r.id, r.window, r.position) for r in fates.where("disposition = 'kept'").collect()) == want and counts["kept"] == 8
