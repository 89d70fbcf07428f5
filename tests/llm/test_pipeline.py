"""Each stage of the pipeline against a brute-force version, on what its predecessor kept."""

from __future__ import annotations

import re

import corpus_pipeline
from tests.llm.test_operators import WORDS, brute_decontam, lower
from tidelog.llm import mixing, quality


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = WORDS.findall(lower(text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], small).persist())
    rows = [s.select("doc_id", "text").collect() for s in steps]
    ids = [sorted(r[0] for r in step) for step in rows]

    labels = spark.read.parquet(f"{small}/labels.parquet")
    good = quality.judge(docs, labels).where("predicted = 1")
    assert ids[1] == sorted(r["doc_id"] for r in good.collect())

    best = {}
    for doc_id, text in rows[1]:
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best[key] = min(best.get(key, (1, 0)), (-len(text or ""), doc_id))
    assert ids[2] == sorted(b[1] for b in best.values())

    sets = {doc_id: shingles(text) for doc_id, text in rows[2]}
    alike = {
        (a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        for a in sets for b in sets if a < b and sets[a] & sets[b]
    }
    kept = set(ids[3])
    assert not [p for p, s in alike.items() if s >= 0.8 and p[0] in kept and p[1] in kept]
    for lost in set(ids[2]) - kept:
        assert max(s for p, s in alike.items() if lost in p) >= 0.8

    items = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {w[0] for w in brute_decontam(rows[3], items) if not w[5]}
    assert set(ids[4]) == clean

    taken = {}
    for r in steps[5].collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    want = {r["doc_id"]: r["taken"] for r in mixing.report(steps[4]).collect() if r["taken"]}
    assert taken == want
    for step in steps[1:5]:
        assert step.columns == docs.columns


def test_run_gives_the_last_stage(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert {"doc_id", "text", "copy", "taken", "position"} <= set(out.columns) and out.count() > 0
