"""The pipeline stage by stage against brute-force versions on a small corpus."""

from __future__ import annotations

import numpy as np
import public_tokenizers

import corpus_pipeline
from parcelflow.llm import packing, quality, toxicity
from tests.llm.test_decontaminate import BENCH, brute
from tests.llm.test_packing import check, greedy, whole_ids
from tests.llm.test_simhash import brute_classes

LABELS = "doc_id long, quality int, toxic int"


def corpus(rng):
    plain = ["".join(rng.choice(list("aeiorstln"), 6)) for _ in range(400)]
    rows, labels, clean = [], [], set()
    for i in range(240):
        words = rng.choice(plain, 50).tolist()
        toxic, poor = i % 8 == 1, i % 8 == 2
        if toxic:
            words[5:5] = ["grumbleswine"] * 2 + ["vilething"] * 2
        rows.append((i, (" | " if poor else " ").join(words)))
        labels.append((i, int(not poor), int(toxic)))
        if not toxic and not poor:
            clean.add(i)
    items = [(1, " ".join(rng.choice(plain, 30))), (2, " ".join(rng.choice(plain, 14)))]
    rows += [(500, rows[0][1]), (501, rows[0][1].upper()), (502, items[0][1] + " end"), (503, "x " + items[1][1])]
    rows += [(504, None), (505, ""), (None, rows[3][1]), (506, rows[4][1] + " " + " ".join(rng.choice(plain, 5000)))]
    return rows, labels, items, clean


def test_stages_and_run(spark, documents, tmp_path):
    rows, labels, items, clean = corpus(np.random.default_rng(8))
    at = str(tmp_path)
    documents(rows).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, BENCH).write.parquet(f"{at}/benchmark.parquet")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    labelled = spark.read.parquet(f"{at}/labels.parquet")
    before, columns = docs, docs.columns
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    outputs = []
    for (name, stage), step in zip(corpus_pipeline.STAGES, range(5), strict=True):
        stage(spark, before, at).write.parquet(f"{at}/{step}")
        after = spark.read.parquet(f"{at}/{step}")
        if step < 4:
            assert after.columns == columns, name
        outputs.append(after)
        before = after
    texts = [sorted(((r.doc_id, r.text) for r in o.collect()), key=str) for o in outputs[:4]]
    verdict = {r.doc_id: r.predicted for r in toxicity.document_toxicity(docs, labelled).collect()}
    assert texts[0] == sorted(((i, t) for i, t in kept if not verdict[i]), key=str)
    verdict = {r.doc_id: r.predicted for r in quality.document_quality(outputs[0], labelled).collect()}
    assert texts[1] == sorted(((i, t) for i, t in texts[0] if verdict[i]), key=str)
    groups = {}
    for (i, t), (j, _, c) in zip(sorted(texts[1], key=lambda r: str(r[0])), sorted(brute_classes(texts[1]), key=lambda r: str(r[0])), strict=True):
        assert i == j
        groups.setdefault(c, []).append((i, t))
    assert sorted(i for i, _ in texts[2] if i is not None) == sorted(c for c in groups if c is not None)
    assert texts[3] == [(i, t) for i, t in texts[2] if not brute(t, items)[4]]
    # Clean documents stay; copies, contaminated, toxic and poor ones go.
    left = {i for i, _ in texts[3]}
    assert len(clean - left) <= 2 and not left & {500, 501, 502, 503}
    assert len(left & {i for i, q, t in labels if t or not q}) <= 2
    pieces = outputs[4].collect()
    sizes = [len(whole_ids(t)) for _, t in texts[3]]
    assert sum(r["length"] for r in pieces) == sum(sizes)
    cut = [min(4096, n - s) for n in sizes for s in range(0, n, 4096)]
    assert sorted(r["length"] for r in pieces) == sorted(cut) and check(pieces, 4096) == greedy(cut, 4096)
    run = corpus_pipeline.run(spark, at).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r["length"], r.ids_crc32)
    assert sorted(map(key, run), key=str) == sorted(map(key, pieces), key=str)


def test_empty_tables(spark, documents, tmp_path):
    at = str(tmp_path)
    documents([]).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([], BENCH).write.parquet(f"{at}/benchmark.parquet")
    assert corpus_pipeline.run(spark, at).collect() == []
    assert packing.CAPACITY == 4096 and public_tokenizers.path("word_bpe_49k.json")
