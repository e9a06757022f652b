"""Toxicity on invented texts with known marks, held-out accuracy, and odd inputs."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"
TABLES = "/root/testdata/sf0.1"


def corpus(rng, n=400):
    plain = ["".join(rng.choice(list("aeiorstln"), 5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = rng.choice(plain, 60).tolist()
        if bad:
            for _ in range(3):
                words.insert(int(rng.integers(0, 50)), str(rng.choice(["grumbleswine", "Vilething,", "zugzwangle"])))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_invented_marks_are_learnt_from_rows_that_are_not_held_out(spark, documents):
    rows, labels = corpus(np.random.default_rng(2))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "x" * 200_000), (1004, "word " * 60_000), (1005, rows[0][1])]
    # Wrong labels on held-out rows must not matter.
    wrong = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    frames = [spark.createDataFrame(x, LABELS) for x in (labels, wrong + wrong + [(None, 1, 1), (3, 1, None), (9999, 0, 1)])]
    docs = documents(rows + [(7, rows[7][1]), (None, rows[5][1])]).withColumn("score", F.lit("clash"))
    first, second = (
        {r.doc_id: (r.held_out, r.score, r.predicted) for r in toxicity.document_toxicity(docs, f).collect()} for f in frames
    )
    assert set(first) == {i for i, _ in rows} | {None}
    truth = {i: t for i, _, t in labels}
    wrong_side = [i for i, t in truth.items() if first[i][2] != t]
    assert len(wrong_side) <= 4
    for i, (h, score, predicted) in first.items():
        assert h == (i is not None and held(i)) and 0 <= score <= 1 and predicted == int(score >= 0.7)
    assert first[1000] == (held(1000), *first[1001][1:]) and first[1001][2] == 0 and first[1005][1:] == first[0][1:]
    assert [i for i in first if first[i][2] != second[i][2] and i != 3] == []


def test_long_texts_do_not_empty_the_sample(spark, documents, monkeypatch):
    rows, labels = corpus(np.random.default_rng(4))
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 120_000)
    given = []
    monkeypatch.setattr(toxicity, "train", lambda rows, stands_for: given.append((rows, stands_for)))
    long = next(i for i, _, t in labels if t and not held(i))
    rows[long] = (long, "long " * 50_000)
    toxicity.fit(documents(rows), spark.createDataFrame(labels, LABELS))
    learnt = [k for i, _, k in labels if not held(i)]
    sample, stands_for = given[0]
    texts = {k: [t for t, y in sample if y == k] for k in (0, 1)}
    assert len(texts[1]) == sum(learnt) - 1 and 0 < len(texts[0]) < len(learnt) - sum(learnt)
    assert all(sum(map(len, t)) <= 60_000 for t in texts.values())
    for k, t in texts.items():
        assert stands_for[k] * len(t) == pytest.approx(learnt.count(k))
    # Nothing but texts beyond the bound: one of each class is learnt all the same.
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 10)
    toxicity.fit(documents(rows), spark.createDataFrame(labels, LABELS))
    assert sorted(y for _, y in given[1][0]) == [0, 1]


def test_without_labels_and_empty_tables(spark, documents):
    rows, _ = corpus(np.random.default_rng(3), 20)
    none = spark.createDataFrame([], LABELS)
    assert {r.predicted for r in toxicity.document_toxicity(documents(rows), none).collect()} == {0}
    only = spark.createDataFrame([(i, 1, 1) for i in range(20)], LABELS)
    assert all(0 <= r.score <= 1 for r in toxicity.document_toxicity(documents(rows), only).collect())
    assert toxicity.document_toxicity(documents([]), only).collect() == []


def test_stage_keeps_columns_and_clean_rows(spark, documents):
    rows, labels = corpus(np.random.default_rng(4))
    frame = documents(rows)
    kept = toxicity.without_toxic(frame, spark.createDataFrame(labels, LABELS))
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    clean = {i for i, _, t in labels if not t}
    assert clean <= ids and len(ids - clean) <= 8


def test_every_byte_reaches_a_window():
    for chunk in ('"vilething,', "a" * 40, "one/two_three\u00a0four", "don't", "--", "n\u0303x1", "\u00e9t\u00e9" * 9, "x" * 20 + "/y"):
        assert b"".join(toxicity._parts(chunk.encode())) == "".join(chunk.split()).encode()
    for text in ("\u4f60\u597d\u4e16\u754c" * 30, "\u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35"):
        data = text.encode()
        assert toxicity._parts(data) == [data[i : i + 12] for i in range(0, len(data), 3)]
    assert b"vilething," in toxicity._parts(b'"vilething,') and b"bad" in toxicity._parts("x\u00a0bad".encode())
    assert toxicity._parts(b"a" * 30) == [b"a" * 12, b"a" * 12, b"a" * 6]


def test_marks_behind_quotes_in_long_chunks_and_without_spaces():
    rng = np.random.default_rng(7)
    plain = ["".join(rng.choice(list("aeiorstln"), 5)) for _ in range(300)]
    signs = [chr(c) for c in range(0x4E00, 0x4E00 + 200)]
    rows = []
    for i in range(400):
        words, bad = rng.choice(plain, 40).tolist(), i % 5 == 0
        marks = ["vilething", "zugzwangle", "\u60e1\u8a00\u8f9e"] * bad
        for m in marks[:2]:
            words.insert(int(rng.integers(0, 30)), m)
        text = rng.choice(signs, 60).tolist()
        text[30:30] = marks[2:]
        rows.append(((" ".join(words) + " " + "".join(text)).encode(), int(bad)))
    score = toxicity.train(rows, {0: 1.0, 1: 1.0}).scorer()
    clean = " ".join(plain[:40])
    signs = "".join(rng.choice(signs, 60))
    hits = [
        clean + ' "vilething" (zugzwangle) "vilething', "/".join([*plain[:40], "vilething", "zugzwangle", "vilething"]),
        "\u00a0".join([*plain[:40], "vilething", "zugzwangle", "vilething"]), signs + "\u60e1\u8a00\u8f9e" + signs + "\u60e1\u8a00\u8f9e",
    ]
    assert min(score([h.encode() for h in hits])) >= toxicity.REJECT
    assert max(score([clean.encode(), signs.encode(), "/".join(plain[:40]).encode()])) < toxicity.REJECT


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_held_out_accuracy(spark):
    read = lambda n: spark.read.parquet(f"{TABLES}/{n}.parquet")
    out = toxicity.document_toxicity(read("documents"), read("labels")).where("held_out")
    got = {(r.predicted, r.toxic): r["count"] for r in out.join(read("labels"), "doc_id").groupBy("predicted", "toxic").count().collect()}
    assert got[1, 1] / (got[1, 1] + got[0, 1]) > 0.85
    assert got.get((1, 0), 0) / (got[0, 0] + got.get((1, 0), 0)) < 0.01
