"""Rules, lasso and the compiled expression on made-up statistics, held-out accuracy, and odd inputs."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import quality

LABELS = "doc_id long, quality int, toxic int"
TABLES = "/root/testdata/sf0.1"


def test_conjunction_is_found_and_few_rules_stay(spark):
    rng = np.random.default_rng(1)
    x = rng.random((1500, len(quality.STATISTICS)))
    y = (~((x[:, 3] > 0.6) & (x[:, 7] <= 0.5))).astype(float)
    model = quality.train(x, y, {0: 1.0, 1: 1.0})
    z = model.constant + sum(w * quality._holds(r, x) for r, w in model.rules)
    assert ((z >= 0) == (y == 1)).mean() > 0.97
    assert len(model.rules) < len(quality.tree_rules(x, y, np.ones(1500)))
    frame = spark.createDataFrame([(r.tolist(),) for r in x[:200]], "__statistics array<double>")
    got = [r[0] for r in frame.select(model.column()).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-z[:200])))
    assert any("same_as_previous" in line for line in model.text())


def test_lasso_drops_what_does_not_matter():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (800, 30)).astype(float)
    y = x[:, 4]
    b, v = quality.lasso_logistic(x, y, np.ones(800), 0.01)
    assert v[4] > 1 and np.abs(np.delete(v, 4)).max() < 0.1 and (v == 0).sum() > 15


def corpus(rng, n=300):
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = ["".join(rng.choice(list("aeiorst"), 5)) for _ in range(40)]
        rows.append((i, " ".join(words) + "." if good else " | ".join(words)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_documents(spark, documents):
    rows, labels = corpus(np.random.default_rng(3))
    rows += [(900, None), (901, ""), (902, "  \n"), (903, "x" * 300_000), (904, "some words " * 40_000), (1, rows[1][1])]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    flipped += [(None, 0, 0), (5, None, 1), (7777, 1, 0)]
    docs = documents([*rows, (None, rows[0][1])]).withColumn("score", F.lit("clash"))
    out = quality.document_quality(docs, spark.createDataFrame(flipped, LABELS)).collect()
    assert len(out) == len(rows) + 1
    by_id = {r.doc_id: r for r in out}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert all(by_id[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows)
    assert sum(by_id[i].predicted != q for i, q, _ in labels) <= 2
    assert by_id[900].score == by_id[901].score and by_id[None].predicted == 0 and not by_id[None].held_out
    kept = quality.without_poor(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i, q, _ in labels if q} <= ids and len(ids & {i for i, q, _ in labels if not q}) <= 2


def test_without_labels_and_empty_tables(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.document_quality(documents([(1, "a"), (2, None)]), none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], LABELS)
    assert {r.predicted for r in quality.document_quality(documents([(1, "a"), (2, "b"), (3, "c")]), one).collect()} == {1}
    assert quality.document_quality(documents([]), one).collect() == []


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_held_out_accuracy(spark):
    read = lambda n: spark.read.parquet(f"{TABLES}/{n}.parquet")
    out = quality.document_quality(read("documents"), read("labels")).where("held_out").join(read("labels"), "doc_id")
    right = out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.98
