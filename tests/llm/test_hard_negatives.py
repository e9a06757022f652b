"""Packed products and hard negatives against plain Python integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelflow.llm import blocks
from parcelflow.llm import hard_negatives as H
from parcelflow.llm.blocks import LIMIT

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every, shifted=7, factor=256):
    good = []
    for i, v, label in rows:
        if i is None or v is None or label is None or not all(x is not None and math.isfinite(x * factor) for x in v):
            continue
        good.append((i, [math.floor(factor * x) for x in v], (label + 1) % 10 if i % shifted == 0 else label))
    out = []
    for a, av, al in good:
        if a % every:
            continue
        scored = []
        for i, v, label in good:
            if len(v) == len(av):
                score = max(-LIMIT, min(LIMIT, sum(x * y for x, y in zip(av, v, strict=True))))
                scored.append((-score, i, label == al))
        scored.sort()
        for ps, p, _ in [s for s in scored if s[2] and s[1] != a][:5]:
            fit = [s for s in scored if not s[2] and 50 * -ps <= 100 * -s[0] <= 95 * -ps][:3]
            out += [(a, p, rank, n, -ps, -s) for rank, (s, n, _) in enumerate(fit, start=1)]
    return sorted(out)


def vectors(rng, n=250, dim=6):
    rows = [(i, rng.normal(size=dim).tolist(), int(rng.integers(0, 4))) for i in range(n)]
    rows += [(n + i, rows[5][1], 1) for i in range(60)]  # one very common vector, ties by id
    rows += [(n + 100 + i, rows[5][1], i % 3) for i in range(9)]
    rows += [(50, rows[7][1], 2), (31, rows[8][1], 2), (31, rows[8][1], 2)]  # repeated ids
    rows += [(500, [1.0, 2.0], 1), (501, [1.0, 1.9], 1), (502, [0.9, 1.0], 2), (550, [], 0), (551, [], 0), (552, [], 1)]
    rows += [(None, rows[0][1], 0), (400, None, 0), (403, [None] * dim, 0), (410, [math.nan] * dim, 0), (411, rows[0][1], None)]
    return rows + [(600, [0.0] * dim, 3), (601, [-x for x in rows[5][1]], 1)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("clash")).repartition(3)


def result(df):
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(map(tuple, df.select(*columns).collect()))


@pytest.mark.parametrize(("block", "chunk"), [(2048, 2048), (3, 40)])
def test_rows_against_all_pairs(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", block)
    monkeypatch.setattr(blocks, "CHUNK_ROWS", chunk)
    rows = vectors(np.random.default_rng(3))
    expected = brute(rows, 50)
    assert len(expected) > 20
    assert result(H.embedding_negatives(frame(spark, rows), every=50)) == expected


@pytest.mark.parametrize("size", [1e6, 1e30])
def test_large_components_stay_exact(spark, size):
    rng = np.random.default_rng(4)
    rows = [(i, (size * rng.normal(size=4)).tolist(), i % 3) for i in range(90)]
    assert result(H.embedding_negatives(frame(spark, rows), every=10)) == brute(rows, 10)


def test_empty_tables_and_lone_labels(spark):
    assert result(H.embedding_negatives(frame(spark, []))) == []
    assert result(H.embedding_negatives(frame(spark, [(50, [1.0], 1), (51, [0.9], 2)]))) == []
    assert result(H.embedding_negatives(frame(spark, [(1, [1.0], 1)]))) == []


integers = st.integers(-(2**70), 2**70) | st.integers(-300, 300)


@given(st.integers(0, 4).flatmap(lambda d: st.tuples(*(st.lists(st.lists(integers, min_size=d, max_size=d), min_size=1, max_size=5),) * 2)))
@settings(max_examples=150, deadline=None)
def test_packed_products_are_exact(sides):
    rows = []
    for side in sides:
        small = all(abs(v) < 2**53 for r in side for v in r)
        parts = np.array([[float(v) if small else v for v in r] for r in side], float if small else object)
        rows.append(blocks.Rows(np.arange(len(side)), np.arange(len(side)), None, parts.reshape(len(side), -1)))
    exact = [[max(-LIMIT, min(LIMIT, sum(x * y for x, y in zip(a, b, strict=True)))) for b in sides[1]] for a in sides[0]]
    assert H.score_matrix(*rows).tolist() == exact


def test_rows_of_zeros_under_a_very_large_anchor():
    one = lambda v, kind: blocks.Rows(np.arange(1), np.arange(1), None, np.array([[v]], kind))
    assert H.score_matrix(one(-(2**63), object), one(0, float)).tolist() == [[0]]
