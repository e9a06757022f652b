"""Top lists against all pairs in plain Python integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import blocks, top_scores
from parcelflow.llm.blocks import LIMIT

SCHEMA = "vec_id long, embedding array<double>, label int"


def whole(vector, factor):
    return [math.floor(factor * x) for x in vector]


def usable(row, factor):
    i, v = row[:2]
    return i is not None and v is not None and all(x is not None and math.isfinite(factor * x) for x in v)


def brute(rows, every, k, factor=64):
    rows = [(r[0], whole(r[1], factor)) for r in rows if usable(r, factor)]
    out = []
    for q, a in rows:
        if q % every == 0:
            found = []
            for i, b in rows:
                if i != q and len(a) == len(b):
                    score = sum(x * y for x, y in zip(a, b, strict=True))
                    found.append((-max(-LIMIT, min(LIMIT, score)), i))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], start=1)]
    return sorted(out)


def vectors(rng, n=300, dim=6):
    rows = [(i, rng.normal(size=dim).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(60)]  # one very common vector, ties by id
    rows += [(n + 100 + i, [0.0] * dim) for i in range(5)]
    rows += [(20, rows[7][1]), (41, rows[8][1]), (41, rows[8][1])]  # repeated ids
    rows += [(500, [1.0, 2.0]), (501, [-1.0, 0.5]), (502, [3.0, 3.0]), (520, []), (521, [])]
    rows += [(None, rows[0][1]), (540, None), (541, [None] * dim), (560, [math.nan] * dim), (561, [math.inf] + [1.0] * (dim - 1))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("score", F.lit("clash")).repartition(3)


def result(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize(("block", "chunk"), [(2048, 2048), (7, 50)])
def test_rows_against_all_pairs(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", block)
    monkeypatch.setattr(blocks, "CHUNK_ROWS", chunk)
    rows = vectors(np.random.default_rng(5))
    got = result(top_scores.embedding_top(frame(spark, rows), every=20, k=10))
    assert got == brute(rows, 20, 10)


def test_fewer_rows_than_asked_for(spark):
    rows = vectors(np.random.default_rng(6), n=10)[:12]
    assert result(top_scores.embedding_top(frame(spark, rows), every=5, k=20)) == brute(rows, 5, 20)


@pytest.mark.parametrize("size", [3e4, 1e8, 1e30])
def test_large_components_stay_exact(spark, size):
    rng = np.random.default_rng(7)
    rows = [(i, (size * rng.normal(size=4)).tolist()) for i in range(80)]
    assert result(top_scores.embedding_top(frame(spark, rows), every=10, k=5)) == brute(rows, 10, 5)


def test_empty_tables(spark):
    assert result(top_scores.embedding_top(frame(spark, []))) == []
    assert result(top_scores.embedding_top(frame(spark, [(1, [1.0]), (2, [1.0])]))) == []


def test_cutoff_is_safe_and_phases_prune():
    rng = np.random.default_rng(8)
    # A few queries close to a few rows: their cutoffs leave out most of the others.
    base = rng.normal(size=(10, 16)) * 64
    rows = np.floor(np.concatenate([base + rng.normal(size=base.shape), rng.normal(size=(500, 16)) * 8]))
    queries = blocks.Rows(np.arange(10), -1 - np.arange(10), None, np.floor(base))
    scores = top_scores.Scores(queries, blocks.Rows(np.arange(510), np.arange(510), None, rows), 4)
    cutoff = top_scores.local_lists(scores, 1)[:, 0]
    q, r, s = top_scores.reaching(scores, cutoff)
    exact = np.floor(base) @ rows.T
    assert (cutoff <= exact.max(axis=1)).all()
    assert sorted(zip(q, r, strict=True)) == sorted(zip(*np.nonzero(exact >= cutoff[:, None]), strict=True))
    assert (exact[q, r] == s).all() and len(q) < 100
