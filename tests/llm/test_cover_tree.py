"""Links and classes against all pairs in plain numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import cover_tree as C

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.95):
    good = [
        v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
        for _, v in rows
    ]
    n = len(rows)
    group, links = list(range(n)), [0] * n
    unit = [C.unit(np.array([v], float))[0] if g else None for (_, v), g in zip(rows, good, strict=True)]
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                if group[i] != group[j]:
                    a, b = group[i], group[j]
                    group = [b if g == a else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(
        ((i, links[k], least.get(group[k]), i is not None and i == least.get(group[k])) for k, (i, _) in enumerate(rows)),
        key=str,
    )


def corpus(rng, dim=8):
    rows = [(100 + i, rng.normal(size=dim).astype(np.float32)) for i in range(150)]
    rows += [(400 + i, rows[i % 7][1] + rng.normal(size=dim).astype(np.float32) * s) for i, s in enumerate(np.linspace(0.02, 0.5, 120))]
    rows += [(600 + i, rows[0][1]) for i in range(30)] + [(650 + i, rows[1][1] * np.float32(2 + i)) for i in range(5)]
    chain = [math.radians(10 * k) for k in range(12)]  # neighbours link, ends do not
    rows += [(700 + k, np.array([math.cos(a), math.sin(a), *[0] * (dim - 2)], np.float32)) for k, a in enumerate(chain)]
    rows = [(i, v.tolist()) for i, v in rows]
    rows += [(1, None), (2, []), (3, [0.0] * dim), (4, [None, *[1.0] * (dim - 1)]), (5, [math.nan] * dim), (6, [math.inf] * dim)]
    rows += [(7, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [-1.0, -2.0]), (10, [-0.0, 1.0]), (11, [0.0, 1.0]), (None, rows[2][1]), (None, [5.0])]
    return rows + [(100, rows[0][1])]


@pytest.mark.parametrize("block", [None, 40])
def test_rows_against_all_pairs(spark, monkeypatch, block):
    if block:
        for name in ("BLOCK", "LARGEST_BLOCK"):
            monkeypatch.setattr(C, name, block)
    rows = corpus(np.random.default_rng(4))
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("n_links", F.lit("clash"))
    out = C.vector_classes(frame.repartition(3)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out), key=str) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_walk_against_matrix(seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(30, 6))
    made = [C.unit(base[rng.integers(0, 30, 300)] + rng.normal(size=(300, 6)) * rng.choice([0.01, 0.1, 0.4])) for _ in range(2)]
    trees, points = [], []
    for u in made:
        order, levels = C.build(u)
        for row, radius in zip(levels, C.RADII, strict=True):
            assert (np.diff(row) >= 0).all()
            for k in np.unique(row):  # nested nodes within their radius of the first row
                inside = u[order][row == k]
                assert C._distances(inside[:1], inside).max() <= 2 * radius + 1e-6
        weight = rng.integers(1, 4, 300)
        trees.append(C.Tree(u[order], weight, levels))
        points.append((u[order], weight))
    for b in (None, trees[1]):
        walk = C.Walk(trees[0], b, 0.95)
        walk.run()
        (u, w), (v, x) = points[0], points[0 if b is None else 1]
        near = u @ v.T >= 0.95
        if b is None:
            np.fill_diagonal(near, False)
            assert walk.links.tolist() == (near @ x).tolist()
        else:
            assert walk.links.tolist() == [*(near @ x).tolist(), *(near.T @ w).tolist()]
        i, j = np.nonzero(near)
        want = C.merge_links(np.arange(len(walk.links)), i, j + (0 if b is None else 300))
        assert (walk.parent == want).all()


def test_empty_table(spark):
    assert C.vector_classes(spark.createDataFrame([], SCHEMA)).collect() == []
    only = spark.createDataFrame([(1, None, 0), (1, [0.0], 0)], SCHEMA)
    assert {tuple(r) for r in C.vector_classes(only).collect()} == {(1, 0, 1, True)}


def test_vectors_without_structure_are_not_opened_one_by_one(monkeypatch):
    # Node pairs of a wide first level, taken one by one, took nearly all of the time of a large table.
    opened = []
    one_by_one = C.Walk._nodes

    def counted(self, level, i, j):
        opened.append(len(i))
        one_by_one(self, level, i, j)

    monkeypatch.setattr(C.Walk, "_nodes", counted)
    made = [C.unit(np.random.default_rng(k).normal(size=(3000, 64))) for k in range(2)]
    trees = []
    for u in made:
        order, levels = C.build(u)
        trees.append(C.Tree(u[order], np.ones(3000, int), levels))
    for b in (trees[1], None):
        walk = C.Walk(trees[0], b, 0.95)
        walk.run()
        assert not walk.links.any()
    assert sum(opened) < 2 * 3000


@pytest.mark.parametrize("tile", [1, 7, 64])
def test_products_of_any_size(monkeypatch, tile):
    monkeypatch.setattr(C, "TILE", tile)
    test_walk_against_matrix(1)
