"""Fingerprints and classes against plain Python."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from parcelflow.llm import simhash
from parcelflow.llm.components import components


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").findall("[^\x20\x09-\x0d]+", low)]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    group = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            if (prints[x][1] ^ prints[y][1]).bit_count() <= 2 and group[x] != group[y]:
                a, b = group[x], group[y]
                group = [b if g == a else g for g in group]
    least = {}
    for (i, _), g in zip(prints, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(((i, f"{p:016x}", least.get(g)) for (i, p), g in zip(prints, group, strict=True)), key=str)


def corpus(rng):
    vocab = [f"w{i}" for i in range(60)]
    rows = [(1000 + i, " ".join(rng.choice(vocab, 300))) for i in range(25)]
    for i in range(60):  # near copies: one word of many changed
        words = rows[i % 8][1].split()
        words[int(rng.integers(0, 300))] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(500 + i, t) for i, t in enumerate([None, "", " \t\n", "one", "One", "two words", "TWO\x0bwords", "a b c", "A  b\nc", "é\xa0x É"])]
    rows += [(700, rows[0][1]), (700, rows[0][1].upper()), (None, rows[3][1]), (None, "alone without an id at all"), (701, "long " * 40_000)]
    return rows


@pytest.mark.parametrize("limit", [None, 2])
def test_documents_against_all_pairs(spark, documents, monkeypatch, limit):
    if limit:
        monkeypatch.setattr(simhash, "SUBTREE", limit)  # a cut down to few fingerprints, beyond 16 bits for near copies
    rows = corpus(np.random.default_rng(3))
    out = simhash.document_classes(documents(rows).withColumn("fingerprint", F.lit("clash"))).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out), key=str) == brute_classes(rows)


@pytest.mark.parametrize("seed", range(5))
def test_trie_walk_and_cut(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    near = base[rng.integers(0, 60, 400)] ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)) ^ (
        np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)
    )
    values = np.unique(np.concatenate([base, near, np.arange(70, dtype=np.uint64), ~np.arange(9, dtype=np.uint64)]))
    a, b = values[::2], values[1::2]
    distance = lambda x, y: np.bitwise_count(x[:, None] ^ y[None, :])
    for x, y, same in ((a, b, False), (values, values, True)):
        found = [(int(i), int(j)) for p, q in simhash.close_pairs(x, y, 2, same) for i, j in zip(p, q, strict=True)]
        want = {(int(i), int(j)) for i, j in zip(*np.nonzero(distance(x, y) <= 2), strict=True) if not same or i < j}
        assert len(found) == len(set(found)) and {tuple(sorted(f)) if same else f for f in found} == want
    counts = {int(k): int(n) for k, n in zip(*np.unique(values >> np.uint64(48), return_counts=True), strict=True)}
    cut = sorted(simhash.cut_trie(counts, 16, 5), key=lambda c: c[0] << (64 - c[1]))
    starts = [p << (64 - d) for p, d in cut]
    at = np.searchsorted(np.array(starts, np.uint64), values, side="right") - 1
    assert all(int(v) >> (64 - cut[k][1]) == cut[k][0] for v, k in zip(values, at.tolist(), strict=True))
    pairs = set(simhash.subtree_pairs(cut, 2))
    for i, j in zip(*np.nonzero(distance(values, values) <= 2), strict=True):
        assert tuple(sorted((int(at[i]), int(at[j])))) in pairs


@pytest.mark.parametrize("seed", range(3))
def test_components_against_plain_search(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))]
    edges += [(200 + i, 201 + i) for i in range(40)] + [(400, 300 + i) for i in range(50)] + [(7, 7)]
    roots = {}
    for a, b in edges:
        if a != b:
            roots.setdefault(a, a), roots.setdefault(b, b)
    for _ in range(200):
        for a, b in edges:
            if a != b:
                roots[a] = roots[b] = min(roots[a], roots[b])
    out = components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()
    assert sorted((r.node, r.root) for r in out) == sorted(roots.items())
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_class_stays(spark, documents):
    rows = corpus(np.random.default_rng(4))
    frame = documents(rows).withColumn("__x", F.lit(1)).withColumn("root", F.lit("clash"))
    kept = simhash.one_per_class(frame)
    assert kept.columns == frame.columns
    groups = {}
    for r in simhash.document_classes(documents(rows)).collect():
        groups.setdefault((r.component_id, r.component_id is None and r.fingerprint), []).append(r.doc_id)
    want = sorted((min((i for i in ids if i is not None), default=None) for ids in groups.values()), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want
    assert simhash.document_classes(documents([])).collect() == [] and simhash.one_per_class(documents([])).collect() == []
