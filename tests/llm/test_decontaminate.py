"""The FM-index against plain search, and contamination against the rule in plain Python and SQL."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from parcelflow.llm import decontaminate as D
from parcelflow.llm.fm_index import FMIndex, WaveletTree, sort_suffixes

BENCH = "item_id long, text string"


def brute(text, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    ws, hit, named = split(text), set(), set()
    for name, t in items:
        its = split(t)
        size = min(13, len(its))
        if not size:
            continue
        windows = {tuple(its[i : i + size]) for i in range(len(its) - size + 1)}
        for i in range(len(ws) - size + 1):
            if tuple(ws[i : i + size]) in windows:
                hit.update(range(i, i + size))
                named |= {str(name)} if name is not None else set()
    digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
    return len(ws), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(ws)


def blocks(rng, n, sigma, longest):
    return np.concatenate([np.append(rng.integers(1, sigma + 1, rng.integers(1, longest)), 0) for _ in range(n)])


@pytest.mark.parametrize("seed", range(8))
def test_index_against_plain_search(seed):
    rng = np.random.default_rng(seed)
    sigma = int(rng.choice([1, 2, 5, 300]))
    text = blocks(rng, 30, sigma, 40)
    text = np.concatenate([text, text[: len(text) // 2], np.zeros(1, int)])  # repeats
    order = sort_suffixes(text, sigma)
    ends = np.flatnonzero(text == 0)

    def suffix(p):  # terminators sort below symbols and among themselves by place
        e = ends[np.searchsorted(ends, p)]
        return [*(int(s) * 10**6 for s in text[p:e]), int(e) - 10**6]

    assert [suffix(p) for p in order] == sorted(suffix(p) for p in range(len(text)))
    index = FMIndex(text, sigma, sample=4)
    lengths = rng.integers(1, 6, 60)
    patterns = np.zeros((60, 5), np.int32)
    for i, m in enumerate(lengths):
        patterns[i, 5 - m :] = rng.integers(1, sigma + 1, m)
    low, high = index.search(patterns, lengths)
    for i, m in enumerate(lengths):
        want = [p for p in range(len(text) - m + 1) if (text[p : p + m] == patterns[i, 5 - m :]).all()]
        assert sorted(index.locate(np.arange(low[i], high[i])).tolist()) == want


def test_wavelet_tree_rank_and_access():
    rng = np.random.default_rng(1)
    seq = rng.integers(0, 11, 500)
    tree = WaveletTree(seq, 10)
    for c in range(11):
        at = np.arange(501)
        assert tree.rank(np.full(501, c), at).tolist() == [int((seq[:i] == c).sum()) for i in at]
    symbol, before = tree.access(np.arange(500))
    assert symbol.tolist() == seq.tolist()
    assert before.tolist() == [int((seq[:i] == seq[i]).sum()) for i in range(500)]


def rows_of(df):
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()),
        key=lambda r: (r[0] is None, r),
    )


def cases(rng):
    vocab = [f"w{i}" for i in range(12)] + ["é", "Ünter", "x9"]
    line = lambda n: " ".join(rng.choice(vocab, n))
    items = [(i, line(rng.integers(13, 40))) for i in range(6)]
    items += [(10, "only five words are here"), (11, ""), (12, None), (None, "nameless words of one item"), (3, items[3][1])]
    items += [(13, "w1 w1 w1"), (14, "w2, W3!")]
    docs = [(i, line(rng.integers(0, 80)) + " zz " + items[i % 6][1].upper().replace(" ", "\n") + " " + line(20)) for i in range(40)]
    docs += [(50, None), (51, ""), (52, "zz " * 30), (53, "ONLY, five-words: are here"), (54, "nameless words of one item")]
    docs += [(55, items[0][1] + " " + "unknown " * 2000), (56, " ".join(["w1"] * 3000)), (57, items[1][1]), (57, items[1][1]), (None, items[2][1])]
    return items, docs


def test_documents_against_rule(spark, documents, monkeypatch):
    items, docs = cases(np.random.default_rng(5))
    bench = spark.createDataFrame(items, BENCH)
    want = sorted(((i, *brute(t, items)) for i, t in docs), key=lambda r: (r[0] is None, r))
    frame = documents(docs).repartition(3)
    assert rows_of(D.document_contamination(frame, bench)) == want
    # Small shards, short blocks.
    monkeypatch.setattr(D, "SHARD_SYMBOLS", 50)
    assert rows_of(D.document_contamination(frame, bench)) == want


def test_benchmark_in_blocks(spark, documents, monkeypatch):
    items, docs = cases(np.random.default_rng(6))
    bench = spark.createDataFrame(items, BENCH)
    want = sorted(((i, *brute(t, items)) for i, t in docs), key=lambda r: (r[0] is None, r))
    monkeypatch.setattr(D.phrase_blocks, "__defaults__", (13, 150))
    assert len(D.phrase_blocks(bench)) > 2
    assert rows_of(D.document_contamination(documents(docs), bench)) == want


def test_empty_tables_clashing_columns_and_stage(spark, documents):
    items, docs = cases(np.random.default_rng(7))
    bench = spark.createDataFrame(items, BENCH)
    assert D.document_contamination(documents([]), bench).collect() == []
    none = rows_of(D.document_contamination(documents(docs), spark.createDataFrame([], BENCH)))
    assert all(r[2:4] == (0, 0) and not r[5] for r in none)
    frame = documents(docs).selectExpr("*", "'x' as spans", "1 as n_hit")
    kept = D.without_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted(t or "" for _, t in docs if not brute(t, items)[4])
