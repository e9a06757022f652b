"""Tokens against the tokenizer on whole texts, packing against its rules and a one-by-one best fit."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from parcelflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


TEXTS = [
    None, "", " \n\t", "Hello  World!!\nIt's 2024—naïve café's ÀÉÎ", "á éx ́ İstanbul ΣΑΣ ﬁ ½ ١٢ 中文 字　全角",
    "<|endoftext|> x<|startoftext|>y", "tab nbsp em\u0085nel\x1cfs", "x" * 5000, "😀👍🏽 don't we'll they've I'd",
    "word " * 9000, "각 क्ष Ạ̊",
]


def test_chunk_ids_equal_whole_text_ids(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 12)
    tokenizer = packing.ChunkTokenizer(PATH)
    for _ in range(2):
        for text in TEXTS:
            (ids,) = tokenizer.ids([None if text is None else text.encode()])
            assert np.frombuffer(ids, "<u4").tolist() == whole_ids(text)


def greedy(sizes, capacity):
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


def check(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for inside in places.values():
        end = 0
        for offset, length in sorted(inside):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


@pytest.mark.parametrize("seed", range(6))
def test_sweep_needs_no_more_than_one_by_one(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([10, 64, 300]))
    sizes = np.minimum(capacity, rng.geometric(rng.choice([0.02, 0.1, 0.6]), 800))
    moves = packing.sweep(dict(Counter(sizes.tolist())), capacity)
    rows = [
        {"sequence_id": first + i, "offset": offset, "length": size, "rank": rank + i}
        for size, rank, number, first, offset in moves
        for i in range(number)
    ]
    assert Counter(r["length"] for r in rows) == Counter(sizes.tolist())
    assert len({(r["length"], r["rank"]) for r in rows}) == len(sizes)
    assert check(rows, capacity) == greedy(sizes.tolist(), capacity)


def test_documents_packed_whole(spark, documents):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "x1"], rng.integers(0, 700)))) for i in range(120)]
    rows += [(200 + i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (7, "again"), (7, "again")]
    rows += [(300, "copy of one") for _ in range(100)]
    out = packing.pack_documents(documents(rows).withColumnRenamed("n_chars", "offset").repartition(5), PATH).collect()
    want = Counter()
    for i, t in rows:
        ids = whole_ids(t)
        for p in range(0, len(ids), 4096):
            part = ids[p : p + 4096]
            want[(i, p // 4096, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r["length"], r.ids_crc32) for r in out) == want
    assert check(out, 4096) == greedy([k[3] for k, n in want.items() for _ in range(n)], 4096)


@pytest.mark.parametrize("part_pieces", [1, packing.PART_PIECES])
def test_all_pieces_are_packed_together_whatever_the_parts(spark, monkeypatch, part_pieces):
    monkeypatch.setattr(packing, "PARTS", 3)
    # A third of all pieces share one length.
    frame = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 7, id % 97 + 1) as length", "'x' as offset")
    out = packing.pack(frame, 100, part_pieces).collect()
    sizes = [7 if i % 3 == 0 else i % 97 + 1 for i in range(3000)]
    assert sorted((r.id, r["length"]) for r in out) == list(enumerate(sizes))
    assert check(out, 100) == greedy(sizes, 100)


def test_empty_table(spark, documents):
    assert packing.pack_documents(documents([]), PATH).collect() == []
