"""Shards against the definition in plain Python."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation_and_its_inverse(n):
    x = np.arange(n)
    p = sharding.permute(x, n, key=3)
    assert sorted(p) == list(range(n))
    assert (sharding.permute(p, n, key=3, inverse=True) == x).all()


def test_keys_give_other_orders_and_one_key_the_same():
    x = np.arange(1000)
    assert (sharding.permute(x, 1000, 1) == sharding.permute(x, 1000, 1)).all()
    assert (sharding.permute(x, 1000, 1) != sharding.permute(x, 1000, 2)).mean() > 0.9


def test_documents_with_nulls_ties_and_long_texts(spark, documents):
    rows = [(None, None), (None, "a"), (7, "same"), (7, "same"), (8, ""), (9, "é" * 50_000)]
    rows += [(100 + i, "copy") for i in range(300)]
    out = sharding.document_shards(documents(rows).withColumn("shard", F.lit("clash")), 8).collect()
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in out) == sorted(
        (i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    assert {r.law for r in out} == {"rows"} and {r.grown_shard for r in out} == {None}
    sizes = Counter(r.shard for r in out)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(size))
    order = sorted(out, key=lambda r: r.row_number)
    assert [r.row_number for r in order] == list(range(len(rows)))
    ids = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert ids == sorted(ids)
    for r in out:
        assert int(sharding.permute(np.array([r.row_number]), len(rows))[0]) == r.slot * 8 + r.shard


def test_empty_table_and_repeatable(documents):
    assert sharding.document_shards(documents([]).limit(0), 8).collect() == []
    docs = documents([(i, str(i)) for i in range(50)])
    first, again = (sorted(map(tuple, sharding.document_shards(docs, 8).collect())) for _ in range(2))
    assert first == again
