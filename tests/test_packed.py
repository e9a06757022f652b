"""Packed columns: what goes in comes out, and rows that are near against all pairs."""

from __future__ import annotations

import random
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pytest

from parcelflow.functions import packed

SCHEMA = pa.schema(
    [
        ("text", pa.string()),
        ("number", pa.int64()),
        ("time", pa.timestamp("us", tz="UTC")),
        ("flag", pa.bool_()),
        ("texts", pa.list_(pa.string())),
    ]
)


def _batch(rows):
    return pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, r, strict=True)) for r in rows], SCHEMA)


@pytest.mark.parametrize("missing", [False, True])
def test_packed_rows_come_back(missing):
    rng, when = random.Random(3), datetime(1969, 12, 31, 23, 59, 59, 999_999, tzinfo=timezone.utc)
    rows = [("ä" * rng.randrange(4) + str(k), rng.choice([-(2**63), 2**63 - 1, 0, k]), when, k % 2 == 0, ["x", None] * (k % 3)) for k in range(50)]
    if missing:
        rows[7] = (None,) * 5
        rows[9] = ("", 1, None, None, [])
    batch = _batch(rows)
    for part in (batch, batch.slice(5, 20), batch.slice(49), batch.slice(0, 0), _batch([])):
        assert packed.unpack(packed.pack(part), SCHEMA).to_pylist() == part.to_pylist()
    grouped = pa.Table.from_batches([batch]).append_column("group", pa.array(np.arange(50) % 7))
    found = {g: packed.unpack(data, SCHEMA).to_pylist() for g, data in packed.by_group(grouped, SCHEMA)}
    assert found == {g: batch.to_pylist()[g::7] for g in range(7)}


def test_ids_and_times_take_a_fraction():
    rows = [(f"evt-{k}-{k % 5}", k, datetime.fromtimestamp(1_785_000_000 + 180 * k, timezone.utc), True, None) for k in range(1000)]
    assert len(packed.pack(_batch(rows))) < 8 * len(rows)


def test_near_rows_against_all_pairs(monkeypatch):
    monkeypatch.setattr(packed, "PAIRS_AT_ONCE", 17)
    rng = random.Random(4)
    made = [[(f"p{rng.randrange(3)}", rng.randrange(2), rng.randrange(60)) for _ in range(n)] for n in (80, 90)]
    left, right = (pa.table([pa.array(c) for c in zip(*rows)], ["package_id", "slot", "at_us"]) for rows in made)
    found = [(i, j) for a, b in packed.near(left, right, 5) for i, j in zip(a.to_pylist(), b.to_pylist(), strict=True)]
    want = [(i, j) for i, a in enumerate(made[0]) for j, b in enumerate(made[1]) if a[:2] == b[:2] and abs(a[2] - b[2]) < 5]
    assert sorted(found) == want and len(found) > 100
    assert list(packed.near(left.slice(0, 0), right, 5)) == list(packed.near(left, right.slice(0, 0), 5)) == []
