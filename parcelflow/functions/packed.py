"""Columns of many rows as one compressed value, for shuffles, state and the way to and from Python.

A row of its own costs a call into Python or the state store, and its texts are compressed badly one by one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Travels to the workers by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _planes(numbers: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones, and so on: most of them are alike."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _numbers(data: memoryview, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size).reshape(size, n).T).view(kind).reshape(n)


def _is_number(kind: pa.DataType) -> bool:
    return pa.types.is_int64(kind) or pa.types.is_timestamp(kind)


def pack(batch: pa.RecordBatch) -> bytes:
    """Texts as lengths and letters, numbers and times as steps; columns of other types or with nulls as Arrow has them."""
    n, head, body, others = batch.num_rows, [], [], []
    for column in batch.columns:
        if n and not column.null_count and pa.types.is_string(column.type):
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1]
            letters = memoryview(column.buffers()[2] or b"")[offsets[0] : offsets[-1]]
            head.append(len(letters))
            body += [_planes(np.diff(offsets)), letters]
        elif n and not column.null_count and _is_number(column.type):
            head.append(0)
            body.append(_planes(np.diff(column.cast(pa.int64()).to_numpy(), prepend=np.int64(0))))
        else:
            head.append(-1)
            others.append(column)
    rest = pa.RecordBatch.from_arrays(others, [str(k) for k in range(len(others))]).serialize() if others else b""
    raw = b"".join([np.array([n, *head], np.int64).tobytes(), *body, rest])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


def unpack(data: bytes, schema: pa.Schema) -> pa.RecordBatch:
    raw = memoryview(pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), codec="zstd"))
    n, *head = np.frombuffer(raw, np.int64, 1 + len(schema)).tolist()
    at, columns = 8 * (1 + len(schema)), []
    for field, letters in zip(schema, head):
        if letters < 0:
            columns.append(None)
        elif _is_number(field.type):
            columns.append(pa.array(np.cumsum(_numbers(raw[at:], np.int64, n))).cast(field.type))
            at += 8 * n
        else:
            ends = np.cumsum(_numbers(raw[at:], np.int32, n), dtype=np.int32)
            offsets, at = np.concatenate([np.zeros(1, np.int32), ends]), at + 4 * n
            text = [None, pa.py_buffer(offsets), pa.py_buffer(bytes(raw[at : at + letters]))]
            columns.append(pa.Array.from_buffers(field.type, n, text))
            at += letters
    others = [k for k, column in enumerate(columns) if column is None]
    if others:
        own = pa.schema([pa.field(str(i), schema.field(k).type) for i, k in enumerate(others)])
        for k, column in zip(others, pa.ipc.read_record_batch(pa.py_buffer(bytes(raw[at:])), own).columns):
            columns[k] = column
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def one_batch(table: pa.Table) -> pa.RecordBatch:
    """All rows of a table as one batch."""
    table = table.combine_chunks()
    return table.to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema)


def unpack_all(values: Iterable[bytes], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches([unpack(v, schema) for v in values], schema)


def by_group(table: pa.Table, schema: pa.Schema) -> Iterator[tuple[int, bytes]]:
    """``(group, packed)`` for the rows of each value of the column ``group``, in their order."""
    groups = table.column("group").to_numpy()
    order = np.argsort(groups, kind="stable")
    rows, groups = table.select(schema.names).cast(schema).take(pa.array(order)), groups[order]
    rows = one_batch(rows)
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(groups)], strict=True):
        yield int(groups[start]), pack(rows.slice(start, end - start))


def gathered(schema: pa.Schema, rows_at_once: int, prepare=None):
    """For ``mapInArrow``: rows with a column ``group`` as rows (group, packed), gathered from so many rows a time.

    ``prepare`` may turn the table of them into another one with a ``group`` and the columns of ``schema``.
    """

    def pieces(kept):
        table = pa.Table.from_batches(kept)
        for start in range(0, table.num_rows, rows_at_once):
            part = table.slice(start, rows_at_once)
            made = list(by_group(prepare(part) if prepare else part, schema))
            for k in range(0, len(made), 64):
                groups, values = zip(*made[k : k + 64])
                yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(values, pa.binary())], ["group", "packed"])

    def gather(batches):
        kept, rows = [], 0
        for batch in batches:
            kept.append(batch)
            rows += batch.num_rows
            if rows >= rows_at_once:
                yield from pieces(kept)
                kept, rows = [], 0
        if rows:
            yield from pieces(kept)

    return gather


#: The rows that :func:`gathered` makes.
GROUPED = "group bigint, packed binary"


def opened(schema: pa.Schema):
    """For ``mapInArrow``: the rows of all values of the column ``packed``."""

    def run(batches):
        for batch in batches:
            for value in batch.column("packed").to_pylist():
                rows = unpack(value, schema)
                for start in range(0, rows.num_rows, 10_000):
                    yield rows.slice(start, 10_000)

    return run


def codes(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Texts as numbers, equal ones with the same number in all columns."""
    whole = pa.chunked_array([chunk for c in columns for chunk in c.chunks], pa.string()).combine_chunks()
    numbers = whole.dictionary_encode().indices.to_numpy().astype(np.int64)
    return np.split(numbers, np.cumsum([len(c) for c in columns])[:-1])


#: Pairs that one step makes.
PAIRS_AT_ONCE = 200_000


def near(left: pa.Table, right: pa.Table, width_us: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The places of rows with the same ``package_id`` and ``slot`` whose ``at_us`` are strictly less than ``width_us``
    apart, a bounded number at a time. No texts or times may be null.

    The right rows are sorted by key and time; those of a left row are a run that two binary searches find, so a
    busy package costs no more than its pairs. Pairs of one key come together, which makes them small when packed.
    """
    n = left.num_rows
    if not n or not right.num_rows:
        return
    package = np.concatenate(codes(left.column("package_id"), right.column("package_id")))
    slots, slot = np.unique(np.concatenate([t.column("slot").to_numpy() for t in (left, right)]), return_inverse=True)
    _, of = np.unique(package * len(slots) + slot, return_inverse=True)
    at, seen = left.column("at_us").to_numpy(), right.column("at_us").to_numpy()
    # Times as ranks, so that key and time fit into one number.
    times, rank = np.unique(np.concatenate([at - width_us + 1, at + width_us, seen]), return_inverse=True)
    keys = of[n:] * len(times) + rank[2 * n :]
    order = np.argsort(keys, kind="stable")
    low, high = (np.searchsorted(keys[order], of[:n] * len(times) + r) for r in (rank[:n], rank[n : 2 * n]))
    by_key = np.argsort(of[:n], kind="stable")
    low, high = low[by_key], high[by_key]
    found = np.cumsum(high - low)
    for start in range(0, int(found[-1]), PAIRS_AT_ONCE):
        k = np.arange(start, min(start + PAIRS_AT_ONCE, int(found[-1])))
        of_left = np.searchsorted(found, k, side="right")
        yield pa.array(by_key[of_left]), pa.array(order[high[of_left] - (found[of_left] - k)])
