"""A stated set of query vectors against all rows, block by block.

The queries are numbered and stored once. One block of them at a time, bounded in rows and in
components, is broadcast to the tasks, which go through the rows of their partition in chunks of bounded
size; the block is released before the next one is sent. The table itself is never shuffled or copied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import discard, folder
from parcelflow.llm.sharding import number_rows

#: Most queries of a block, most rows of a chunk, and most components of either.
BLOCK_ROWS, CHUNK_ROWS, CELLS = 2048, 2048, 1 << 22
#: Scores end at these bounds, where a long does.
LIMIT = 2**63 - 1


@dataclass
class Rows:
    """Some rows with vectors of one length: ids, labels (or None) and whole-number components as floats or ints."""

    place: np.ndarray
    ids: np.ndarray
    labels: np.ndarray | None
    parts: np.ndarray


def scaled(matrix: np.ndarray, factor: float) -> np.ndarray:
    """floor(factor * x), x as double. Whole numbers as doubles while those are exact, Python integers beyond."""
    out = np.floor(matrix.astype(float) * factor)
    if out.size and np.abs(out).max() >= 2**53:
        out = np.array([int(v) for v in out.ravel().tolist()], object).reshape(out.shape)
    return out


def usable(vector: Column, factor: float) -> Column:
    """True for a vector whose components are all there and finite, also after scaling."""
    whole = lambda x: x.isNotNull() & (F.abs(x.cast("double") * F.lit(float(factor))) < F.lit(float("inf")))
    # NaN is larger than any number here, so it fails the comparison.
    return F.coalesce(vector.isNotNull() & F.forall(vector, whole), F.lit(False))


def by_length(table: pa.Table, factor: float) -> Iterator[Rows]:
    """The rows of ``table(id, vector[, label])`` as matrices, one for each length of vector."""
    table = table.combine_chunks()
    lengths = pc.list_value_length(table.column("vector")).to_numpy()
    for n in np.unique(lengths).tolist():
        place = np.flatnonzero(lengths == n)
        own = table.take(pa.array(place)).combine_chunks()
        vectors = own.column("vector").combine_chunks()
        matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(place), n)
        labels = own.column("label").to_numpy() if "label" in own.schema.names else None
        yield Rows(place, own.column("id").to_numpy(), labels, scaled(matrix, factor))


def chunks(batches) -> Iterator[pa.Table]:
    """Arrow batches joined to tables of bounded rows and components (a single row may have more)."""
    kept: list[pa.RecordBatch] = []
    rows = cells = 0
    for whole in batches:
        width = max(1, pc.max(pc.list_value_length(whole.column(1))).as_py() or 1) if whole.num_rows else 1
        step = max(1, min(CHUNK_ROWS, CELLS // width))
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            if kept and (rows + batch.num_rows > CHUNK_ROWS or cells + batch.num_rows * width > CELLS):
                yield pa.Table.from_batches(kept)
                kept, rows, cells = [], 0, 0
            kept.append(batch)
            rows += batch.num_rows
            cells += batch.num_rows * width
    if kept:
        yield pa.Table.from_batches(kept)


def best(k: int, query: np.ndarray, score: np.ndarray, ident: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of flat (query, score, id) entries each query's ``k`` highest scores, ties to the smaller id."""
    order = np.lexsort((ident, -score, query))
    query, score, ident = query[order], score[order], ident[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query, "left") < k
    return query[keep], score[keep], ident[keep]


def longs(scores: np.ndarray) -> np.ndarray:
    """Exact scores as longs, which end at their bounds."""
    if scores.dtype == object:
        scores = np.array([max(-LIMIT, min(LIMIT, int(v))) for v in scores.ravel().tolist()], object).reshape(scores.shape)
    return scores.astype(np.int64)


class Best:
    """The best entries so far, cut back to ``k`` a query whenever many have gathered."""

    def __init__(self, k: int):
        self._k, self._parts, self._size, self._full = k, [], 0, 1 << 19

    def add(self, query: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        self._parts.append((query, score, ident))
        self._size += len(query)
        if self._size > self._full:
            self._parts = [self.entries()]
            self._size = len(self._parts[0][0])
            self._full = max(1 << 19, 2 * self._size)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self._parts:
            return tuple(np.empty(0, np.int64) for _ in range(3))
        return best(self._k, *(np.concatenate(c) for c in zip(*self._parts, strict=True)))


def in_blocks(rows: DataFrame, queries: DataFrame, search: Callable[[DataFrame, pa.Table], DataFrame], schema: str) -> DataFrame:
    """What ``search(rows, block)`` finds for every block of ``queries(id, vector, ...)``, stored under ``block``.

    A block is collected (its size is bounded) and handed over as an Arrow table; ``search`` broadcasts it
    to passes over ``rows``.
    """
    spark = queries.sparkSession
    longest = queries.agg(F.max(F.size("vector"))).first()[0] or 1
    size = max(1, min(BLOCK_ROWS, CELLS // max(1, longest)))
    numbered, n = number_rows(queries, ["id"])
    numbered = numbered.withColumn("block", F.expr(f"cast(row_number div {size} as int)")).drop("row_number")
    stored, out = folder(spark, "queries"), folder(spark, "found")
    numbered.repartition("block").write.partitionBy("block").parquet(stored)
    blocks = spark.read.schema(numbered.schema).parquet(stored)
    for b in range(-(-n // size)):
        block = blocks.where(F.col("block") == b).drop("block").toArrow()
        search(rows, block).write.parquet(f"{out}/block={b}")
    if n == 0:
        spark.createDataFrame([], schema).write.parquet(f"{out}/block=0")
    discard(spark, stored)
    return spark.read.schema(f"{schema}, block int").parquet(out)
