"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0 to n-1 by a distributed sort on ``order_by``. A keyed Feistel network permutes the
smallest square power-of-two domain that holds n; values outside 0 to n-1 are encrypted again until
they fall inside (cycle walking), which keeps the map a permutation of 0 to n-1. The position p of a
row gives ``shard = p mod k`` and ``slot = p div k``: shard sizes differ by one row at most, slots have
no gaps, and either direction can be computed for any single row without a table.

Defined cases: an empty table gives no rows; null ids sort first; rows equal in ``order_by`` get
different numbers in an order that only matters for columns outside ``order_by``; columns of the
input that clash with the added names are replaced by them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import store

ROUNDS = 6
#: Odd multipliers and shifts of the mixing step (fixed values).
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
ADDED = ("row_number", "position", "shard", "slot")
_INDEX_BITS = 33  # of monotonically_increasing_id below the partition


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = x + np.uint64(key * MIX[0] % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def _network(x: np.ndarray, half: int, keys: list[int], inverse: bool) -> np.ndarray:
    bits, mask = np.uint64(half), np.uint64(2**half - 1)
    left, right = x >> bits, x & mask
    if inverse:
        for key in reversed(keys):
            left, right = right ^ (_mix(left, key) & mask), left
    else:
        for key in keys:
            left, right = right, left ^ (_mix(right, key) & mask)
    return left << bits | right


def permute(numbers: np.ndarray, n: int, key: int = 0, inverse: bool = False) -> np.ndarray:
    """The permutation of 0 to n-1 under ``key`` (or its inverse) at ``numbers``."""
    half, keys = _half_bits(n), [key * 64 + r + 1 for r in range(ROUNDS)]
    out = np.asarray(numbers).astype(np.uint64)
    with np.errstate(over="ignore"):
        out = _network(out, half, keys, inverse)
        while (outside := np.flatnonzero(out >= np.uint64(n))).size:
            out[outside] = _network(out[outside], half, keys, inverse)
    return out.astype(np.int64)


def permuted(number: str | Column, n: int, key: int = 0, inverse: bool = False) -> Column:
    """``permute`` as a column expression."""

    @F.pandas_udf("long")
    def run(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, key, inverse))

    return run(number)


def number_rows(df: DataFrame, order_by: list[str]) -> tuple[DataFrame, int]:
    """``df`` with ``row_number`` (0 to n-1 in the order of ``order_by``), and n.

    The order is a range partitioning, so no task holds more than its range; rows equal in all of
    ``order_by`` are told apart by their place in the input, so that a large group of them is split
    as well. Only one count per partition comes to the driver.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c not in ADDED]
    tie, part, index = "__tie", "__part", "__index"
    source = store(df.select(*[F.col(f"`{c}`") for c in kept]), "rows").withColumn(tie, F.monotonically_increasing_id())
    dealt = source.repartitionByRange(*order_by, tie).sortWithinPartitions(*order_by, tie)
    placed = store(
        dealt.drop(tie)
        .withColumn(part, F.spark_partition_id())
        .withColumn(index, F.monotonically_increasing_id().bitwiseAND(2**_INDEX_BITS - 1)),
        "sorted",
    )
    starts, n = [], 0
    for row in placed.groupBy(part).count().orderBy(part).collect():
        starts.append((row[0], n))
        n += row["count"]
    offsets = spark.createDataFrame(starts, f"{part} int, __start long")
    numbered = placed.join(F.broadcast(offsets), part)  # one row per partition
    return numbered.select(*kept, (F.col("__start") + F.col(index)).alias("row_number")), n


def assign_shards(df: DataFrame, shards: int, order_by: list[str], key: int = 0) -> DataFrame:
    """``df`` with ``row_number``, ``position`` (its place in the shuffle), ``shard`` and ``slot``."""
    numbered, n = number_rows(df, order_by)
    return (
        numbered.withColumn("position", permuted("row_number", n, key))
        .withColumn("shard", (F.col("position") % shards).cast("int"))
        .withColumn("slot", F.expr(f"position div {shards}"))
    )


def document_shards(documents: DataFrame, shards: int = 8, key: int = 0) -> DataFrame:
    """One row per document: its size, checksum, shard and slot under the ``rows`` law."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = documents.select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    return assign_shards(narrow, shards, ["doc_id", "text_crc32", "size"], key).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
