"""Hard negatives: rows of another label that score nearly as high as a positive, by packed products.

Scores are inner products of whole-number components. The rows of a chunk are packed, component by
component, into one wide integer each: every row's component, biased to be positive, lies in a field of
its own, wide enough for a whole score. One multiplication by an anchor's component (biased as well)
multiplies all rows at once, and the sum over the components holds one score in each field; taking the
biases out again gives the exact scores. The integers are as wide as they must be, so nothing overflows.

A pass over the rows finds the best ``positives`` rows of each anchor's label, a second one the best
``negatives`` rows of other labels in the window that a positive's score opens. A task keeps its best rows
only; a window picks the best of all tasks. Anchors come in blocks (see ``blocks``).

Defined cases: rows with a null id, label or vector, or with a component that is null or not finite,
take no part; vectors of different length have no score with each other; an empty vector scores 0 with
empty ones; rows with an anchor's own id are not its positives, and rows with its own or the positive's
label not its negatives; an anchor that occurs twice is answered twice, repeated rows count each; scores
beyond a long end at its bounds; a positive without negatives gives no row; an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.llm.blocks import Best, Rows, by_length, chunks, in_blocks, longs, usable

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: A negative's score lies between these hundredths of the positive's.
WINDOW = (50, 95)
_FOUND = "anchor int, slot int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
_LOWEST = np.iinfo(np.int64).min


def _whole(matrix: np.ndarray) -> np.ndarray:
    return matrix if matrix.dtype == object else matrix.astype(np.int64)


class Packed:
    """The rows of a chunk as one wide integer for each component."""

    def __init__(self, rows: Rows, largest: int):
        """``largest``: the largest absolute component of any anchor that will be multiplied."""
        parts = _whole(rows.parts)
        self.n, self.d = parts.shape
        self.bias = -int(parts.min(initial=0))
        self.sums = parts.sum(axis=1) if self.d else np.zeros(self.n, np.int64)
        top = (int(parts.max(initial=0)) + self.bias) * 2 * largest * max(self.d, 1)
        self.width = max(1, (top.bit_length() + 7) // 8)
        raised = (parts + self.bias).T
        if raised.dtype == object or self.width > 8:
            fields = (b"".join(int(v).to_bytes(self.width, "little") for v in column) for column in raised.tolist())
        else:
            fields = raised.astype("<u8")[:, :, None].view(np.uint8)[:, :, : self.width]
            fields = (column.tobytes() for column in np.ascontiguousarray(fields))
        self.integers = [int.from_bytes(column, "little") for column in fields]

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """The exact scores of all rows with one anchor, as longs (see ``longs`` beyond them)."""
        components = [int(v) for v in anchor]
        bias = max(0, -min(components, default=0))
        total = sum(map(mul, self.integers, (v + bias for v in components)))
        data = total.to_bytes(self.width * self.n, "little")
        # sum (a + s)(c + t) = sum a c + s sum c + t sum a + d s t
        shift = self.bias * sum(components) + self.d * bias * self.bias
        # Rows of zeros are narrow whatever the anchor.
        if self.width > 7 or self.sums.dtype == object or bias >= -_LOWEST:
            fields = [int.from_bytes(data[i : i + self.width], "little") for i in range(0, len(data), self.width)]
            return longs(np.array([f - bias * int(c) - shift for f, c in zip(fields, self.sums, strict=True)], object))
        fields = np.zeros((self.n, 8), np.uint8)
        fields[:, : self.width] = np.frombuffer(data, np.uint8).reshape(self.n, self.width)
        return fields.view("<i8")[:, 0] - bias * self.sums - shift


def score_matrix(anchors: Rows, rows: Rows) -> np.ndarray:
    """(anchors, rows) scores through packed products."""
    packed = Packed(rows, int(abs(anchors.parts).max(initial=0)))
    return np.stack([packed.scores(a) for a in _whole(anchors.parts)])


def _highest(scores: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) places that can be among the ``k`` highest valid scores of a query, ties all included."""
    shown = np.where(valid, scores, _LOWEST)
    if shown.shape[1] > k:
        lowest = np.partition(shown, shown.shape[1] - k, axis=1)[:, -k][:, None]
        valid = valid & (shown >= lowest)
    return np.nonzero(valid)


def _in_window(negative: np.ndarray, positive: np.ndarray, window: tuple[int, int]) -> np.ndarray:
    low, high = window
    largest = max(abs(int(negative.max(initial=0))), abs(int(negative.min(initial=0))), *(abs(int(p)) for p in positive.ravel()), 1)
    if largest >= 2**56:
        negative, positive = negative.astype(object), positive.astype(object)
    return (low * positive <= 100 * negative) & (100 * negative <= high * positive)


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    factor: float = SCALE,
) -> DataFrame:
    """Hard negatives of ``anchors(id, vector, label)`` among ``rows(id, vector, label)``; labels are longs.

    Columns ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score``; components are floor(``factor`` * x).
    """
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"), factor)
    rows, anchors = (df.select("id", "vector", F.col("label").cast("long")).where(good) for df in (rows, anchors))

    def search(rows: DataFrame, block: pa.Table) -> DataFrame:
        spark = rows.sparkSession
        sent = spark.sparkContext.broadcast(list(by_length(block, factor)))

        def find_positives(batches):
            found = [Best(positives) for _ in sent.value]
            for chunk in chunks(batches):
                for own in by_length(chunk, factor):
                    for a, kept in zip(sent.value, found, strict=True):
                        if a.parts.shape[1] == own.parts.shape[1]:
                            scores = score_matrix(a, own)
                            same = (a.labels[:, None] == own.labels) & (a.ids[:, None] != own.ids)
                            at, row = _highest(scores, same, positives)
                            kept.add(at, scores[at, row], own.ids[row])
            for a, kept in zip(sent.value, found, strict=True):
                at, score, ident = kept.entries()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.place[at].astype(np.int32)), pa.array(ident), pa.array(score)], ["anchor", "id", "score"]
                )

        order = W.partitionBy("anchor").orderBy(F.desc("score"), "id")
        first = (
            rows.mapInArrow(find_positives, "anchor int, id long, score long")
            .withColumn("slot", F.row_number().over(order))
            .where(F.col("slot") <= positives)
        )
        # Tables of (anchors of the block, positives): which positive a slot holds, and its score.
        ids, scores, held = (np.zeros((block.num_rows, positives), t) for t in (np.int64, np.int64, bool))
        for anchor, ident, score, slot in first.select("anchor", "id", "score", "slot").collect():
            ids[anchor, slot - 1], scores[anchor, slot - 1], held[anchor, slot - 1] = ident, score, True
        slots = spark.sparkContext.broadcast((ids, scores, held))

        def find_negatives(batches):
            ids, positive, held = slots.value
            found = [Best(negatives) for _ in sent.value]
            for chunk in chunks(batches):
                for own in by_length(chunk, factor):
                    for a, kept in zip(sent.value, found, strict=True):
                        if a.parts.shape[1] == own.parts.shape[1]:
                            scores = score_matrix(a, own)
                            other = a.labels[:, None] != own.labels
                            for slot in range(positives):
                                inside = _in_window(scores, positive[a.place, slot][:, None], window)
                                at, row = _highest(scores, other & inside & held[a.place, slot][:, None], negatives)
                                kept.add(at * positives + slot, scores[at, row], own.ids[row])
            for a, kept in zip(sent.value, found, strict=True):
                key, score, ident = kept.entries()
                at, slot = np.divmod(key, positives)
                place = a.place[at]
                columns = [place.astype(np.int32), slot.astype(np.int32), a.ids[at], ids[place, slot], positive[place, slot], ident, score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in _FOUND.split(", ")])

        return rows.mapInArrow(find_negatives, _FOUND)

    found = in_blocks(rows, anchors, search, _FOUND)
    order = W.partitionBy("block", "anchor", "slot").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def embedding_negatives(embeddings: DataFrame, every: int = 50, shifted: int = 7, labels: int = 10) -> DataFrame:
    """Hard negatives of the vectors whose id is divisible by ``every``; where it is divisible by ``shifted``,
    the label is the next one of ``labels`` labels."""
    label = F.when(F.col("vec_id") % shifted == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"), label.alias("label"))
    return hard_negatives(rows, rows.where(F.col("id") % every == 0))


def negatives_sql(every: int = 50, shifted: int = 7, labels: int = 10) -> str:
    low, high = WINDOW
    return f"""
with rows as (
  select vec_id, case when vec_id % {shifted} = 0 then (label + 1) % {labels} else label end as label,
    list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id anchor_id, c.vec_id, a.label = c.label same,
    cast(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])), 0) as bigint) score
  from rows a join rows c on a.vec_id % {every} = 0 and c.vec_id <> a.vec_id and len(a.v) = len(c.v)),
positives as (
  select anchor_id, vec_id positive_id, score positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES})
select anchor_id, positive_id,
  cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as int) as rank,
  vec_id negative_id, positive_score, score negative_score
from positives join scored using (anchor_id)
where not same and {low} * positive_score <= 100 * score and 100 * score <= {high} * positive_score
qualify rank <= {NEGATIVES}"""
