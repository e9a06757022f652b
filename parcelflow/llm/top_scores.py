"""Exact top-k search by inner product, with a uniform threshold in three phases.

The components of a vector are cut into a few segments; the scores of one segment over the rows of one
chunk are a local score list, and a row's score is the sum of its segments' scores.

1. Every list gives its ``k`` best entries. The totals of these rows are known where they lie, and the
   ``k``-th best of them over all lists is a cutoff that each final result must reach.
2. The cutoff of each query is broadcast. A row that reaches it has at least one segment at
   cutoff / segments or above, so these entries suffice: a row without any is out, and so is one whose
   entries, with the uniform threshold for each segment that is missing, stay below the cutoff.
3. The rows that remain get their missing segments, and with the exact score the cutoff decides.

All segments of a row lie in one task, so entries are joined where they are: what leaves a task is, in
the first phase, ``k`` totals a query, and in the last its ``k`` best rows; a window picks the best of all
tasks. Queries come in blocks (see ``blocks``), so nothing that grows with the data is broadcast.

Vectors without structure reach the uniform threshold in some segment often (two fifths of the pairs of
random vectors), so the phases save little arithmetic then; the result is exact in any case.

Defined cases: rows with a null id, a null vector or a component that is null or not finite take no part;
vectors of different length have no score with each other; an empty vector scores 0 with empty ones; rows
with a query's own id are left out; a query that occurs twice is answered twice, and repeated candidates
count each; scores beyond a long end at its bounds; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.llm.blocks import LIMIT, Best, Rows, by_length, chunks, in_blocks, longs, usable

K, SCALE = 20, 64
SEGMENTS = 4
_FOUND = "query int, query_id long, id long, score long"
_NONE = -np.inf


class Scores:
    """Score lists of one chunk: a (queries, rows) matrix for each segment, a query's own rows at minus infinity."""

    def __init__(self, queries: Rows, rows: Rows, segments: int):
        a, b = queries.parts, rows.parts
        d = a.shape[1]
        bound = d * int(abs(a).max(initial=0)) * int(abs(b).max(initial=0)) * segments
        kind = np.float32 if bound < 2**24 else float if bound < 2**53 else object
        if kind is object:
            a, b = (np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape) for x in (a, b))
        a, b = a.astype(kind), b.astype(kind)
        cuts = np.linspace(0, d, segments + 1).astype(int)
        self.lists = [a[:, i:j] @ b[:, i:j].T for i, j in zip(cuts[:-1], cuts[1:], strict=True) if i < j]
        if not self.lists:
            self.lists = [np.zeros((len(a), len(b)), kind)]
        self.own = queries.ids[:, None] == rows.ids[None, :]
        for scores in self.lists:
            scores[self.own] = _NONE

    def totals(self) -> np.ndarray:
        out = self.lists[0].copy()
        for scores in self.lists[1:]:
            out += scores
        return out


def local_lists(scores: Scores, k: int) -> np.ndarray:
    """The best ``k`` totals (queries, k) among the rows on the local lists; minus infinity where there are fewer."""
    total = scores.totals()
    n, rows = total.shape
    if rows > k:
        places = np.concatenate([np.argpartition(-s, k - 1, axis=1)[:, :k] for s in scores.lists], axis=1)
        places.sort(axis=1)
        again = np.zeros(places.shape, bool)
        again[:, 1:] = places[:, 1:] == places[:, :-1]
        total = np.take_along_axis(total, places, axis=1)
        total[again] = _NONE
    return _highest(total, k)


def _highest(values: np.ndarray, k: int) -> np.ndarray:
    if values.shape[1] < k:
        fill = np.full((len(values), k - values.shape[1]), _NONE, values.dtype)
        return np.concatenate([values, fill], axis=1)
    return -np.partition(-values, k - 1, axis=1)[:, :k]


def reaching(scores: Scores, cutoff: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, row place, score) of all pairs whose score reaches the query's cutoff."""
    m = len(scores.lists)
    least = cutoff[:, None]
    seen = [s * m >= least for s in scores.lists]
    # Sums of m times the entries, the uniform threshold (cutoff / m, so the cutoff itself) for what is missing.
    most = sum(np.where(hit, s * m, least) for hit, s in zip(seen, scores.lists, strict=True))
    open_pairs = np.logical_or.reduce(seen) & (most >= least * m) & ~scores.own
    q, r = np.nonzero(open_pairs)
    exact = sum(s[q, r] for s in scores.lists)
    kept = exact >= cutoff[q]
    return q[kept], r[kept], longs(exact[kept])


def _cutoff_type(values: np.ndarray) -> np.ndarray:
    """Cutoffs as doubles where these are exact."""
    finite = [v for v in values.tolist() if v is not None and v > -LIMIT]
    kind = float if not finite or max(abs(v) for v in finite) < 2**53 else object
    return np.array([_NONE if v is None or v <= -LIMIT else v for v in values.tolist()], kind)


def top_scores(rows: DataFrame, queries: DataFrame, k: int = K, factor: float = SCALE, segments: int = SEGMENTS) -> DataFrame:
    """For each row of ``queries(id, vector)`` the ``k`` rows of ``rows(id, vector)`` of highest score.

    Columns ``query_id``, ``rank`` (from 1), ``id`` and ``score``; components are floor(``factor`` * x).
    """
    good = F.col("id").isNotNull() & usable(F.col("vector"), factor)
    rows, queries = (df.select("id", "vector").where(good) for df in (rows, queries))

    def search(rows: DataFrame, block: pa.Table) -> DataFrame:
        spark = rows.sparkSession
        sent = spark.sparkContext.broadcast(list(by_length(block, factor)))

        def gather(batches):
            lists = [np.full((len(q.ids), k), _NONE) for q in sent.value]
            for chunk in chunks(batches):
                for own in by_length(chunk, factor):
                    for i, q in enumerate(sent.value):
                        if q.parts.shape[1] == own.parts.shape[1]:
                            lists[i] = _highest(np.concatenate([lists[i], local_lists(Scores(q, own, segments), k)], axis=1), k)
            for q, totals in zip(sent.value, lists, strict=True):
                at, _ = there = np.nonzero(totals > _NONE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.place[at].astype(np.int32)), pa.array(longs(totals[there]))], ["query", "total"]
                )

        totals = rows.mapInArrow(gather, "query int, total long")
        ranked = totals.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("total"))))
        lowest = ranked.where(F.col("rank") <= k).where(F.col("rank") == k).select("query", "total")
        cutoffs = np.full(block.num_rows, None, object)
        for query, total in lowest.collect():  # one row a query of the block
            cutoffs[query] = total
        cut = spark.sparkContext.broadcast([_cutoff_type(cutoffs[q.place]) for q in sent.value])

        def collect(batches):
            found = [Best(k) for _ in sent.value]
            for chunk in chunks(batches):
                for own in by_length(chunk, factor):
                    for i, q in enumerate(sent.value):
                        if q.parts.shape[1] == own.parts.shape[1]:
                            at, row, score = reaching(Scores(q, own, segments), cut.value[i])
                            found[i].add(at, score, own.ids[row])
            for q, kept in zip(sent.value, found, strict=True):
                at, score, ident = kept.entries()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.place[at].astype(np.int32)), pa.array(q.ids[at]), pa.array(ident), pa.array(score)],
                    ["query", "query_id", "id", "score"],
                )

        return rows.mapInArrow(collect, _FOUND)

    found = in_blocks(rows, queries, search, _FOUND)
    order = W.partitionBy("block", "query").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def embedding_top(embeddings: DataFrame, every: int = 20, k: int = K, factor: float = SCALE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` for the vectors whose id is divisible by ``every``."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
    found = top_scores(rows, rows.where(F.col("id") % every == 0), k, factor)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def top_sql(every: int = 20, k: int = K, factor: float = SCALE) -> str:
    return f"""
with rows as (
  select vec_id, list_transform(embedding, lambda x: cast(floor({factor} * cast(x as double)) as bigint)) v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from (
  select q.vec_id query_id, c.vec_id, cast(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) as bigint) score
  from rows q join rows c on q.vec_id % {every} = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v))
qualify rank <= {k}"""
