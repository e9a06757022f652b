"""Spelling variants: words one edit apart, compared as dense tiles of code points.

Words that differ by one inserted, deleted or replaced code point share either the first half of the
longer one or the rest of it. So each word is filed under both halves, as the longer and as the shorter
word of a pair, and only words of one file are compared. A file is cut into tiles of bounded size; a pair
of tiles is two padded matrices of code points, in which a column at a time extends the common prefix,
and then from the end the common suffix, of all pairs at once. A pair is one edit apart exactly if prefix
and suffix together reach the length of the longer word minus one. Pairs that share the first half are
counted in that file alone. A tile pair returns one partial result for each of its words, never pairs;
sums and smallest values of partials combine before the shuffle.

A file larger than a tile is dealt out as tile pairs, each of its words once for every tile, so a frequent
half is spread over tasks and no group grows with it. Files are gathered into batches of even size.

Forms lead to ever more frequent words (five times at least), so following them takes few rounds of joins,
each of which doubles the way.

Defined cases: a null text has no words, a null doc_id is an empty one in the checksum; copies of a
document count each; words may be of any length; an empty table gives no rows; a clashing extra column
is ignored. Ties among nearest words go to the smaller one in code-point order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import store, temporary

#: Maximal runs of these are words (fixed value).
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every how manieth checksum loses a code point; least length and count of a word; how many times as frequent a form is.
DAMAGED, LENGTH, COUNT, TIMES = 199, 6, 5, 5
#: Words of a tile, and words that a task takes at once.
TILE, BATCH = 512, 20_000
#: Code points of a tile at most (a tile of very long words has fewer of them).
CELLS = 1 << 22


def occurrences(documents: DataFrame, damaged: int | None = DAMAGED) -> DataFrame:
    """Every ``word`` of ``documents(doc_id, text)`` as it counts: lower-cased, one in ``damaged`` short of a code point."""
    run = F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)))
    words = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run.alias("run"))
    lower = words.select("doc", F.translate("run", UPPER, LOWER).alias("word"))
    if damaged is None:
        return lower.select("word")
    checked = lower.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "word").cast("binary")))
    at = (F.col("h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return checked.select(F.when(F.col("h") % damaged == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, length: int = LENGTH, count: int = COUNT) -> DataFrame:
    """``word`` and its number of occurrences ``n``, of long and frequent enough words."""
    counts = words.where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= count)


def _files(words: DataFrame) -> DataFrame:
    """Each word with the halves it is filed under: ``longer`` is the length of the longer word of a pair."""
    n = F.length("word")

    def half(longer: Column, front: bool) -> Column:
        h = F.floor(longer / 2).cast("int")
        part = F.substring("word", F.lit(1), h) if front else F.substring("word", n - (longer - h) + 1, longer - h)
        return F.struct(longer.alias("longer"), F.lit(front).alias("front"), part.alias("half"))

    # The rest of a longer word is at most as long as a word of one code point less.
    filed = F.array(*[half(longer, front) for longer in (n, n + 1) for front in (True, False)])
    return words.select("word", "n", F.inline(filed))


def _tiles(filed: DataFrame, tile: int) -> DataFrame:
    """Filed words with the tile pair they take part in (``low`` <= ``high``) and the tile they lie in (``own``)."""
    keys = ["longer", "front", "half"]
    sizes = filed.groupBy(*keys).agg(F.count("*").alias("size")).where(F.col("size") > 1)
    room = F.greatest(F.lit(1), F.least(F.lit(tile), F.floor(F.lit(CELLS) / F.greatest("longer", F.lit(1)))))
    tiles = F.ceil(F.col("size") / room).cast("int")
    placed = filed.join(sizes.hint("merge"), keys).withColumn("tiles", tiles)
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    return (
        placed.withColumn("own", own)
        .withColumn("other", other)
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .drop("other", "tiles", "size")
    )


def code_points(words: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
    """A matrix of code points, one word a column, padded with zeros behind (or before), and the lengths."""
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max(initial=1))
    padded = "".join(w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words)
    points = np.frombuffer(padded.encode("utf-32-le"), np.uint32).reshape(len(words), width)
    return np.ascontiguousarray(points.T), lengths


def _common(a: np.ndarray, b: np.ndarray, columns) -> np.ndarray:
    """How many of the given columns agree from the first one on, for all pairs."""
    out = np.zeros((a.shape[1], b.shape[1]), np.int32)
    alive = np.ones(out.shape, bool)
    for i in columns:
        alive &= a[i][:, None] == b[i][None, :]
        if not alive.any():
            break
        out += alive
    return out


def near_pairs(a: list[str], b: list[str], longer: int, front: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of words one edit apart, the longer of them of ``longer`` code points.

    All words share the first half (``front``) or the rest; of the latter, pairs that share the first
    half as well are left out.
    """
    half = longer // 2
    # One width for both sides, so that columns correspond; a shorter word is padded.
    pad = ["\1" * longer]
    (left_a, la), (left_b, lb) = code_points(a + pad, False), code_points(b + pad, False)
    left_a, left_b, la, lb = left_a[:, :-1], left_b[:, :-1], la[:-1], lb[:-1]
    if front:
        prefix = half + _common(left_a, left_b, range(half, longer))
    else:
        prefix = _common(left_a, left_b, range(half))
    right_a, right_b = (code_points(w + pad, True)[0][:, :-1] for w in (a, b))
    suffix = _common(right_a, right_b, range(longer - 1, -1, -1))
    near = (prefix + suffix >= longer - 1) & (np.maximum(la[:, None], lb[None, :]) == longer)
    near &= (prefix < longer) if front else (prefix < half)
    return np.nonzero(near)


def _compare(rows: pa.Table) -> pa.Table:
    """Partial results (word, n_near, minus the count and text of the best near word) of a batch of tile pairs."""
    keys = ["longer", "front", "half", "low", "high"]
    rows = rows.sort_by([(k, "ascending") for k in keys]).combine_chunks()
    words, counts, own, low, high = (rows.column(c).to_pylist() for c in ("word", "n", "own", "low", "high"))
    files = list(zip(*(rows.column(c).to_pylist() for c in keys), strict=True))
    out: list[tuple[str, int, int, str]] = []

    def take(x: list[int], y: list[int], near: tuple[np.ndarray, np.ndarray]) -> None:
        found: dict[int, list[int]] = {}
        for i, j in zip(near[0].tolist(), near[1].tolist(), strict=True):
            found.setdefault(x[i], []).append(y[j])
        for i, others in found.items():
            best, text = min((-counts[j], words[j]) for j in others)
            out.append((words[i], len(others), best, text))

    start = 0
    while start < len(files):
        end = start + 1
        while end < len(files) and files[end] == files[start]:
            end += 1
        if end - start > 1:
            longer, front = files[start][:2]
            if low[start] == high[start]:
                x = y = list(range(start, end))
            else:
                x = [i for i in range(start, end) if own[i] == low[i]]
                y = [i for i in range(start, end) if own[i] == high[i]]
            if x and y:
                i, j = near_pairs([words[k] for k in x], [words[k] for k in y], longer, front)
                take(x, y, (i, j))
                if x is not y:
                    take(y, x, (j, i))
        start = end
    columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "n_near", "best", "near"])


def near_words(words: DataFrame, tile: int = TILE, batch: int = BATCH) -> DataFrame:
    """``word``, ``n_near`` and its most frequent near word (``near``, ``near_n``) for words(word, n) that have any."""
    dealt = store(_tiles(_files(words), tile), "tiles")
    batches = max(1, -(-dealt.count() // batch))
    part = F.pmod(F.xxhash64("longer", "front", "half", "low", "high"), F.lit(batches)).alias("batch")
    compared = dealt.select(part, "*").groupBy("batch").applyInArrow(
        lambda t: _compare(t.drop_columns(["batch"])), "word string, n_near long, best long, near string"
    )
    best = F.min(F.struct("best", "near")).alias("b")
    return compared.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("b.near").alias("near"), (-F.col("b.best")).alias("near_n")
    )


def follow(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for forms(word, form): where the forms lead to in the end. Forms must not go round."""
    with temporary(forms.sparkSession) as put:
        way = put(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "way")
        while not way.where("moved").isEmpty():
            onward = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
            way = put(
                way.join(onward, "root", "left").select(
                    "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
                ),
                "way",
            )
    return way.select("word", "root")


def variants(words: DataFrame, times: int = TIMES, tile: int = TILE, batch: int = BATCH) -> DataFrame:
    """Forms and roots of words(word, n): columns ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    counted = store(words.select("word", "n"), "words")
    near = near_words(counted, tile, batch)
    is_form = F.col("near_n") >= times * F.col("n")
    formed = store(
        counted.join(near, "word", "left").select(
            "word",
            F.when(is_form, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "formed",
    )
    roots = follow(formed.where("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def document_variants(documents: DataFrame) -> DataFrame:
    """Spelling variants among the words of whole ``documents``."""
    return variants(vocabulary(occurrences(documents)))
