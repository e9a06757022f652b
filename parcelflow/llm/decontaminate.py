"""Benchmark decontamination: an FM-index per shard of documents, searched for every test phrase.

Documents of a partition are gathered into shards of bounded size. A shard's words become symbols of
the phrase vocabulary; a word outside it can be in no occurrence and ends a block, as does the end of
the text, and blocks shorter than the shortest phrase are left out. All phrases are searched backwards
through wavelet-tree ranks, occurrences are located by sampled suffix positions, and their word spans
are merged per document into removal spans. Documents never leave their partition: no shuffle.

The phrases are the whole ``benchmark`` table. They reach the tasks as broadcast blocks of at most
``PHRASE_BYTES`` of text; a larger table is searched block after block, each over all documents.

Defined cases: a null or empty text has no words and no hits; an item without words has no phrase;
repeated items count once by id; an item with a null id marks words but is not listed; an empty
benchmark gives no hits; clashing column names in the documents are replaced by the added ones.
"""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import store, utf8
from parcelflow.llm.fm_index import FMIndex

WINDOW = 13
#: Benchmark text in one broadcast block.
PHRASE_BYTES = 16_000_000
#: A shard ends at this many indexed symbols, or at this much text.
SHARD_SYMBOLS = 1 << 20
SHARD_BYTES = 48_000_000
#: Words of a block; blocks of one run overlap by the longest phrase less one word.
BLOCK = 128

SPANS = "array<struct<start:int,stop:int>>"
ADDED = ("n_words", "spans", "items", "n_hit", "n_items", "items_sha256", "contaminated")

#: ASCII letters in lower case, digits and all bytes of other characters stay; the rest separates words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text after lower-casing A-Z."""
    return [] if text is None else text.translate(_WORD_BYTES).split()


class Phrases:
    """The distinct phrases of a block of items as rows of symbols, right-aligned, and the items of each."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            symbols = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for i in range(max(1, len(symbols) - window + 1) if symbols else 0):
                found.setdefault(tuple(symbols[i : i + window]), set()).update([] if name is None else [name])
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.longest, self.shortest = (int(f(self.lengths)) if found else 0 for f in (np.max, np.min))
        self.rows = np.zeros((len(found), self.longest), np.int32)
        for i, p in enumerate(found):
            self.rows[i, self.longest - len(p) :] = p
        self.items = [sorted(names) for names in found.values()]


def _blocks(run: np.ndarray, longest: int) -> list[tuple[int, np.ndarray]]:
    """A run of symbols as (start, block) pairs that hold every phrase of the run whole in at least one block."""
    step = max(1, BLOCK - longest + 1)
    return [(s, run[s : s + step + longest - 1]) for s in range(0, max(1, len(run) - longest + 1), step)]


class Shard:
    """The blocks of a few thousand documents; equal runs of symbols are indexed once."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.sizes, self.bytes, self.symbols = phrases, [], 0, 0
        self.runs: dict[bytes, list[tuple[int, int]]] = {}

    def add(self, texts: list[bytes | None]) -> None:
        split = [words(t) for t in texts]
        sizes = np.array([len(x) for x in split], np.int64)
        get = self.phrases.vocabulary.get
        symbols = np.fromiter(map(get, chain.from_iterable([*x, b""] for x in split), repeat(0)), np.int32)
        base, first = np.concatenate([[0], np.cumsum(sizes + 1)]), len(self.sizes)
        self.sizes += sizes.tolist()
        self.bytes += sum(len(t) for t in texts if t)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (symbols > 0).astype(np.int8), [0]])))
        starts, stops = edge[::2], edge[1::2]
        long_ = stops - starts >= max(1, self.phrases.shortest)
        starts, stops = starts[long_], stops[long_]
        docs = np.searchsorted(base, starts, side="right") - 1
        for d, a, b in zip(docs.tolist(), starts.tolist(), stops.tolist(), strict=True):
            places = self.runs.setdefault(symbols[a:b].tobytes(), [])
            if not places:
                self.symbols += b - a
            places.append((first + d, int(a - base[d])))

    def find(self) -> tuple[list[list[tuple[int, int]]], list[list[str]]]:
        """Merged spans of words and listed items, per document."""
        spans: list[list[tuple[int, int]]] = [[] for _ in self.sizes]
        items: list[list[str]] = [[] for _ in self.sizes]
        if not self.runs or not len(self.phrases.rows):
            return spans, items
        pieces, at, run_of, offset = [], [], [], []
        place = 0
        for r, key in enumerate(self.runs):
            for start, block in _blocks(np.frombuffer(key, np.int32), self.phrases.longest):
                pieces += [block, np.zeros(1, np.int32)]
                at.append(place)
                run_of.append(r)
                offset.append(start)
                place += len(block) + 1
        index = FMIndex(np.concatenate(pieces), len(self.phrases.vocabulary))
        low, high = index.search(self.phrases.rows, self.phrases.lengths)
        counts = high - low
        phrase = np.repeat(np.arange(len(counts)), counts)
        rows = np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        position = index.locate(rows)
        block = np.searchsorted(np.array(at), position, side="right") - 1
        run, start = np.array(run_of)[block], np.array(offset)[block] + position - np.array(at)[block]
        by = np.lexsort((start, run))
        run, start, phrase = run[by], start[by], phrase[by]
        edge = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1, [len(run)]]) if len(run) else np.zeros(1, int)
        places = list(self.runs.values())
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            merged = merge_spans(start[a:b], start[a:b] + self.phrases.lengths[phrase[a:b]])
            names = sorted({name for p in np.unique(phrase[a:b]).tolist() for name in self.phrases.items[p]})
            for doc, moved in places[run[a]]:
                spans[doc] += [(s + moved, e + moved) for s, e in merged]
                items[doc] = names if not items[doc] else sorted({*items[doc], *names})
        return [sorted(s) for s in spans], items


def merge_spans(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one; ``starts`` ascend."""
    if not len(starts):
        return []
    reach = np.maximum.accumulate(stops)
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return list(zip(starts[new].tolist(), reach[last].tolist(), strict=True))


def _union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    both = np.array(sorted(a + b)).reshape(-1, 2)
    return merge_spans(both[:, 0], both[:, 1])


_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _searcher(block, text: str, drop_text: bool):
    """The mapInArrow function that searches one broadcast block of phrases."""

    def run(batches):
        phrases = block.value
        shard, waiting = Shard(phrases), []

        def flush():
            spans, items = shard.find()
            sizes, at = shard.sizes, 0
            for batch in waiting:
                here = slice(at, at + batch.num_rows)
                at += batch.num_rows
                now, named = spans[here], items[here]
                cols = {n: batch.column(n) for n in batch.schema.names if n != "__bytes"}
                if "spans" in cols:
                    before = [[(x["start"], x["stop"]) for x in s] for s in cols["spans"].to_pylist()]
                    now = [_union(a, b) for a, b in zip(before, now, strict=True)]
                    named = [sorted({*a, *b}) for a, b in zip(cols["items"].to_pylist(), named, strict=True)]
                if drop_text:
                    cols.pop(text, None)
                cols["n_words"] = pa.array(sizes[here], pa.int64())
                cols["spans"] = pa.array([[{"start": a, "stop": b} for a, b in s] for s in now], _SPAN_TYPE)
                cols["items"] = pa.array(named, pa.list_(pa.string()))
                yield pa.RecordBatch.from_pydict(cols)

        for batch in batches:
            shard.add(batch.column("__bytes").to_pylist())
            waiting.append(batch)
            if shard.symbols >= SHARD_SYMBOLS or shard.bytes >= SHARD_BYTES:
                yield from flush()
                shard, waiting = Shard(phrases), []
        if waiting:
            yield from flush()

    return run


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, limit: int = PHRASE_BYTES) -> list:
    """The phrases of all items as broadcast blocks of bounded size."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), utf8("text").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total) // limit + 1
    blocks = []
    for i in range(n):
        # An item goes whole into one block, by its hash.
        part = items if n == 1 else items.where(F.expr(f"pmod(xxhash64(name, text), {n})") == i)
        found = Phrases([(r[0], None if r[1] is None else bytes(r[1])) for r in part.toLocalIterator()], window)
        blocks.append(spark.sparkContext.broadcast(found))
    return blocks


def annotate(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", keep_text: bool = True, window: int = WINDOW
) -> DataFrame:
    """``documents`` with ``n_words``, merged removal ``spans`` of words, ``items`` (sorted ids with an occurrence),
    ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` (a twentieth of the words or more are hit)."""
    blocks = phrase_blocks(benchmark, window)
    state = documents.drop(*ADDED, "__bytes")
    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1
        kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema.fields if f.name not in ADDED]
        kept = kept if keep_text or not last else [k for k in kept if not k.startswith(f"`{text}` ")]
        schema = ", ".join([*kept, "n_words long", f"spans {SPANS}", "items array<string>"])
        state = state.withColumn("__bytes", utf8(text))
        if last and not keep_text:
            state = state.drop(text)
        state = state.mapInArrow(_searcher(block, text, not keep_text and last), schema)
        state = state if last else store(state, "decontaminated")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return (
        state.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that the rule leaves, with their columns as they were."""
    return annotate(documents, benchmark).where(~F.col("contaminated")).select(*[f"`{c}`" for c in documents.columns])


def document_contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = annotate(documents.select("doc_id", "text"), benchmark, keep_text=False)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")
