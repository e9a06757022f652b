"""Best-fit packing of tokenized documents into sequences of one length.

Documents become pieces of at most ``capacity`` tokens. Packing goes in bulk-synchronous rounds over
documents and gaps in the order of their sizes: in a round the waiting documents of the largest size
meet their successor gap (the smallest that holds them); if more documents than gaps ask, the ones of
lower rank get them and the others go on to the next gap; the gaps shrink, and the next round begins.
Documents without a gap open sequences.

Sizes are whole numbers up to ``capacity``, so documents of one size and sequences with one gap are
runs of ranks, and a round moves whole runs at once. Spark numbers the pieces within their size
(range-wise, in many parts, so that a size that a third of all pieces share is no hot group) and counts
them. The rounds go over the table of sizes and numbers, which has at most ``capacity`` rows however many
pieces there are; a join by rank then tells every piece its sequence and offset. All pieces are packed
together at every size of the input, so the number of sequences is that of a one-by-one best fit.

Defined cases: a null or empty text is one piece with the end token alone; a text of any length is cut
into full pieces and a last one; repeated rows are packed each, and pieces of one size take their places
in the order of the row numbers; columns named ``sequence_id`` or ``offset`` are replaced, other extra
columns of ``pieces`` stay; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import store, utf8

CAPACITY = 4096
END_ID = 1
#: Parts in which the pieces of one size are numbered, at least, and pieces of a part, on average, at most.
PARTS = 256
PART_PIECES = 1 << 20
#: Chunks that a Python worker remembers (some 100 MB), and the bytes of the longest that it does.
CACHE_CHUNKS = 500_000
CACHE_BYTES = 48

PIECES = "piece int, start long, length long, ids_crc32 long"


#: Lower-case words of ASCII and Latin-1 letters: already normal, and one token group each.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: 256 + i for i, b in enumerate(rest)}


class ChunkTokenizer(dict):
    """Token ids (little-endian, unsigned, 32 bits) of chunks between ASCII white space, looked up or made.

    No token of the word-level vocabulary reaches across white space, and neither normalization nor
    lower-casing does, so the ids of a text are those of its chunks in a row. Sentence marks at the end
    of a chunk, after an ASCII letter or digit, are tokens of their own and are looked up apart. Plain
    words go straight to the tokenizer's model, all others through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.before: dict[bytes, bytes] = {}

    def __missing__(self, chunk: bytes) -> bytes:
        out = self.before.get(chunk)
        if out is not None:
            self[chunk] = out
            return out
        core = chunk.rstrip(b".,!?;:")
        if len(core) < len(chunk) and core[-1:].isalnum():
            out = self[core] + self[chunk[len(core) :]]
        else:
            if _PLAIN.fullmatch(chunk):
                ids = [t.id for t in self.model.tokenize(chunk.decode("latin-1").translate(self.letters))]
            else:
                ids = self.tokenizer.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(chunk) <= CACHE_BYTES:
            self[chunk] = out
        return out

    def ids(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text, with the end id.

        A-Z is lower-cased first, as the tokenizer does, except in texts that could hold a special token
        (these are matched before lower-casing).
        """
        end, out = END_ID.to_bytes(4, "little"), []
        for t in texts:
            if len(self) > CACHE_CHUNKS:  # chunks seen since the last time stay at hand, the others go
                self.before = dict(self)
                self.clear()
            out.append(b"".join(map(self.__getitem__, (t if b"<|" in t else t.lower()).split())) + end if t else end)
        return out


_tokenizers: dict[str, ChunkTokenizer] = {}


def tokenizer_of(path: str) -> ChunkTokenizer:
    """The tokenizer that the tasks of one Python worker share."""
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path)
    return _tokenizers[path]


def tokenized_pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece`` (from 0), ``start`` (ids before it), ``length``, ``ids_crc32``."""
    step = 4 * capacity

    def run(batches):
        tokenizer = tokenizer_of(tokenizer_path)
        for batch in batches:
            ids = tokenizer.ids(batch.column(1).to_pylist())
            cuts = [(d, i, b[i * step : (i + 1) * step]) for d, b in enumerate(ids) for i in range(-(-len(b) // step))]
            doc = pa.array([d for d, _, _ in cuts], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(doc),
                    pa.array([i for _, i, _ in cuts], pa.int32()),
                    pa.array([i * capacity for _, i, _ in cuts], pa.int64()),
                    pa.array([len(b) // 4 for _, _, b in cuts], pa.int64()),
                    pa.array([zlib.crc32(b) for _, _, b in cuts], pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", utf8("text").alias("text")).mapInArrow(run, f"doc_id {kind}, {PIECES}")


def sweep(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit over runs: ``(size, first rank, number, first sequence, offset)`` for each run that was placed.

    The documents of ranks r, r+1, ... of a size go to the sequences s, s+1, ..., all at one offset.
    """
    moves: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # runs of sequences (first, number) by what they have left
    order: list[int] = []
    opened = 0

    def leave(gap: int, first: int, number: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, number))

    for size in sorted(counts, reverse=True):
        rank, waiting = 0, counts[size]
        while waiting:
            at = bisect.bisect_left(order, size)
            if at < len(order):
                gap = order[at]
                first, number = gaps[gap].pop()
                placed = min(number, waiting)
                if placed < number:
                    gaps[gap].append((first + placed, number - placed))
                if not gaps[gap]:
                    del gaps[gap], order[at]
            else:
                # As many sequences as the documents fill to the last, then one for the rest.
                gap, first, placed = capacity, opened, max(1, waiting // (capacity // size))
                opened += placed
            moves.append((size, rank, placed, first, capacity - gap))
            leave(gap - size, first, placed)
            rank += placed
            waiting -= placed
    return moves


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs a column ``length`` from 1 to ``capacity``.

    ``part_pieces`` sets in how many parts pieces are numbered; the number of sequences does not depend on it.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    kept = store(pieces.select(*names).withColumn("__id", F.monotonically_increasing_id()), "pieces")
    keys = ["length", "__part"]
    parts_of = max(PARTS, kept.count() // part_pieces + 1)
    dealt = kept.withColumn("__part", F.pmod(F.hash("__id"), F.lit(parts_of)))
    counts = store(dealt.groupBy(*keys).agg(F.count("*").alias("__n")), "sizes")

    def best_fit(pdf: pd.DataFrame) -> pd.DataFrame:
        moves = sweep(dict(zip(pdf["length"].tolist(), pdf["__n"].tolist(), strict=True)), capacity)
        return pd.DataFrame(moves, columns=["length", "__rank", "__number", "__first", "offset"], dtype="int64")

    moves = (
        counts.groupBy("length")
        .agg(F.sum("__n").alias("__n"))
        .groupBy()
        .applyInPandas(best_fit, "length long, __rank long, __number long, __first long, offset long")
    )
    by_part = Window.partitionBy("length").orderBy("__part")
    parts = counts.withColumn("__begin", F.sum("__n").over(by_part) - F.col("__n"))
    # Each part's share of a move, in ranks of the part.
    low = F.greatest("__rank", "__begin")
    high = F.least(F.col("__rank") + F.col("__number"), F.col("__begin") + F.col("__n"))
    shares = (
        parts.join(moves, "length")
        .where(low < high)
        .select(
            *keys,
            (low - F.col("__begin")).alias("__low"),
            (high - F.col("__begin")).alias("__high"),
            (F.col("__first") + F.col("__begin") - F.col("__rank")).alias("__shift"),
            "offset",
        )
    )
    ranked = dealt.withColumn("__at", F.row_number().over(Window.partitionBy(*keys).orderBy("__id")).cast("long") - 1)
    return (
        ranked.join(shares, keys)
        .where((F.col("__at") >= F.col("__low")) & (F.col("__at") < F.col("__high")))
        .withColumn("sequence_id", F.col("__shift") + F.col("__at"))
        .select(*names, "sequence_id", "offset")
    )


def pack_documents(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents, packed."""
    return pack(tokenized_pieces(documents, tokenizer_path, capacity), capacity)
