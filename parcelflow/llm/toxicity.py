"""Toxicity by compression distance: two zstandard dictionaries, and which of them makes windows shorter.

A text is lower-cased (A-Z), split into words and cut into windows of ``WINDOW_WORDS`` words. A word is a
run of letters with the other characters that follow it, up to white space; characters ahead of the first letter are a word of
their own, longer words are cut into pieces of ``CODED_LETTERS`` bytes, and in scripts without spaces a word begins
at every letter and reaches as far as a piece. So every byte of a text but white space is in a window.
Words are written as path codes, ``CODE_BYTES`` bytes for each leading part of the word, so that two
words share bytes exactly as far as they agree from their first letter, and a match inside an
unrelated word counts for nothing. Two dictionaries are trained on a bounded sample of labelled texts:
the ordinary one holds the most frequent words of ordinary texts; the toxic one holds the same and the
words and stems that mark toxic texts. A window's gain is its compressed length with the ordinary
dictionary less that with the toxic one. The number of windows above each gain threshold, and their
share, give the score through a logistic calibration on the same sample. Only ``doc_id`` chooses
training rows and only the text is scored.

Defined cases: null, empty and blank texts have no window and get the score of a text without gain;
without labels of both classes every score is the share of toxic labels (0.0 if there is none);
repeated and conflicting labels count once, as toxic.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import held_out, map_texts, utf8
from parcelflow.llm.labelled import fit_logistic, label_sample

#: Labelled documents of each class to learn from, about, and the text of both classes that is read at most.
SAMPLE_PER_CLASS = 3_000
SAMPLE_BYTES = 64_000_000
WINDOW_WORDS = 4
CODE_BYTES, CODED_LETTERS = 3, 12
DICTIONARY_BYTES = 65_536
GAINS = (2, 4, 6, 8, 10, 12)
#: A stem marks toxic texts if this many hold it, this many times the share of ordinary ones.
MARK_TEXTS, MARK_RATIO, MARK_LETTERS = 5, 15.0, 4
REJECT = 0.7
CACHE_WORDS = 200_000


def _char_class(spans) -> str:
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in spans)


#: Scripts that put no spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, Japanese, Chinese.
_UNSPACED = _char_class(
    [(0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF)]
    + [(0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]
)
_COMBINING = "".join(map(re.escape, filter(lambda c: unicodedata.category(c)[0] == "M", map(chr, range(0x300, 0x20000)))))
_LETTER = rf"(?:(?![{_UNSPACED}])(?:[^\W\d_]|[{_COMBINING}]))"
_PARTS = re.compile(rf"([{_UNSPACED}]+)|{_LETTER}+(?:(?!{_LETTER}|[{_UNSPACED}])\S)*|(?:(?!{_LETTER}|[{_UNSPACED}])\S)+")
_PLAIN_PARTS = re.compile(rb"[a-z]+[^a-z]*|[^a-z]+")


def _parts(chunk: bytes) -> list[bytes]:
    """The words of a lower-cased text without ASCII white space."""
    if len(chunk) <= CODED_LETTERS and (chunk.isalpha() or chunk[:-1].isalpha() and chunk[-1] < 128):
        return [chunk]  # most words
    if chunk.isascii():
        parts = _PLAIN_PARTS.findall(chunk)
    else:
        parts = []
        text = chunk.decode("utf-8", "surrogateescape")
        if len(chunk) <= CODED_LETTERS and text.isalpha() and max(text) < "\u0e00":
            return [chunk]
        for m in _PARTS.finditer(text):
            run = m.group(1)
            words = (run[i : i + CODED_LETTERS] for i in range(len(run))) if run else (m.group(),)
            encoded = (w.encode("utf-8", "surrogateescape") for w in words)
            parts += [w[:CODED_LETTERS] for w in encoded] if run else encoded
    return [p[i : i + CODED_LETTERS] for p in parts for i in range(0, len(p), CODED_LETTERS)]


def _words(text: bytes) -> set[bytes]:
    return {p for chunk in set(text.lower().split()) for p in _parts(chunk)}


def _windows(text: bytes | None, known: dict[bytes, list[bytes]]) -> list[bytes]:
    codes = []
    if text:
        for chunk in text.lower().split():
            found = known.get(chunk)
            if found is None:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                found = list(map(_path_code, _parts(chunk)))
                if len(chunk) <= 64:
                    known[chunk] = found
            codes += found
    return [b"".join(codes[i : i + WINDOW_WORDS]) for i in range(0, len(codes), WINDOW_WORDS)]


def _path_code(word: bytes) -> bytes:
    out, crc = [], 0
    for i in range(len(word)):
        crc = zlib.crc32(word[i : i + 1], crc)
        out.append(crc.to_bytes(4, "little")[:CODE_BYTES])
    return b"".join(out)


@dataclass
class Model:
    """Two dictionaries and the calibration; small, so it goes to the tasks with the function."""

    ordinary: bytes
    toxic: bytes
    weights: list[float]

    def compressors(self):
        parameters = zstandard.ZstdCompressionParameters.from_level(
            3, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        return [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                compression_params=parameters,
            ).compress
            for d in (self.ordinary, self.toxic)
        ]

    def features(self, texts) -> np.ndarray:
        ordinary, toxic = self.compressors()
        known: dict[bytes, list[bytes]] = {}
        return np.array([self._of(t, ordinary, toxic, known) for t in texts]).reshape(-1, 2 * len(GAINS) + 1)

    @staticmethod
    def _of(text, ordinary, toxic, known) -> list[float]:
        gains = [len(ordinary(w)) - len(toxic(w)) for w in _windows(text, known)]
        n = len(gains)
        above = [sum(map(g.__le__, gains)) for g in GAINS]
        return [*np.log1p(above), np.log1p(n), *(10 * a / max(n, 1) for a in above)]

    def scorer(self):
        """A function from texts to scores that keeps its compressors and words."""
        if not self.ordinary:
            constant = 1 / (1 + np.exp(-self.weights[0]))
            return lambda texts: np.full(len(texts), constant)
        ordinary, toxic = self.compressors()
        known: dict[bytes, list[bytes]] = {}
        weights = np.array(self.weights)

        def score(texts):
            x = np.array([self._of(t, ordinary, toxic, known) for t in texts]).reshape(len(texts), -1)
            return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))

        return score


def _marks(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Leading parts of words that many toxic and few ordinary texts hold; the longest of each line, rarest first."""

    def stems(texts):
        counts: Counter[bytes] = Counter()
        for t in texts:
            counts.update({w[:k] for w in _words(t) for k in range(MARK_LETTERS, len(w) + 1)})
        return counts

    t, o = stems(toxic), stems(ordinary)
    marks = {s for s, n in t.items() if n >= MARK_TEXTS and n * len(ordinary) > MARK_RATIO * (o[s] + 0.5) * len(toxic)}
    inner = {s[:k] for s in marks for k in range(1, len(s))}
    return sorted(marks - inner, key=lambda s: (t[s], s))


def train(rows: list[tuple[bytes, int]], stands_for: dict[int, float]) -> Model:
    """A model from (text, label) rows; ``stands_for``: how many rows a row of each class stands for."""
    toxic, ordinary = ([t for t, y in rows if y == k] for k in (1, 0))
    if not toxic or not ordinary:
        share = float(np.clip(len(toxic) / max(len(rows), 1), 1e-9, 1 - 1e-9))
        return Model(b"", b"", [float(np.log(share / (1 - share)))])
    counts: Counter[bytes] = Counter()
    for t in ordinary:
        counts.update(_words(t))
    frequent, size = [], 0
    for word, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        code = _path_code(word)
        size += len(code)
        if size > DICTIONARY_BYTES:
            break
        frequent.append(code)
    body = b"".join(reversed(frequent)) or b"\0" * 8  # the most frequent last, where offsets are short
    marks = b"".join(map(_path_code, _marks(toxic, ordinary)))[-DICTIONARY_BYTES:]
    model = Model(body, body + marks, [])
    x, y = model.features([t for t, _ in rows]), np.array([k for _, k in rows])
    model.weights = fit_logistic(x, y, np.array([stands_for[k] for _, k in rows])).tolist()
    return model


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Trains on a bounded sample: about ``SAMPLE_PER_CLASS`` documents a class, and ``SAMPLE_BYTES`` of text.

    Each class has half of these bytes. A class with more is learnt from its shortest texts, one at least, which then
    stand for the others too.
    """
    sample, stands_for = label_sample(labels, label, SAMPLE_PER_CLASS)
    texts = (
        documents.select("doc_id", "text")
        .where(F.col("text").isNotNull())
        .join(F.broadcast(sample), "doc_id")  # 2 * SAMPLE_PER_CLASS short rows or so
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .select("doc_id", utf8("text").alias("text"), "label")
    )
    of_class = Window.partitionBy("label")  # rows of the sample only
    shortest = of_class.orderBy(F.octet_length("text"), "doc_id")
    kept = (
        texts.withColumn("n", F.count("*").over(of_class))
        .withColumn("place", F.row_number().over(shortest))
        .withColumn("bytes", F.sum(F.octet_length("text").cast("long")).over(shortest.rowsBetween(Window.unboundedPreceding, 0)))
        .where((F.col("bytes") <= SAMPLE_BYTES // 2) | (F.col("place") == 1))
        .select("text", "label", "n")
    )
    rows, sampled = [], {}
    for row in kept.toLocalIterator():
        rows.append((bytes(row["text"]), row["label"]))
        sampled[row["label"]] = row["n"]
    count = Counter(k for _, k in rows)
    return train(sorted(rows), {k: stands_for[k] * sampled[k] / count[k] for k in count})


def with_score(documents: DataFrame, model: Model, column: str = "toxicity", keep: list[str] | None = None) -> DataFrame:
    """``documents`` (or its columns ``keep``) with a score from 0 to 1 of each whole text."""

    def make():
        score = model.scorer()
        return lambda texts: [pa.array(score(texts), pa.float64())]

    return map_texts(documents, {column: "double"}, make, keep)


def document_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from ``REJECT`` on) of every document."""
    scored = with_score(documents, fit(documents, labels), "score", keep=["doc_id"])
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted")
    )


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the rejection score, with their columns as they were."""
    scored = with_score(documents, fit(documents, labels), "__toxicity").where(F.col("__toxicity") < REJECT)
    return scored.select(*[f"`{c}`" for c in documents.columns])
