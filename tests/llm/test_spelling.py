"""Spelling variants against words compared one by one."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelflow.llm import spelling as S

LOWER = str.maketrans(S.UPPER, S.LOWER)


def brute_words(rows, damaged=199):
    out = Counter()
    for i, text in rows:
        for word in re.findall(S.RUN, text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % damaged == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            out[word] += 1
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    form, rows = {}, []
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 5 * n:
                form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(rows, key=str)


def result(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def made_words(seed, n):
    r = random.Random(seed)
    stems = ["".join(r.choice("abeé") for _ in range(r.randint(5, 8))) for _ in range(n // 6)]
    words = {}
    for stem in stems:
        words[stem] = r.choice([5, 30, 150, 800])
        for _ in range(5):
            k = r.randrange(len(stem))
            words[r.choice([stem[:k] + stem[k + 1 :], stem[:k] + r.choice("abÿ") + stem[k:], stem[:k] + "x" + stem[k + 1 :]])] = r.choice([5, 6, 31])
    return words


@pytest.mark.parametrize("tile", [512, 3])
def test_variants_against_all_pairs(spark, tile):
    words = made_words(1, 400) | {"a" * 3000: 9, "a" * 2999: 50, "b": 7, "c": 90, "ab": 5}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").withColumn("form", F.lit("clash"))
    assert result(S.variants(frame, tile=tile, batch=50)) == brute(words)


def test_documents_against_words_one_by_one(spark, documents):
    r = random.Random(2)
    words = [w.capitalize() if r.random() < 0.2 else w for w in made_words(3, 120)]
    rows = [(i, r.choice([" ", "-", "1"]).join(r.choices(words, [1 / (k + 1) for k in range(len(words))], k=400))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "123 ..."), (None, rows[0][1]), (103, "Æther×÷ß " * 9), (104, "z" * 100_000), rows[5], rows[5]]
    frame = documents(rows).withColumn("word", F.lit("clash"))
    counts = brute_words(rows)
    got = {r["word"]: r["n"] for r in S.occurrences(frame).groupBy("word").agg(F.count("*").alias("n")).collect()}
    assert got == counts
    kept = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    assert result(S.document_variants(frame)) == brute(kept)


def test_no_documents(spark, documents):
    assert result(S.document_variants(documents([]))) == []
    assert result(S.document_variants(documents([(1, None), (2, "short words")]))) == []


def test_chains_lead_to_their_end(spark):
    words = {f"{'a' * (6 + k)}": 5 ** (k + 1) for k in range(12)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {r["root"] for r in S.variants(frame).collect()} == {"a" * 17}


@given(st.lists(st.text("abc", max_size=6), min_size=2, max_size=8, unique=True))
@settings(max_examples=200, deadline=None)
def test_tiles_find_every_single_edit(words):
    found = set()
    for longer in range(1, 8):
        for front in (True, False):
            h = longer // 2
            files = {}
            for w in words:
                if len(w) in (longer, longer - 1):
                    files.setdefault(w[:h] if front else w[len(w) - (longer - h) :], []).append(w)
            for half, own in files.items():
                i, j = S.near_pairs(own, own, longer, front)
                pairs = [(own[x], own[y]) for x, y in zip(i, j, strict=True)]
                assert not found & set(pairs)
                found |= set(pairs)
    assert found == {(a, b) for a in words for b in words if one_edit(a, b)}
