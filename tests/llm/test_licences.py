"""Similarities against plain cosines, inheritance on a small tree, and the SQL on odd inputs."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import pytest

from parcelflow.llm import licences as L

MIT, APACHE, GPL = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", L.TEMPLATES[8][1]


def plain_best(content):
    """Best template by dense arithmetic."""
    rows, idf, other = L.template_weights()
    tf = Counter(re.findall(L.TERM, content.lower()))
    value = {t: n * idf.get(t, other) for t, n in tf.items()}
    length = math.sqrt(sum(v * v for v in value.values()))
    best = {}
    for k, (name, _) in enumerate(L.TEMPLATES):
        dot = sum(value.get(t, 0) * w for j, _, t, w in rows if j == k)
        if dot > 0:
            best[name] = max(best.get(name, 0), dot / length)
    return min(best.items(), key=lambda x: (-round(x[1], 9), x[0]), default=None)


def test_similarities_against_plain_cosine(spark):
    lines = [t for _, t in L.TEMPLATES] + [
        MIT.upper(), "# " + APACHE + " See LICENSE.", "license", "copyright 2020 somebody else entirely", "Licensed under CC BY-NC 4.0 or GNU GPL",
        "nothing known", "", "MIT MIT MIT license", "licence licence", "under the",
    ]
    frame = spark.createDataFrame(list(enumerate(lines)), "id long, content string")
    got = {r.id: (r.licence, r.similarity) for r in L.similarities(frame, ["id"]).collect()}
    for i, line in enumerate(lines):
        want = plain_best(line)
        assert (got.get(i) is None) == (want is None)
        if want:
            assert got[i][0] == want[0] and abs(got[i][1] - want[1]) < 1e-9
    for i, (name, _) in enumerate(L.TEMPLATES):
        assert got[i][0] == name and got[i][1] > 0.999


def test_nearest_directory_is_inherited(spark):
    filler = "word " * 200
    files = [
        ("LICENSE", GPL), ("a/COPYING.txt", MIT + "\n" + filler), ("a/b/c/notice", APACHE), ("a/b/c/licence.md", APACHE + " and more words of it"),
        ("a/x.py", filler), ("a/b/x.py", filler), ("a/b/c/d/e/x.py", filler), ("z/x.py", "# " + APACHE + "\n" + filler), ("x.py", filler),
        ("z/LICENSE", "no marker here"), ("a/whole.txt", None), (None, ""), ("ab/x.py", filler), ("a/x.py", filler), ("q/r/whole.txt", GPL.lower()), ("q/r/s.py", "long " * 60_000),
    ]
    frame = spark.createDataFrame([(i, p, t, 1, "z") for i, (p, t) in enumerate(files)], "id long, path string, text string, licence int, similarity string")
    out = {r.id: r for r in L.scan(frame, ["id"]).collect()}
    assert len(out) == len(files)
    licence = lambda p: {out[i].licence for i, (q, _) in enumerate(files) if q == p}
    assert licence("a/x.py") == {"MIT"} and licence("a/b/x.py") == {"MIT"} and licence("a/b/c/d/e/x.py") == {"Apache-2.0"}
    assert licence("z/x.py") == {"Apache-2.0"} and licence("x.py") == {"GPL-3.0"} and licence("z/LICENSE") == {"GPL-3.0"}
    assert licence("ab/x.py") == {"GPL-3.0"} and licence("a/whole.txt") == {"MIT"} and licence(None) == {"GPL-3.0"}
    assert licence("q/r/s.py") == {"GPL-3.0"} and out[5].inherited_from == "a" and out[6].inherited_from == "a/b/c" and out[8].inherited_from == ""
    assert out[4].own_licence is None and out[7].own_licence == "Apache-2.0" and out[7].inherited_licence == "GPL-3.0" and out[4].header_lines == 0


@pytest.mark.parametrize("empty", [False, True])
def test_sql_on_odd_documents(spark, documents, empty):
    rows = [] if empty else [
        (1, None), (2, ""), (3, MIT), (4, "text\n" + APACHE + "\r\nmore"), (5, APACHE + "\n" + MIT), (6, "x " * 90_000), (None, GPL), (None, None),
        (7, "LICENSE"), (7, "LICENSE"), (8, "a licence-free line\n\nunder the law"), (9, "Copyright é ſ K LICENSED"),
    ]
    frame = documents(rows)
    got = sorted((tuple(str(x) for x in r) for r in L.document_licences(frame.withColumnRenamed("n_chars", "licence")).collect()))
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    for i, t in rows:
        con.execute("insert into documents values (?, ?, 'en', 's')", [i, t])
    want = con.execute(
        f"select doc_id, path, header_lines, own_licence, similarity, inherited_licence, inherited_from, licence from ({L.licences_sql()})"
    ).fetchall()
    assert got == sorted(tuple(str(x) for x in r) for r in want)
