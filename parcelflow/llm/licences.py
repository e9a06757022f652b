"""Licence scan: sparse TF-IDF cosine to licence templates, then inheritance from the nearest directory.

Lines that hold a marker word are header lines. Each header line, and the whole text of each file that
has one, is compared with every template: words weighted by term frequency and by how few templates
hold them, cosine of the sparse vectors. A line at ``LINE_SIMILARITY`` gives its file a licence of its
own; a file that is named like a licence file, or reaches ``FILE_SIMILARITY`` as a whole, governs its
directory and all below. Files take their own licence, else that of the nearest governed directory.

All of it is DataFrame operations. Texts are read once and only header material goes on; directories are
resolved as distinct paths before files meet them, and that join can be split by adaptive execution, so
a directory with a third of all files is no hot group. Templates are a short fixed list.

Defined cases: a null or empty text has no header line; a null path is the empty path in the root
directory; of several licence files in a directory the most similar counts, then the smallest path; ties
between templates go to the smaller name; repeated rows are judged each.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import store

LINE_SIMILARITY, FILE_SIMILARITY = 0.6, 0.6

# Short licence notices, the words that mark a header line, the names of licence files.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0)."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
MARKERS = "licen[cs]e[ds]?|licensing|unlicense|copyright|copyleft|spdx|permission|redistribution|redistribute|unencumbered|waived"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)[^/]*$"

MARKER = f"(?i)(^|[^a-z0-9])({MARKERS})([^a-z0-9]|$)"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def template_weights(templates=TEMPLATES) -> tuple[list[tuple[int, str, str, float]], dict[str, float], float]:
    """Rows ``(number, name, term, weight)`` of unit length per template, the idf of each term, and that of any other word."""
    counted = [Counter(re.findall(TERM, text.lower())) for _, text in templates]
    frequency = Counter(t for c in counted for t in c)
    idf = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in frequency.items()}
    rows = []
    for k, ((name, _), c) in enumerate(zip(templates, counted, strict=True)):
        length = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        rows += [(k, name, t, n * idf[t] / length) for t, n in sorted(c.items())]
    return rows, idf, math.log(1 + len(templates)) + 1


def _template_table(spark: SparkSession, templates) -> DataFrame:
    return spark.createDataFrame(template_weights(templates)[0], "template int, licence string, term string, weight double")


def similarities(units: DataFrame, keys: list[str], templates=TEMPLATES) -> DataFrame:
    """``keys``, ``licence``, ``similarity``: the best template of each unit of ``units(keys, content)`` that shares a term with one."""
    spark = units.sparkSession
    _, idf, other = template_weights(templates)
    idfs = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    terms = (
        units.select(*keys, F.explode(F.regexp_extract_all(F.lower("content"), F.lit(TERM), F.lit(0))).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count("*").alias("tf"))
        .join(F.broadcast(idfs), "term", "left")  # the terms of the template list
        .withColumn("value", F.col("tf") * F.coalesce("idf", F.lit(other)))
    )
    weights = (
        _template_table(spark, templates)
        .groupBy("term")
        .agg(F.collect_list(F.struct("template", "licence", "weight")).alias("in_templates"))  # bounded by the list
    )
    numbers = [F.lit(k) for k in range(len(templates))]
    weight_of = F.coalesce(
        F.aggregate(
            F.filter("in_templates", lambda x: x["template"] == F.col("template")), F.lit(0.0), lambda a, x: a + x["weight"]
        ),
        F.lit(0.0),
    )
    matched = terms.join(F.broadcast(weights), "term", "left").withColumn("template", F.explode(F.array(*numbers)))
    dots = matched.groupBy(*keys, "template").agg(
        F.sum(F.col("value") * weight_of).alias("dot"), F.sum(F.col("value") * F.col("value")).alias("square")
    )
    names = F.array(*[F.lit(name) for name, _ in templates])
    scored = dots.where("dot > 0").select(
        *keys, names[F.col("template")].alias("licence"), (F.col("dot") / F.sqrt("square")).alias("similarity")
    )
    best = scored.groupBy(*keys, "licence").agg(F.max("similarity").alias("similarity"))
    # The most similar; among equals (to 9 digits) the smaller name.
    order = F.struct((-F.round("similarity", 9)).alias("first"), F.col("licence"), F.col("similarity"))
    top = best.groupBy(*keys).agg(F.min(order).alias("top"))
    return top.select(*keys, F.col("top")["licence"].alias("licence"), F.col("top")["similarity"].alias("similarity"))


def _directory(path: str) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_extract(path, "^(.*)/[^/]*$", 1)).otherwise("")


def scan(files: DataFrame, keep: list[str], templates=TEMPLATES) -> DataFrame:
    """Licences of ``files(path, text)``: the columns ``keep`` and ``path``, ``header_lines``, ``own_licence``,
    ``similarity``, ``inherited_licence``, ``inherited_from`` and ``licence`` (own, else inherited) of every row."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(MARKER))
    rows = store(
        files.withColumn("__row", F.monotonically_increasing_id())
        .select(*keep, "__row", F.coalesce("path", F.lit("")).alias("path"), lines.alias("lines"), "text")
        .withColumn("text", F.when(F.size("lines") > 0, F.col("text"))),
        "headers",
    )
    marked = rows.where(F.size("lines") > 0)
    units = marked.select("__row", F.posexplode("lines").alias("unit", "content")).union(
        marked.select("__row", F.lit(-1).alias("unit"), F.col("text").alias("content"))
    )
    found = store(similarities(units, ["__row", "unit"], templates), "similarities")
    order = F.struct((-F.round("similarity", 9)).alias("first"), F.col("licence"), F.col("similarity"))
    own = (
        found.where((F.col("unit") >= 0) & (F.col("similarity") >= LINE_SIMILARITY))
        .groupBy("__row")
        .agg(F.min(order).alias("own"))
        .select("__row", F.col("own")["licence"].alias("own_licence"), F.col("own")["similarity"].alias("similarity"))
    )
    whole = found.where("unit = -1").select("__row", F.col("licence").alias("file_licence"), F.col("similarity").alias("file_similarity"))
    judged = store(
        rows.select(*keep, "__row", "path", F.size("lines").alias("header_lines"), _directory("path").alias("directory"))
        .join(own, "__row", "left")
        .join(whole, "__row", "left"),
        "judged",
    )
    named = F.col("path").rlike(LICENCE_FILE)
    governs = (F.col("file_similarity") >= FILE_SIMILARITY) | (named & F.col("file_licence").isNotNull())
    pick = F.struct((-F.round("file_similarity", 9)).alias("first"), F.col("path"), F.col("file_licence"))
    governed = (
        judged.where(governs)
        .groupBy("directory")
        .agg(F.min(pick).alias("pick"))
        .select(F.col("directory").alias("ancestor"), F.col("pick")["file_licence"].alias("licence"))
    )
    parts = F.split("directory", "/")
    depths = F.sequence(F.lit(0), F.when(F.col("directory") == "", 0).otherwise(F.size(parts)))
    ancestors = (
        judged.select("directory")
        .distinct()
        .select("directory", F.explode(depths).alias("depth"))
        .withColumn("ancestor", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    )
    nearest = store(
        ancestors.join(governed, "ancestor")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "ancestor", "licence")).alias("near"))
        .select(
            "directory", F.col("near")["ancestor"].alias("inherited_from"), F.col("near")["licence"].alias("inherited_licence")
        ),
        "nearest",
    )
    out = judged.join(nearest, "directory", "left")
    return out.select(
        *keep,
        "path",
        "header_lines",
        "own_licence",
        "similarity",
        "inherited_licence",
        "inherited_from",
        F.coalesce("own_licence", "inherited_licence").alias("licence"),
    )


def document_path() -> Column:
    """The place of a document: its source and language are directories."""
    return F.concat(
        F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")), F.lit("/"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(".txt"),
    )


def document_licences(documents: DataFrame) -> DataFrame:
    """The licence of every document; similarities to four digits."""
    files = documents.select("doc_id", document_path().alias("path"), "text")
    return scan(files, ["doc_id"]).withColumn("similarity", F.round("similarity", 4))


def licences_sql(templates=TEMPLATES) -> str:
    """The same result in SQL over ``documents``."""
    rows, idf, other = template_weights(templates)
    weights = ", ".join(f"({k}, '{name}', '{t}', {w!r}::double)" for k, name, t, w in rows)
    idfs = ", ".join(f"('{t}', {v!r}::double)" for t, v in sorted(idf.items()))
    order = "round({0}, 9) desc, {1}"
    return f"""
with weights(template, licence, term, weight) as (values {weights}),
idfs(term, idf) as (values {idfs}),
files as (
  select row_number() over () r, doc_id, concat(coalesce(source, ''), '/', coalesce(lang, ''), '/',
    coalesce(cast(doc_id as varchar), ''), '.txt') path, coalesce(text, '') text from documents),
lines as (
  select r, doc_id, path, text, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{MARKER}')) ls from files),
units as (
  select r, unnest(range(len(ls))) unit, unnest(ls) content from lines where len(ls) > 0
  union all select r, -1, text from lines where len(ls) > 0),
terms as (
  select r, unit, term, count(*) * coalesce(any_value(idf), {other!r}) v
  from (select r, unit, unnest(regexp_extract_all(lower(content), '{TERM}')) term from units) left join idfs using (term)
  group by all),
lengths as (select r, unit, sqrt(sum(v * v)) length from terms group by all),
dots as (select r, unit, template, any_value(licence) licence, sum(v * weight) dot from terms join weights using (term) group by all),
best as (
  select r, unit, licence, max(dot / length) s from dots join lengths using (r, unit) group by all),
top as (
  select * from best qualify row_number() over (partition by r, unit order by {order.format("s", "licence")}) = 1),
own as (
  select r, licence own_licence, s similarity from top where unit >= 0 and s >= {LINE_SIMILARITY}
  qualify row_number() over (partition by r order by {order.format("s", "licence")}) = 1),
judged as (
  select l.r, doc_id, path, len(ls) header_lines, regexp_extract(path, '^(.*)/[^/]*$', 1) directory,
    own_licence, similarity, t.licence file_licence, t.s file_similarity
  from lines l left join own using (r) left join top t on t.r = l.r and t.unit = -1),
governed as (
  select directory ancestor, file_licence licence from judged
  where file_similarity >= {FILE_SIMILARITY} or (file_licence is not null and regexp_matches(path, '{LICENCE_FILE}'))
  qualify row_number() over (partition by directory order by round(file_similarity, 9) desc, path) = 1),
places as (
  select directory, unnest(range(0, case when directory = '' then 1 else len(string_split(directory, '/')) + 1 end)) depth
  from (select distinct directory from judged)),
nearest as (
  select directory, ancestor inherited_from, licence inherited_licence from (
    select directory, depth, array_to_string(string_split(directory, '/')[1:depth], '/') a from places)
  join governed on ancestor = a
  qualify row_number() over (partition by directory order by depth desc) = 1)
select doc_id, path, cast(header_lines as int) header_lines, own_licence, round(similarity, 4) similarity, inherited_licence,
  inherited_from, coalesce(own_licence, inherited_licence) licence
from judged left join nearest using (directory)"""
