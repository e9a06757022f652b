"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.oracle import VIEWS
from checks.testbed import Testbed, testbed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _plain(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(column)
    if isinstance(kind, T.DateType):
        return column.cast("string")
    if isinstance(kind, T.FloatType):
        return column.cast("double")
    if isinstance(kind, T.ArrayType):
        return F.array_join(column, ">")
    return column


def plain(df: DataFrame) -> DataFrame:
    """Engine-neutral values: times as epoch ms, dates as text, arrays joined by ``>``."""
    return df.select(*[_plain(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def with_views(sql: str) -> str:
    """Puts the view definitions that a text uses, directly or through others, in front of it."""
    names = list(VIEWS)
    used = set()
    texts = [(sql, len(names))]
    while texts:
        text, above = texts.pop()
        for i, name in enumerate(names[:above]):
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                texts.append((VIEWS[name], i))
    needed = [name for name in names if name in used]
    if not needed:
        return sql
    heads = ",\n".join(f"{name} as materialized ({VIEWS[name].strip()})" for name in needed)
    return f"with {heads}\n{sql.strip()}"


def check(name: str, sql: str | None = None):
    """Registers ``build(t: Testbed) -> DataFrame`` under ``name``."""

    def register(build: Callable[[Testbed], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: plain(build(testbed(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return build

    return register
