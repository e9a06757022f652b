"""Every registered query against its SQL on the smallest data set, and checks on the plans."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as contract
from checks import load  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
QUERIES, ORACLE = load().QUERIES, load().ORACLE


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    yield con
    con.close()


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    cursor = duck.execute(ORACLE[name])
    expected = _table([d[0] for d in cursor.description], cursor.fetchall())
    assert _table(df.columns, df.collect()) == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and ORACLE.items() <= contract.oracle_sql().items()
