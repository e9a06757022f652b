"""Positions that a query reads several times are computed once."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from checks.testbed import Testbed
from parcelflow.operators import alerts as A
from parcelflow.operators import dwell, journeys
from tests.helpers import BASE, at, frame, scan

SCHEMA = "package_id string, station string, updated_at timestamp, item_name string, item_category string, damage_detected boolean"


@pytest.mark.parametrize(
    "name, rows",
    [("api4_next_page_after_a_row", 30), ("ord4_deep_page", 20), ("ord4_deep_page_of_a_status", 40), ("ord4_deep_page_summary", 1)],
)
def test_positions_are_computed_once(spark, tmp_path, monkeypatch, name, rows):
    n = 80
    scans = frame(spark, [scan(f"p{k:02d}", "I", BASE + k) for k in range(n)])
    alerts = A.union_alerts(dwell.stuck_alerts(scans), journeys.misrouting_alerts(journeys.sessions(scans)))
    # None is known later than as_of, and all are stuck by then.
    positions = spark.createDataFrame([(f"p{k:02d}", "STATION_TYPE_INTAKE", at(BASE + k), "", "", False) for k in range(n)], SCHEMA)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(Testbed, "as_of", at(BASE + 86_400_000))
    monkeypatch.setattr(Testbed, "detected", lambda t: alerts)
    monkeypatch.setattr(Testbed, "positions", property(lambda t: positions.mapInArrow(counted, SCHEMA)))
    assert queries()[name](spark, str(tmp_path)).count() == rows
    assert seen.value == n
