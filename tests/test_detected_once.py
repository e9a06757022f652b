"""Alerts that are loaded in parts are detected once, not for every part."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from checks.testbed import Testbed
from parcelflow.operators import alerts as A
from parcelflow.operators import dwell, journeys
from tests.helpers import BASE, at, frame, scan


@pytest.mark.parametrize("name", ["snk4_two_loaders_with_restart", "str7_incremental_rollup"])
def test_alerts_are_detected_once(spark, tmp_path, monkeypatch, name):
    scans = frame(spark, [scan(f"p{k}", "I", BASE + k) for k in range(6)])
    alerts = A.union_alerts(
        dwell.stuck_alerts(scans, final_watermark=at(BASE + 86_400_000)), journeys.misrouting_alerts(journeys.sessions(scans))
    )
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(Testbed, "detected", lambda t: alerts.mapInArrow(counted, alerts.schema))
    rows = queries()[name](spark, str(tmp_path)).collect()
    assert (len(rows) if "loaders" in name else sum(r.alert_count for r in rows)) == 12
    assert seen.value == 12
