"""Scans near alerts in two streams, against the pairs counted by hand."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest

from parcelflow.functions.scalars import to_millis
from parcelflow.streaming import live
from tests.helpers import BASE, SCHEMA, at, frame, scan

ALERT = "alert_id string, package_id string, detected_at timestamp"
HALF = 1_800_000


def _run(spark, folder, steps, **options):
    """The pairs of several micro-batches (alerts, scans), and the most rows that the join has held."""
    names = ("alerts", "scans", "out", "checkpoint")
    alerts_in, scans_in, out, checkpoint = (str(folder / n) for n in names)
    held = 0
    for alerts, scans in steps:
        spark.createDataFrame(alerts, ALERT).coalesce(1).write.mode("append").parquet(alerts_in)
        frame(spark, scans).coalesce(1).write.mode("append").parquet(scans_in)
        found = live.nearby_scan_stream(
            spark.readStream.schema(ALERT).parquet(alerts_in), spark.readStream.schema(SCHEMA).parquet(scans_in), **options
        )
        writer = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        held = max(held, *(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress))
    return sorted((r.alert_id, r.event_id, r.scanned_at) for r in spark.read.schema(found.schema).parquet(out).collect()), held


def _pairs(alerts, scans, half_ms=HALF):
    width = timedelta(milliseconds=half_ms)
    return sorted(
        (a, event, seen.replace(tzinfo=None))
        for a, package, raised in alerts
        for event, of, _, seen, *_ in scans
        if package is not None and of == package and None not in (raised, seen) and abs(seen - raised) < width
    )


def _random(rng, n, span):
    alerts = [(f"a{k}", f"p{rng.randrange(3)}", at(BASE + rng.randrange(span))) for k in range(n)]
    scans = [scan(f"p{rng.randrange(3)}", "N", BASE + rng.randrange(span), f"e{k}") for k in range(n)]
    return alerts, scans


@pytest.mark.parametrize("cuts", [1, 3])
def test_pairs_of_any_batch_cutting(spark, tmp_path, cuts):
    alerts, scans = _random(random.Random(5), 90, 12 * HALF)
    steps = [(alerts[k::cuts], scans[k::cuts]) for k in range(cuts)]
    # Nothing is late here.
    got, _ = _run(spark, tmp_path, steps, delay_ms=20 * HALF)
    assert got == _pairs(alerts, scans) and got


def test_bounds_microseconds_and_missing_values(spark, tmp_path):
    border = BASE - BASE % (4 * HALF) + 4 * HALF
    tiny = timedelta(microseconds=1)
    alerts = [("a", "p", at(border)), ("b", "p", at(border - 1)), ("c", None, at(border)), ("d", "q", None)]
    times = [at(border + d) + e for d in (-HALF, HALF) for e in (-tiny, timedelta(0), tiny)]
    scans = [(f"e{k}", "p", "S", t, "SCAN_RESULT_OK", "") for k, t in enumerate(times)]
    scans += [("n", None, "S", at(border), "SCAN_RESULT_OK", ""), ("t", "p", "S", None, "SCAN_RESULT_OK", "")]
    got, _ = _run(spark, tmp_path, [(alerts, scans)])
    assert got == _pairs(alerts, scans) and {(a, e) for a, e, _ in got} >= {("a", "e2"), ("a", "e3"), ("b", "e0")}


def test_rows_of_a_package_and_slot_are_one_row_of_the_state(spark, tmp_path):
    # Three rows an alert and one a scan took most of the time of a large table.
    alerts = [(f"a{k}", "p", at(BASE + k)) for k in range(40)]
    scans = [scan("p", "N", BASE + k, f"e{k}") for k in range(60)]
    got, held = _run(spark, tmp_path, [(alerts, scans)])
    assert len(got) == 2400 and to_millis(got[0][2]) >= BASE and held <= 8


def test_packages_share_rows_of_the_state_until_they_are_not_needed(spark, tmp_path, monkeypatch):
    # A row of state for each package and slot took most of the time of a large table.
    monkeypatch.setattr(live, "NEAR_GROUPS", 3)
    alerts = [(f"a{k}", f"p{k}", at(BASE + k)) for k in range(200)]
    scans = [scan(f"p{k}", "N", BASE + HALF // 2 + k, f"e{k}") for k in range(200)]
    late = [scan(f"p{k}", "N", BASE - k, f"f{k}") for k in range(0, 200, 20)]
    far = BASE + 40 * HALF
    # Scans in a later batch than their alerts, then time goes on.
    first, held = _run(spark, tmp_path, [(alerts, []), ([], scans)])
    assert first == _pairs(alerts, scans) and held <= 3 * 5
    then, held = _run(spark, tmp_path, [([("b", "p1", at(far))], [scan("p1", "N", far, "g")]), ([("c", "q", at(far))], late)])
    assert [r for r in then if r not in first] == [("b", "g", at(far).replace(tzinfo=None))]
    _, held = _run(spark, tmp_path, [([], [])])
    assert held <= 2 * 5
