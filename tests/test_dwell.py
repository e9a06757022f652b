from __future__ import annotations

import random

import pytest

from parcelflow.functions.scalars import millis, to_millis
from parcelflow.operators import dwell
from tests.helpers import BASE, at, brute_stuck, frame, random_rows, scan

S = 600_000


def test_alert_fields(spark):
    rows = [scan("pkg-2", "A", BASE), scan("other", "I", BASE + 10 * S)]
    (a,) = dwell.stuck_alerts(frame(spark, rows), threshold_ms=15_000, ooo_ms=0).where("package_id='pkg-2'").collect()
    assert a.alert_id == f"stuck-pkg-2-{BASE + 15_000}"
    assert a.severity == "SEVERITY_WARNING"
    assert a.station == "STATION_TYPE_SORT_A"
    assert a.stuck_detail.stuck_duration_seconds == 15
    assert a.stuck_detail.threshold_seconds == 15
    assert to_millis(a.stuck_detail.last_scan_at) == BASE
    assert to_millis(a.detected_at) == BASE + 15_000
    assert a.message == "Package stuck at STATION_TYPE_SORT_A for 15+ seconds with no further scan"
    assert a.misrouting_detail is None and a.damage_detail is None


def test_threshold_text():
    assert dwell.threshold_text(600_000) == "10+ minutes"
    assert dwell.threshold_text(59_999) == "59+ seconds"


def test_a_package_can_be_stuck_again(spark):
    rows = [scan("p", "I", BASE), scan("p", "N", BASE + S + 1), scan("p", "A", BASE + 3 * S), scan("q", "I", BASE + 9 * S)]
    got = dwell.stuck_points(frame(spark, rows)).where("package_id='p'").count()
    assert got == 3


def test_follow_up_at_exactly_the_threshold_is_in_time(spark):
    rows = [scan("p", "I", BASE), scan("p", "N", BASE + S), scan("q", "I", BASE + 9 * S)]
    got = dwell.stuck_points(frame(spark, rows)).where("package_id='p'").collect()
    assert [r.last_ms for r in got] == [BASE + S]


def test_pending_until_the_watermark(spark):
    rows = [scan("p", "I", BASE), scan("q", "I", BASE + S + 30_000)]
    assert dwell.stuck_points(frame(spark, rows)).count() == 0
    rows[1] = scan("q", "I", BASE + S + 30_001)
    assert dwell.stuck_points(frame(spark, rows)).count() == 1
    assert dwell.stuck_points(frame(spark, rows), final_watermark=at(BASE + 2 * S + 30_001)).count() == 2


def test_dispatch_counts_unless_excluded(spark):
    rows = [scan("p", "D", BASE), scan("q", "I", BASE + 9 * S)]
    assert dwell.stuck_points(frame(spark, rows)).count() == 1
    assert dwell.stuck_points(frame(spark, rows), exclude_terminal=True).count() == 0


@pytest.mark.parametrize("seed, grain", [(1, 1), (2, 60_000), (3, 600_000)])
def test_matches_brute_force(spark, seed, grain):
    rows = random_rows(random.Random(seed), grain=grain)
    newest = max(to_millis(r[3]) for r in rows)
    got = dwell.stuck_points(frame(spark, rows)).collect()
    assert sorted((r.package_id, r.station, r.last_ms) for r in got) == brute_stuck(rows, S, newest - 30_001)


def test_damage_promotion(spark):
    rows = [("e1", "p", "STATION_TYPE_SORT_A", at(BASE), "SCAN_RESULT_DAMAGE_DETECTED", "DAMAGE_TYPE_WET", 0.9),
            ("e2", "p", "STATION_TYPE_SORT_A", at(BASE), "SCAN_RESULT_DAMAGE_DETECTED", "DAMAGE_TYPE_WET", 0.5),
            ("e3", "p", "STATION_TYPE_SORT_A", at(BASE), "SCAN_RESULT_OK", "", 0.9)]
    df = spark.createDataFrame(rows, "event_id string, package_id string, station string, scanned_at timestamp, "
                                     "result string, damage_type string, damage_confidence double")
    (a,) = dwell.damage_alerts(df).select("alert_id", "damage_detail", millis("detected_at").alias("ms")).collect()
    assert a.alert_id == "damage-e1" and a.damage_detail.damage_type == "DAMAGE_TYPE_WET" and a.ms == BASE
