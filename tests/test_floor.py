from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions.scalars import millis, to_millis
from parcelflow.operators import alerts as A
from parcelflow.operators import cases, floor
from parcelflow.plans import api
from tests.helpers import BASE, STATION, _ordered, at, frame, random_rows, scan

ITEMS = "item_id string, name string, category string"
MINUTE = 60_000


@pytest.fixture()
def items(spark):
    return spark.createDataFrame([("i1", "Lamp", "ITEM_CATEGORY_HOME_GOODS")], ITEMS)


def test_one_position_per_package(spark, items):
    rows = [scan("p", "N", BASE + 2, item="i1"), scan("p", "I", BASE + 1), scan("q", "I", BASE, item="gone")]
    got = {r.package_id: (r.station, r.item_name) for r in floor.current_positions(frame(spark, rows), items).collect()}
    assert got == {"p": (STATION["N"], "Lamp"), "q": (STATION["I"], "")}


def positions(spark, *rows):
    full = [(p, STATION[s], at(ms), "", "ITEM_CATEGORY_UNSPECIFIED", False) for p, s, ms in rows]
    return spark.createDataFrame(full, domain.POSITION)


def test_eviction_is_strict(spark):
    df = positions(spark, ("a", "I", BASE), ("b", "I", BASE - 1))
    assert [r.package_id for r in floor.evict_stale(df, at(BASE + 30 * MINUTE)).collect()] == ["a"]


def test_the_two_delay_rules(spark):
    now = BASE + 20 * MINUTE
    df = positions(
        spark, ("fresh", "I", now), ("late", "I", now - 5 * MINUTE), ("risk", "I", now - 8 * MINUTE), ("stuck", "I", now - 10 * MINUTE)
    )
    k = floor.kpis(df, at(now)).first()
    assert (k.in_transit, k.at_risk, k.delayed) == (4, 1, 3)
    per = {r.station: (r.occupancy, r.delayed, r.at_risk) for r in floor.station_kpis(df, at(now)).collect()}
    assert per[STATION["I"]] == (4, 2, 1)
    assert per[STATION["D"]] == (0, 0, 0) and len(per) == 7


def alert(spark, *rows):
    full = [
        (i, p, t, sev, "STATION_TYPE_SORT_A", "", at(ms), 0, 0, "", "", [], "", 0.0, at(ms))
        for i, p, t, sev, ms in rows
    ]
    return spark.createDataFrame(full, domain.ALERT_ROW)


def test_flags_older_than_the_last_scan_are_stale(spark):
    M, D, W = "ALERT_TYPE_MISROUTING", "ALERT_TYPE_DAMAGE", "SEVERITY_WARNING"
    pos = positions(spark, ("a", "I", BASE), ("b", "I", BASE), ("c", "I", BASE))
    raised = alert(
        spark, ("1", "a", D, W, BASE), ("2", "a", M, W, BASE + 5), ("3", "b", M, W, BASE - 1),
        ("4", "c", "ALERT_TYPE_STUCK_PACKAGE", W, BASE + 5),
    )
    got = {r.package_id: r.active_flags for r in cases.with_active_flags(pos, raised, at(BASE + MINUTE)).collect()}
    assert got == {"a": [M, D], "b": [], "c": []}
    later = {r.package_id: r.active_flags for r in cases.with_active_flags(pos, raised, at(BASE + 61 * MINUTE)).collect()}
    assert later["a"] == []


def test_page_arithmetic(spark):
    pos = positions(spark, *[(f"p{i:03d}", "I", BASE - i) for i in range(250)])
    none = alert(spark)
    first = api.list_parcels(pos, none, at(BASE))
    assert first.page.count() == 200 and tuple(first.summary.first()) == (250, True)
    last = api.list_parcels(pos, none, at(BASE), offset=200)
    assert last.page.count() == 50 and tuple(last.summary.first()) == (250, False)
    assert [r.package_id for r in last.page.collect()] == [f"p{i:03d}" for i in range(200, 250)]
    beyond = api.list_parcels(pos, none, at(BASE), offset=300)
    assert beyond.page.count() == 0 and tuple(beyond.summary.first()) == (250, False)


def test_worst_alert_prefers_the_newest_on_a_tie(spark):
    T = "ALERT_TYPE_DAMAGE"
    df = alert(
        spark, ("1", "a", T, "SEVERITY_WARNING", BASE + 9), ("2", "a", T, "SEVERITY_CRITICAL", BASE),
        ("3", "a", T, "SEVERITY_CRITICAL", BASE + 1), ("4", "b", T, "SEVERITY_INFO", BASE),
    )
    assert {r.package_id: r.alert_id for r in A.worst_alerts(df).collect()} == {"a": "3", "b": "4"}
    assert {r.package_id: r.badge for r in A.journey_badges(df).collect()} == {"a": "Flagged"}


def test_station_state_window_and_severity(spark):
    T = "ALERT_TYPE_DAMAGE"
    df = alert(spark, ("1", "a", T, "SEVERITY_WARNING", BASE), ("2", "a", T, "SEVERITY_CRITICAL", BASE - 1), ("3", "a", T, "SEVERITY_INFO", BASE))
    state = lambda ms: {r.station: r.state for r in A.station_alert_state(df, at(ms)).collect()}[STATION["A"]]
    assert state(BASE + 5 * MINUTE - 1) == "critical"
    assert state(BASE + 5 * MINUTE) == "warning"
    assert state(BASE + 6 * MINUTE) == "normal"


def brute_moves(rows):
    found = []
    for package, scans in _ordered(rows).items():
        for before, now in zip(scans, scans[1:]):
            if before[2] != now[2]:
                step = domain.ROUTE.index(now[2]) == domain.ROUTE.index(before[2]) + 1
                found.append((package, now[1], before[2], now[2], now[0], step))
    return sorted(found)


@pytest.mark.parametrize("slot", [1000, 600_000, 3_600_000])
def test_moves_match_brute_force_for_any_slot(spark, slot):
    rng = random.Random(8)
    rows = random_rows(rng, packages=5, scans=400, grain=1000)
    rows += [scan("hot", rng.choice("INABQSD"), BASE + i * 3, event=f"h{i:05d}") for i in range(300)]
    got = floor.station_moves(frame(spark, rows), slot).select(
        "package_id", "event_id", "from_station", "to_station", millis("moved_at"), "adjacent"
    )
    assert sorted(tuple(r) for r in got.collect()) == brute_moves(rows)


@pytest.mark.parametrize("stale", [None, 20 * MINUTE])
def test_queue_depth_matches_brute_force(spark, stale):
    rows = random_rows(random.Random(9), packages=30, scans=400, span=90 * MINUTE)
    end = BASE + 80 * MINUTE
    got = floor.queue_depth(frame(spark, rows), at(end), 10 * MINUTE, 20_000, stale).collect()
    assert len(got) == 31 * 7
    by_package = _ordered(rows)
    for r in got:
        tick = to_millis(r.sampled_at)
        n = 0
        for scans in by_package.values():
            seen = [s for s in scans if s[0] <= tick]
            if seen and seen[-1][2] == r.station and (stale is None or seen[-1][0] >= tick - stale):
                n += 1
        assert r.packages == n, r


def test_detail_match_takes_the_newest_within_a_second(spark):
    T, W = "ALERT_TYPE_DAMAGE", "SEVERITY_WARNING"
    seeds = cases.seed_alerts(alert(spark, ("x", "a", T, W, BASE), ("y", "b", T, W, BASE)))
    detailed = alert(
        spark, ("1", "a", T, W, BASE - 999), ("2", "a", T, W, BASE + 999), ("3", "a", T, W, BASE + 1000),
        ("4", "a", "ALERT_TYPE_MISROUTING", W, BASE), ("5", "b", T, W, BASE - 1000),
    )
    assert [(r.initial_id, r.detail_id) for r in cases.match_detail(seeds, detailed).collect()] == [(f"seed-a-{BASE}", "2")]


def test_nearby_scans_gathers_no_side_on_the_driver(spark):
    # Tables as small as these would be broadcast without a hint, as would wide alerts of any number.
    raised = spark.createDataFrame([("a", "p", at(BASE))], "alert_id string, package_id string, detected_at timestamp")
    near = cases.nearby_scans(raised, frame(spark, [scan("p", "I", BASE)]))
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    assert [r.event_id for r in near.collect()] == [f"e-p-{BASE}"]


def test_nearby_scans_excludes_the_bounds(spark):
    half = 30 * MINUTE
    raised = alert(spark, ("1", "a", "ALERT_TYPE_DAMAGE", "SEVERITY_WARNING", BASE))
    rows = [scan("a", "I", BASE + d) for d in (-half, -half + 1, 0, half - 1, half)] + [scan("b", "I", BASE)]
    got = cases.nearby_scans(raised, frame(spark, rows)).select(millis("scanned_at")).collect()
    assert sorted(r[0] - BASE for r in got) == [-half + 1, 0, half - 1]


def test_live_alerts_hide_seeded_ones(spark):
    T, W = "ALERT_TYPE_DAMAGE", "SEVERITY_WARNING"
    cols = ["alert_id", "package_id", "alert_type", "severity", "station", "message", "detected_at"]
    live = alert(spark, ("1", "a", T, W, BASE)).select(*cols)
    seeded = cases.seed_alerts(alert(spark, ("2", "a", T, W, BASE + 1), ("3", "b", T, W, BASE + 2)))
    shown = cases.displayed_alerts(live, seeded).collect()
    assert [r.alert_id for r in shown] == [f"seed-b-{BASE + 2}", "1"]
    assert shown[0].message == "Damage at Sort A"


def test_damage_windows_include_the_start(spark):
    rows = [scan("a", "I", BASE - 10 * MINUTE, result="SCAN_RESULT_DAMAGE_DETECTED"), scan("a", "I", BASE), scan("a", "I", BASE + 1)]
    r = floor.live_damage_rate(frame(spark, rows), at(BASE)).first()
    assert (r.damage_rate, r.sample_size) == (0.5, 2)
    none = floor.live_damage_rate(frame(spark, rows), at(BASE) + timedelta(days=1)).first()
    assert (none.damage_rate, none.sample_size) == (0.0, 0)


def test_trend_grid_has_zeros_but_no_unused_types(spark):
    rows = [(BASE, "ALERT_TYPE_DAMAGE", 2), (BASE + 3_600_000, "ALERT_TYPE_MISROUTING", 1)]
    trend = spark.createDataFrame(rows, "ms long, alert_type string, alert_count long").withColumn("hour", F.timestamp_millis("ms"))
    got = sorted((r.alert_type, r.alert_count) for r in A.trend_grid(trend).collect())
    assert got == [("ALERT_TYPE_DAMAGE", 0), ("ALERT_TYPE_DAMAGE", 2), ("ALERT_TYPE_MISROUTING", 0), ("ALERT_TYPE_MISROUTING", 1)]
