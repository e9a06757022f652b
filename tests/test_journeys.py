from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions.scalars import millis, to_millis
from parcelflow.operators import journeys
from parcelflow.operators.alerts import with_whole_paths
from tests.helpers import BASE, GAP, STATION, brute_sessions, frame, journey, path, random_rows, scan


def deviation(spark, letters):
    df = spark.createDataFrame([(path(letters),)], "path array<string>")
    return df.select(journeys.first_deviation(F.col("path"))).first()[0]


def alerts(spark, df):
    return journeys.misrouting_alerts(journeys.sessions(df)).collect()


@pytest.mark.parametrize(
    "letters, index",
    [("INABQSD", -1), ("INA", -1), ("INB", 2), ("INABQSDA", -1), ("INABQSDD", -1), ("D", 0), ("", -1)],
)
def test_first_deviation(spark, letters, index):
    assert deviation(spark, letters) == index


@pytest.mark.parametrize("letters", ["INABQSD", "INABQSDA", "INABQSDD"])
def test_clean_journeys_raise_nothing(spark, letters):
    assert alerts(spark, journey(spark, letters)) == []


def test_arrival_order_does_not_matter(spark):
    rows = [scan("p", x, BASE + i * 500) for i, x in enumerate("INABQSD")]
    random.Random(3).shuffle(rows)
    assert alerts(spark, frame(spark, rows)) == []


def test_skipped_station(spark):
    rows = [scan("pkg-7", x, BASE + i * 1000) for i, x in enumerate("INBD")]
    (a,) = alerts(spark, frame(spark, rows))
    assert a.alert_id == "misrouting-pkg-7"
    assert a.severity == "SEVERITY_WARNING"
    assert a.station == "STATION_TYPE_UNSPECIFIED"
    detail = a.misrouting_detail
    assert (detail.expected_station, detail.actual_station) == (STATION["A"], STATION["B"])
    assert detail.path_so_far == path("INBD")
    assert a.message == (
        "Package journey diverged from expected path: expected STATION_TYPE_SORT_A, "
        "observed path ends at STATION_TYPE_SORT_B"
    )
    assert to_millis(a.detected_at) == BASE + 3000


def test_unfinished_journey(spark):
    (a,) = alerts(spark, journey(spark, "INAB"))
    assert a.severity == "SEVERITY_CRITICAL"
    assert a.misrouting_detail.expected_station == STATION["D"]
    assert a.misrouting_detail.actual_station == STATION["B"]


def test_later_scan_keeps_the_alert_id(spark):
    first = alerts(spark, journey(spark, "INBD", "x"))[0].alert_id
    assert alerts(spark, journey(spark, "INBDS", "x"))[0].alert_id == first == "misrouting-x"


def test_no_scans(spark):
    assert alerts(spark, frame(spark, [])) == []


def test_a_gap_of_exactly_the_limit_stays_in_the_session(spark):
    rows = [scan("p", "I", BASE), scan("p", "N", BASE + GAP), scan("p", "A", BASE + 2 * GAP + 1)]
    got = journeys.sessions(frame(spark, rows)).orderBy("session_start").collect()
    assert [s.scan_count for s in got] == [2, 1]


def _sessions(df, **options):
    """Sessions with their whole path, put together from the path rows."""
    rows = journeys.sessions(df, **options).select(
        "package_id", millis("session_start"), millis("last_scan_at"), "scan_count", "head", "last_station"
    )
    paths = {}
    for r in journeys.session_scans(df, **options).select("package_id", millis("session_start"), "position", "station").collect():
        paths.setdefault((r[0], r[1]), []).append((r[2], r[3]))
    found = []
    for package, start, last, count, head, last_station in rows.collect():
        path = sorted(paths[package, start])
        assert [p for p, _ in path] == list(range(1, count + 1))
        stations = [s for _, s in path]
        assert list(head) == stations[: journeys.PATH_STATIONS] and last_station == stations[-1]
        found.append((package, start, last, count, stations))
    return sorted(found)


@pytest.mark.parametrize("seed, grain", [(1, 1), (2, 60_000), (3, 1_200_000)])
def test_sessions_match_brute_force(spark, seed, grain):
    rows = random_rows(random.Random(seed), grain=grain)
    assert _sessions(frame(spark, rows)) == brute_sessions(rows)


def test_very_long_session_of_a_hot_package(spark):
    """A third of all scans in one package: verdict and counts stay exact, no row is lost."""
    rng = random.Random(5)
    hot = [scan("hot", x, BASE + i * 700, event=f"h{i}") for i, x in enumerate("INABQSD")]
    hot += [scan("hot", rng.choice("INABQSD"), BASE + 10_000 + i * 250, event=f"t{i:05d}") for i in range(3000)]
    rows = hot + random_rows(rng, packages=500, scans=6000)
    expected = brute_sessions(rows)
    df = frame(spark, rows)
    assert _sessions(df) == expected
    judged = journeys.verdicts(journeys.sessions(df)).where("package_id = 'hot'").collect()
    last = next(stations[-1] for package, *_, stations in expected if package == "hot")
    assert [(v.deviation_index, v.misrouted, v.actual_station) for v in judged] == [(-1, False, last)]
    tagged = journeys.session_scans(df)
    assert tagged.count() == len(rows)
    sizes = tagged.groupBy("package_id", millis("session_start").alias("s")).count().collect()
    assert sorted((r[0], r[1], r[2]) for r in sizes) == [(p, s, n) for p, s, _, n, _ in expected]


@pytest.mark.parametrize("count", [3, 7, 8, 1500])
def test_alert_and_whole_path_at_every_length(spark, count):
    rows = [scan("p", "I", BASE + i, event=f"e{i:05d}") for i in range(count)]
    df = frame(spark, rows + [scan("q", x, BASE + i) for i, x in enumerate("INABQSD")])
    found = journeys.misrouting_alerts(journeys.sessions(df))
    paths = journeys.misrouted_paths(df)
    (a,) = found.collect()
    assert a.misrouting_detail.path_so_far == [STATION["I"]] * min(count, 1000)
    assert a.attributes == ({} if count <= 1000 else {"path_scans": str(count)})
    assert (a.misrouting_detail.expected_station, a.misrouting_detail.actual_station) == (STATION["N"], STATION["I"])
    assert sorted((r.position, r.event_id) for r in paths.collect()) == [(i + 1, f"e{i:05d}") for i in range(count)]
    assert {r.alert_id for r in paths.collect()} == {"misrouting-p"}
    (whole,) = with_whole_paths(found, paths).collect()
    assert whole.misrouting_detail.path_so_far == [STATION["I"]] * count and whole.alert_id == a.alert_id


def test_a_longer_route_is_refused(spark):
    with pytest.raises(ValueError):
        journeys.verdicts(journeys.sessions(frame(spark, [])), (*domain.ROUTE, "STATION_TYPE_INTAKE"))


def test_slots_are_reduced_before_the_shuffle(spark):
    plan = journeys.sessions(journey(spark, "INA"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "partial_max" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
