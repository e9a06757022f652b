"""About a third of all scans in one package, many of them at the same moment."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from checks import detection, oracle, registry, state
from checks.testbed import Testbed
from parcelflow.operators import cases, dwell, floor, journeys
from parcelflow.operators import alerts as A
from parcelflow.sources import tables

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

HOT = "right(item_id, 1) in ('1', '4', '7')"
SKEWED = f"""
select event_id, case when {HOT} then 'pkg-hot' else package_id end package_id, station, scanner_id,
  case when {HOT} then timestamp '2026-08-20 12:00:00' + interval '1' second * cast(hour(scanned_at) * 90 as int)
    else scanned_at end scanned_at, result, damage_type, damage_confidence, item_id
from ({tables.SCANS_SQL})"""


class Skewed(Testbed):
    @property
    def scans(self):
        return self.spark.sql(SKEWED, lineitem=tables.table(self.spark, SF, "lineitem"))


@pytest.fixture(scope="module")
def bed(spark):
    return Skewed(spark, SF)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("lineitem", "part", "events"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    yield con
    con.close()


def compare(duck, monkeypatch, df, sql):
    monkeypatch.setitem(oracle.VIEWS, "scans", SKEWED.format(lineitem="lineitem"))
    cursor = duck.execute(registry.with_views(sql))
    names = [d[0] for d in cursor.description]
    expected = sorted(tuple(str(x) for x in r) for r in cursor.fetchall())
    got = registry.plain(df).select(*names)
    assert sorted(tuple(str(x) for x in r) for r in got.collect()) == expected
    return expected


def test_the_hot_package_is_hot(bed):
    counts = {r[0]: r[1] for r in bed.scans.groupBy((F.col("package_id") == "pkg-hot")).count().collect()}
    assert counts[True] > 0.25 * (counts[True] + counts[False])


def test_sessions(bed, duck, monkeypatch):
    df = journeys.sessions(bed.scans).select(
        "package_id", "session_start", "last_scan_at", "scan_count", "reached_dispatch", "head", "last_station"
    )
    sql = """select package_id, start_ms session_start, last_ms last_scan_at, scan_count, reached reached_dispatch,
      array_to_string(path[1:1000], '>') head, path[len(path)] last_station from sess"""
    rows = compare(duck, monkeypatch, df, sql)
    assert max(int(r[3]) for r in rows) > 1000


def test_verdicts(bed, duck, monkeypatch):
    df = journeys.verdicts(journeys.sessions(bed.scans)).select(
        "package_id", "session_start", "deviation_index", "misrouted", "expected_station", "actual_station"
    )
    sql = """select package_id, start_ms session_start, cast(dev as int) deviation_index, misrouted,
      expected_station, actual_station from verdict"""
    compare(duck, monkeypatch, df, sql)


def test_whole_paths_as_rows(bed, duck, monkeypatch):
    df = journeys.session_scans(bed.scans).select("package_id", "session_start", "position", "station")
    compare(duck, monkeypatch, df, detection.PATH_ROWS_SQL.format(sessions="select * from sess"))
    sql = """select concat('misrouting-', package_id) alert_id, last_ms detected_at,
      unnest(range(1, len(path) + 1)) as "position", unnest(path) station from sess where dev <> -1 or not reached"""
    paths = journeys.misrouted_paths(bed.scans).select("alert_id", "detected_at", "position", "station")
    compare(duck, monkeypatch, paths, sql)


def test_stuck(bed, duck, monkeypatch):
    compare(duck, monkeypatch, dwell.stuck_points(bed.scans), "select package_id, station, last_ms from stuck_point")


@pytest.mark.parametrize("slot_ms", [60_000, 3_600_000])
def test_moves(bed, duck, monkeypatch, slot_ms):
    sql = """select package_id, event_id, prev from_station, station to_station, epoch_ms(scanned_at) moved_at
    from (select *, lag(station) over (partition by package_id order by scanned_at, event_id) prev from scans)
    where prev <> station"""
    compare(duck, monkeypatch, floor.station_moves(bed.scans, slot_ms).drop("adjacent"), sql)


def test_positions_and_queue(bed, duck, monkeypatch):
    compare(duck, monkeypatch, bed.positions, f"select {state.POSITION_COLUMNS} from positions")
    sql = state.QUEUE_SQL.format(route=oracle.ROUTE_LIST, end=f"epoch_ms({state.NOON})", stale="and p.ms >= tick - 1800000")
    compare(duck, monkeypatch, floor.queue_depth(bed.scans, state._noon(bed)), sql)


def test_alert_lookups(bed, duck, monkeypatch):
    compare(duck, monkeypatch, A.flatten_alerts(bed.detected()).where("alert_type <> 'ALERT_TYPE_MISROUTING'"),
            f"select {detection.ALERT_COLUMNS} from alerts where alert_type <> 'ALERT_TYPE_MISROUTING'")
    stuck = A.flatten_alerts(dwell.stuck_alerts(bed.scans))
    near = cases.nearby_scans(stuck, bed.scans).select("alert_id", "event_id")
    compare(duck, monkeypatch, near, """select a.alert_id, s.event_id from stuck a join scans s
      on s.package_id = a.package_id and abs(epoch_ms(s.scanned_at) - a.detected_ms) < 1800000""")
