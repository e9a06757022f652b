from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions.scalars import utc
from parcelflow.operators import alerts as A
from parcelflow.operators import reports
from parcelflow.plans import api
from parcelflow.plans.ranges import resolve_range
from parcelflow.sources import items, lake, warehouse

DAY = utc("2026-08-10 00:00:00")


def lake_frame(spark, rows):
    full = [(e, p, st, "scanner", when, res, "", 0.0, item) for e, p, st, when, res, item in rows]
    return spark.createDataFrame(full, domain.LAKE_ROW)


@pytest.fixture()
def scans(spark):
    rows = [
        ("e1", "p1", "STATION_TYPE_INTAKE", DAY + timedelta(hours=1), "SCAN_RESULT_OK", "i1"),
        ("e2", "p1", "STATION_TYPE_INTAKE", DAY + timedelta(hours=23, minutes=59), "SCAN_RESULT_DAMAGE_DETECTED", "i1"),
        ("e3", "p2", "STATION_TYPE_SORT_A", DAY + timedelta(days=1), "SCAN_RESULT_UNREADABLE", ""),
    ]
    return lake_frame(spark, rows)


def test_day_read(spark, scans, tmp_path):
    root = str(tmp_path / "lake")
    lake.write_lake(scans, root)
    got = lake.read_lake_day(spark, root, "2026-08-10")
    assert sorted((r.event_id, r.hour) for r in got.collect()) == [("e1", 1), ("e2", 23)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_day_without_data_keeps_the_schema(spark, scans, tmp_path):
    root = str(tmp_path / "lake")
    lake.write_lake(scans, root)
    empty = lake.read_lake_day(spark, root, "2020-01-01")
    assert empty.count() == 0
    assert empty.schema == lake.read_lake_day(spark, root, "2026-08-10").schema
    assert dict(empty.dtypes)["hour"] == "int"


def test_missing_lake(spark, tmp_path):
    root = str(tmp_path / "nowhere")
    with pytest.raises(FileNotFoundError):
        lake.read_lake_day(spark, root, "2026-08-10")
    assert lake.read_package_scans(spark, root, "p1").count() == 0


def test_package_filter_reaches_the_scan(spark, scans, tmp_path):
    root = str(tmp_path / "lake")
    lake.write_lake(scans, root)
    got = lake.read_package_scans(spark, root, "p1")
    assert [r.event_id for r in got.collect()] == ["e1", "e2"]
    assert "EqualTo(package_id,p1)" in got._jdf.queryExecution().executedPlan().toString()


def test_late_rows_append_to_their_own_hour(spark, scans, tmp_path):
    root = str(tmp_path / "lake")
    lake.write_lake(scans.where("event_id <> 'e1'"), root)
    lake.write_lake(scans.where("event_id = 'e1'"), root)
    assert lake.read_lake_day(spark, root, date(2026, 8, 10)).count() == 2


def test_missing_catalog(spark, tmp_path):
    path = str(tmp_path / "items")
    with pytest.raises(FileNotFoundError):
        items.read_items(spark, path)
    assert items.read_items(spark, path, live=True).count() == 0


def nested(spark, kind, station="STATION_TYPE_UNSPECIFIED", **detail):
    row = ("a", "p", kind, "SEVERITY_WARNING", "m", station, DAY,
           detail.get("stuck"), detail.get("damage"), detail.get("misrouting"), {})
    return spark.createDataFrame([row], domain.ALERT)


def test_flatten_misrouting_takes_the_actual_station(spark):
    df = nested(spark, "ALERT_TYPE_MISROUTING", misrouting=("STATION_TYPE_SORT_A", "STATION_TYPE_SORT_B", ["STATION_TYPE_INTAKE"]))
    r = A.flatten_alerts(df).first()
    assert r.station == r.actual_station == "STATION_TYPE_SORT_B"
    assert r.path_so_far == ["STATION_TYPE_INTAKE"] and r.threshold_seconds == 0 and r.damage_type == ""


def test_flatten_without_detail_keeps_all_defaults(spark):
    r = A.flatten_alerts(nested(spark, "ALERT_TYPE_STUCK_PACKAGE", "STATION_TYPE_SORT_A")).first()
    assert r.station == "STATION_TYPE_SORT_A"
    assert (r.stuck_duration_seconds, r.threshold_seconds, r.expected_station, r.actual_station) == (0, 0, "", "")
    assert (r.path_so_far, r.damage_type, r.damage_confidence) == ([], "", 0.0)


def test_nesting_fills_only_the_matching_branch(spark):
    flat = A.flatten_alerts(nested(spark, "ALERT_TYPE_STUCK_PACKAGE", "STATION_TYPE_SORT_A", stuck=(DAY, 600, 600)))
    r = A.nest_alert_detail(flat).first()
    assert r.stuck_detail.threshold_seconds == 600
    assert r.damage_detail is None and r.misrouting_detail is None


def test_alert_wire_round_trip_and_quarantine(spark):
    df = nested(spark, "ALERT_TYPE_DAMAGE", "STATION_TYPE_SORT_A", damage=("DAMAGE_TYPE_WET", 0.5, ""))
    wire = A.encode_alerts(df)
    good, bad = A.decode_alerts(wire.unionByName(spark.createDataFrame([("k", "%%%")], wire.schema)))
    assert good.count() == 1 and bad.count() == 1
    assert good.first().damage_detail.damage_type == "DAMAGE_TYPE_WET"


def test_repeated_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    df = nested(spark, "ALERT_TYPE_STUCK_PACKAGE", "STATION_TYPE_SORT_A", stuck=(DAY, 600, 600))
    for _ in range(2):
        warehouse.append_alerts(df, root, batch_id=4)
    warehouse.append_alerts(df, root, batch_id=5)
    assert warehouse.read_alerts(spark, root).count() == 2
    merged = A.merge_rollup(warehouse.read_rollup(spark, root), "alert_type").first()
    assert merged.alert_count == 2


def test_alerts_since_a_time_prune_days(spark, tmp_path):
    root = str(tmp_path)
    df = nested(spark, "ALERT_TYPE_STUCK_PACKAGE", "STATION_TYPE_SORT_A")
    for back in (0, 3, 9):
        warehouse.append_alerts(df.withColumn("detected_at", F.lit(DAY - timedelta(days=back))), root)
    recent = warehouse.read_alerts(spark, root, floor=DAY - timedelta(days=3))
    assert recent.count() == 2
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(detected_date" in plan


def test_empty_warehouse(spark, tmp_path):
    assert warehouse.read_alerts(spark, str(tmp_path)).schema == domain.ALERT_ROW
    assert warehouse.read_rollup(spark, str(tmp_path)).count() == 0
    assert warehouse.scalar(warehouse.read_alerts(spark, str(tmp_path)).select("alert_id")) is None


def test_daily_reports_are_idempotent(spark, scans, tmp_path):
    lake_root, root = str(tmp_path / "lake"), str(tmp_path / "wh")
    lake.write_lake(scans, lake_root)
    catalog = spark.createDataFrame([("i1", "Lamp", "ITEM_CATEGORY_TOYS")], "item_id string, name string, category string")
    for _ in range(2):
        api.run_daily_reports(spark, lake_root, root, catalog, "2026-08-10", "2026-08-12")
    report = warehouse.read_report(spark, warehouse.report_path(root, "daily_station_throughput"))
    got = sorted((str(r.report_date), r.station, r.scan_count, r.unique_packages, r.damage_count, r.unreadable_count) for r in report.collect())
    assert got == [("2026-08-10", "STATION_TYPE_INTAKE", 2, 1, 1, 0), ("2026-08-11", "STATION_TYPE_SORT_A", 1, 1, 0, 1)]
    recon = warehouse.read_report(spark, warehouse.report_path(root, "daily_reconciliation"))
    flags = {str(r.report_date): (r.lake_event_count, r.lake_has_traffic_but_no_alerts) for r in recon.collect()}
    assert flags == {"2026-08-10": (2, 1), "2026-08-11": (1, 1), "2026-08-12": (0, 0)}
    rates = warehouse.read_report(spark, warehouse.report_path(root, "daily_damage_rate_by_category"))
    assert {(r.item_category, r.damage_rate) for r in rates.collect()} == {("ITEM_CATEGORY_TOYS", 0.5), ("ITEM_CATEGORY_UNSPECIFIED", 0.0)}


def test_latest_version_per_key(spark):
    rows = [(1, "a", 10, DAY), (1, "a", 12, DAY + timedelta(hours=1)), (2, "b", 5, DAY)]
    df = spark.createDataFrame(rows, "k int, s string, n int, inserted_at timestamp")
    assert {(r.k, r.n) for r in warehouse.read_latest(df, ["k", "s"]).collect()} == {(1, 12), (2, 5)}


def test_csv_quotes(spark, tmp_path):
    rows = [('p"1', "ALERT_TYPE_DAMAGE", "STATION_TYPE_SORT_A", DAY), ("p2", "ALERT_TYPE_X", "", DAY)]
    df = spark.createDataFrame(rows, "package_id string, alert_type string, station string, detected_at timestamp")
    warehouse.export_csv(df.coalesce(1), str(tmp_path / "csv"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "csv")).collect()]
    assert lines == [
        '"Parcel ID","Issue","Station","Detected At"',
        '"p""1","Damage","Sort A","2026-08-10T00:00:00.000Z"',
        '"p2","Alert","","2026-08-10T00:00:00.000Z"',
    ]


def test_ranges():
    now = utc("2026-08-10 09:30:00")
    today = resolve_range("today", as_of=now)
    assert str(today.report_floor) == "2026-08-09" and today.floor == now - timedelta(days=1) and today.ceiling == now
    assert resolve_range("decade", as_of=now) == today
    assert resolve_range("month", as_of=now).floor == now - timedelta(days=30)
    custom = resolve_range("week", "2026-08-01", "2026-08-01", now)
    assert str(custom.ceiling) == "2026-08-01 23:59:59+00:00" and str(custom.report_floor) == "2026-08-01"
    assert resolve_range("week", "2026-08-01", "", now) == resolve_range("week", as_of=now)
    for bad in ("2026-8-1", "2026-08-01'; --", "2026-08-01\n"):
        with pytest.raises(ValueError):
            resolve_range("", bad, "2026-08-02")


def test_bad_requests(spark):
    span = resolve_range("today", as_of=DAY)
    with pytest.raises(ValueError):
        api.station_stats(None, None, "STATION_TYPE_UNSPECIFIED", span)
    with pytest.raises(ValueError):
        api.list_parcels(None, None, DAY, sort_field="dwell_time; drop")


def test_rates_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], "report_date date, station string, scan_count long, damage_count long")
    assert reports.damage_rate(empty).first().damage_rate == 0.0
    assert reports.throughput_total(empty).first().throughput_total == 0


def test_retention(spark, tmp_path):
    root = str(tmp_path)
    df = nested(spark, "ALERT_TYPE_STUCK_PACKAGE", "STATION_TYPE_SORT_A")
    old = df.withColumn("detected_at", F.lit("2026-01-01").cast("timestamp"))
    warehouse.append_alerts(df.unionByName(old), root)
    assert warehouse.drop_expired(spark, root, DAY, days=90) == 1
    assert warehouse.read_alerts(spark, root).count() == 1
    assert A.retain(warehouse.read_alerts(spark, root), DAY + timedelta(days=91)).count() == 0
