"""Lake, warehouse, reports and the statistics read from them."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.detection import ALERT_COLUMNS
from checks.oracle import ROUTE_LIST
from checks.registry import check
from parcelflow import domain
from parcelflow.functions import scalars as S
from parcelflow.operators import alerts as A
from parcelflow.operators import reports
from parcelflow.plans import api
from parcelflow.plans.ranges import resolve_range
from parcelflow.sources import items as item_source
from parcelflow.sources import lake, warehouse

LAKE_COLUMNS = """event_id, package_id, station, scanner_id, epoch_ms(scanned_at) scanned_at, result, damage_type,
  cast(cast(damage_confidence as real) as double) damage_confidence, item_id"""
DAY = "2026-08-10"
BUSIEST = "(select package_id from scans group by 1 order by count(*) desc, package_id limit 1)"


def _busiest(t) -> str:
    counts = t.scans.groupBy("package_id").count()
    return counts.orderBy(F.desc("count"), "package_id").first()["package_id"]


# --- lake and items ----------------------------------------------------------------------------


@check(
    "snk3_lake_round_trip",
    f"""select {LAKE_COLUMNS}, cast(cast(scanned_at as date) as varchar) as "date",
      cast(hour(scanned_at) as int) as "hour" from scans""",
)
def _(t):
    return lake.read_lake(t.spark, t.lake_root)


@check(
    "src3_read_lake_day",
    f"""select {LAKE_COLUMNS}, cast(hour(scanned_at) as int) as "hour" from scans
      where cast(scanned_at as date) = date '{DAY}'""",
)
def _(t):
    return lake.read_lake_day(t.spark, t.lake_root, DAY)


@check(
    "src3_read_lake_range",
    f"""select {LAKE_COLUMNS}, cast(hour(scanned_at) as int) as "hour" from scans
      where cast(scanned_at as date) between date '2026-08-05' and date '2026-08-12'""",
)
def _(t):
    return lake.read_lake_range(t.spark, t.lake_root, "2026-08-05", "2026-08-12")


@check(
    "src4_read_package_scans",
    f"select {LAKE_COLUMNS} from scans where package_id = {BUSIEST}",
)
def _(t):
    return lake.read_package_scans(t.spark, t.lake_root, _busiest(t))


@check(
    "flt3_package_equality",
    f"select event_id, station from scans where package_id = {BUSIEST}",
)
def _(t):
    return lake.read_lake(t.spark, t.lake_root).where(F.col("package_id") == _busiest(t)).select("event_id", "station")


@check(
    "snk3_compacted_day",
    f"select {LAKE_COLUMNS} from scans where cast(scanned_at as date) = date '{DAY}'",
)
def _(t):
    root = t.folder("compacted")
    day = t.scans.where(F.to_date("scanned_at") == F.lit(DAY).cast("date"))
    late = F.col("result") == "SCAN_RESULT_UNREADABLE"
    lake.write_lake(day.where(~late), root)
    lake.compact_day(t.spark, root, DAY)
    # Rows that come later stay beside the compacted part, and the next run merges them.
    lake.write_lake(day.where(late), root)
    lake.compact_day(t.spark, root, DAY)
    lake.clean_lake(t.spark, root, grace_ms=0)
    return lake.read_lake(t.spark, root).drop("date", "hour")


@check(
    "src4_package_by_index",
    f"select {LAKE_COLUMNS} from scans where package_id = {BUSIEST}",
)
def _(t):
    root = t.folder("indexed")
    late = F.col("result") == "SCAN_RESULT_UNREADABLE"
    lake.write_lake(t.scans.where(~late), root)
    busiest = _busiest(t)
    seen = t.scans.where(F.col("package_id") == busiest).select(F.to_date("scanned_at").cast("string").alias("d"))
    for day in sorted({r.d for r in seen.distinct().collect()} | {DAY}):
        lake.compact_day(t.spark, root, day, buckets=8)
    lake.write_lake(t.scans.where(late), root)  # not in the index yet
    return lake.read_package_scans(t.spark, root, busiest, buckets=8)


@check("src5_item_dimension", "select item_id, name, sku, category, unit_weight_kg, stock_quantity from items")
def _(t):
    path = t.folder("items")
    t.items.write.parquet(path)
    return item_source.read_items(t.spark, path).drop("catalog_updated_at")


@check(
    "src5_missing_catalog_on_live_path",
    "select package_id, '' item_name, 'ITEM_CATEGORY_UNSPECIFIED' item_category from positions",
)
def _(t):
    from parcelflow.operators import floor

    items = item_source.read_items(t.spark, f"{t.root}/no-items", live=True)
    return floor.current_positions(t.scans, items).select("package_id", "item_name", "item_category")


@check(
    "src6_parameterised_query",
    "select station, count(*) n from alerts where alert_type = 'ALERT_TYPE_MISROUTING' group by 1",
)
def _(t):
    text = "select station, count(*) n from {alerts} where alert_type = :kind group by station"
    return warehouse.query(t.spark, text, {"kind": "ALERT_TYPE_MISROUTING"}, alerts=t.alerts)


# --- alert table and rollup --------------------------------------------------------------------


@check(
    "snk4_alert_table",
    """select alert_id, package_id, alert_type, severity, station, message, detected_ms detected_at,
      stuck_duration_seconds, threshold_seconds, expected_station, actual_station, path_so_far, damage_type,
      damage_confidence, (select ms from as_of) inserted_at from alerts""",
)
def _(t):
    return t.alerts


@check(
    "snk4_alerts_since_a_time",
    """select alert_id, detected_ms detected_at from alerts
    where detected_at >= (select t from as_of) - interval '7' day""",
)
def _(t):
    since = t.as_of - timedelta(days=7)
    return warehouse.read_alerts(t.spark, t.warehouse_root, floor=since).select("alert_id", "detected_at")


@check(
    "agg4_hourly_rollup",
    """select epoch_ms(hour_at) as "hour", alert_type, severity, station, alert_count from rollup""",
)
def _(t):
    return A.hourly_rollup(t.alerts)


@check(
    "agg4_stored_partials_merged",
    """select epoch_ms(hour_at) as "hour", alert_type, severity, station, alert_count from rollup""",
)
def _(t):
    return A.merge_rollup(t.rollup, "hour", "alert_type", "severity", "station")


@check(
    "agg5_last_24_hours",
    """select epoch_ms(hour_at) as "hour", alert_type, cast(sum(alert_count) as bigint) alert_count from rollup
    where hour_at between (select t from as_of) - interval '34' hour and (select t from as_of) - interval '10' hour
    group by 1, 2""",
)
def _(t):
    return A.recent_rollup(t.rollup, t.as_of - timedelta(hours=10))


@check(
    "agg24_latest_alert_versions",
    """select alert_id, package_id, severity, station, detected_ms detected_at, path_so_far from (
      select *, row_number() over (partition by alert_id order by detected_ms desc) rn from alerts) where rn = 1""",
)
def _(t):
    return A.latest_alerts(t.alerts).select(
        "alert_id", "package_id", "severity", "station", "detected_at", "path_so_far"
    )


@check(
    "snk7_alerts_in_retention",
    """select alert_id, detected_ms detected_at from alerts
    where detected_at >= (select t from as_of) + interval '75' day - interval '90' day""",
)
def _(t):
    return A.retain(t.alerts, t.as_of + timedelta(days=75)).select("alert_id", "detected_at")


@check(
    "snk7_expired_days_dropped",
    """select alert_id, detected_ms detected_at from alerts
    where cast(detected_at as date) >= cast((select t from as_of) + interval '75' day as date) - 90""",
)
def _(t):
    root = t.folder("retention")
    warehouse.append_alerts(t.alerts.drop("inserted_at"), root, inserted_at=t.as_of)
    warehouse.drop_expired(t.spark, root, t.as_of + timedelta(days=75))
    return warehouse.read_alerts(t.spark, root).select("alert_id", "detected_at")


@check("snk4_compacted_alert_days", f"select {ALERT_COLUMNS} from alerts")
def _(t):
    root = t.folder("compacted-alerts")
    older, newer = (t.alerts.drop("inserted_at").where(f"alert_id {x} 'misrouting'") for x in ("<", ">="))
    warehouse.append_alerts(older, root, inserted_at=t.as_of)
    for day in (1, 2, 2, 10):
        warehouse.compact_alert_day(t.spark, root, date(2026, 8, day))
    # Rows that come after a day was compacted stay visible beside it, and are merged by the next run.
    warehouse.append_alerts(newer, root, inserted_at=t.as_of)
    warehouse.compact_alert_day(t.spark, root, date(2026, 8, 2))
    warehouse.clean(t.spark, root, grace_ms=0)
    return warehouse.read_alerts(t.spark, root).drop("inserted_at")


@check(
    "agg4_compacted_rollup",
    """select epoch_ms(hour_at) as "hour", alert_type, severity, station, alert_count from rollup""",
)
def _(t):
    root = t.folder("compacted-rollup")
    for kind in ("stuck-", "misrouting-", "damage-"):
        warehouse.append_alerts(t.alerts.drop("inserted_at").where(F.col("alert_id").startswith(kind)), root, t.as_of)
        warehouse.compact_alert_day(t.spark, root, date(2026, 8, 12))
    return A.merge_rollup(warehouse.read_rollup(t.spark, root), "hour", "alert_type", "severity", "station")


@check(
    "snk9_csv_export",
    """select '"Parcel ID","Issue","Station","Detected At"' as line
    union all (select concat('"', package_id, '","',
      case alert_type when 'ALERT_TYPE_STUCK_PACKAGE' then 'Stuck' when 'ALERT_TYPE_DAMAGE' then 'Damage' else 'Misrouted' end,
      '","', case station when 'STATION_TYPE_INTAKE' then 'Intake' when 'STATION_TYPE_INDUCTION' then 'Induction'
        when 'STATION_TYPE_SORT_A' then 'Sort A' when 'STATION_TYPE_SORT_B' then 'Sort B'
        when 'STATION_TYPE_QC_CHECK' then 'QC Check' when 'STATION_TYPE_STAGING' then 'Staging' else 'Dispatch' end,
      '","', strftime(detected_at, '%Y-%m-%dT%H:%M:%S.000Z'), '"')
    from alerts where detected_at between (select t from as_of) - interval '7' day and (select t from as_of)
    order by detected_ms desc, alert_id limit 20)""",
)
def _(t):
    span = resolve_range("week", as_of=t.as_of)
    flagged = A.recent_flagged(t.alerts, span.floor, span.ceiling)
    path = t.folder("csv")
    warehouse.export_csv(A.flagged_rows(flagged).coalesce(1), path)
    return t.spark.read.text(path).withColumnRenamed("value", "line")


# --- daily reports -----------------------------------------------------------------------------

THROUGHPUT_COLUMNS = """cast(report_date as varchar) report_date, station, scan_count, unique_packages,
  damage_count, unreadable_count"""


@check("agg1_daily_station_throughput", f"select {THROUGHPUT_COLUMNS} from throughput")
def _(t):
    return reports.daily_station_throughput(t.scans)


@check(
    "agg1_station_throughput_of_one_day",
    f"select {THROUGHPUT_COLUMNS} from throughput where report_date = date '{DAY}'",
)
def _(t):
    return reports.daily_station_throughput(lake.read_lake_day(t.spark, t.lake_root, DAY), DAY)


@check(
    "agg2_daily_damage_rate_by_category",
    "select cast(report_date as varchar) report_date, item_category, scan_count, damage_count, damage_rate from by_category",
)
def _(t):
    return reports.daily_damage_rate_by_category(t.scans, t.items)


RECON_SQL = """
select cast(coalesce(s.d, a.d) as varchar) report_date, coalesce(s.n, 0) lake_event_count,
  coalesce(a.n, 0) streaming_alert_count,
  cast(coalesce(s.n, 0) > 0 and coalesce(a.n, 0) = 0 as int) lake_has_traffic_but_no_alerts
from (select cast(scanned_at as date) d, count(*) n from scans group by 1) s
full outer join (select cast(detected_at as date) d, count(*) n from alerts {where} group by 1) a on s.d = a.d"""


@check("agg3_daily_reconciliation", RECON_SQL.format(where=""))
def _(t):
    return reports.daily_reconciliation(t.scans, t.alerts)


@check(
    "jn4_reconciliation_with_silent_days",
    RECON_SQL.format(where="where extract(day from detected_at) not in (7, 8)"),
)
def _(t):
    return reports.daily_reconciliation(t.scans, t.alerts.where(~F.dayofmonth("detected_at").isin(7, 8)))


@check(
    "agg3_reconciliation_of_an_empty_day",
    "select '2026-12-24' report_date, 0 lake_event_count, 0 streaming_alert_count, 0 lake_has_traffic_but_no_alerts",
)
def _(t):
    return reports.daily_reconciliation(t.scans, t.alerts, "2026-12-24")


@check(
    "api8_backfill_rerun",
    f"""select {THROUGHPUT_COLUMNS}, (select ms from as_of) inserted_at from throughput
      where report_date between date '2026-08-03' and date '2026-08-20'""",
)
def _(t):
    root = t.folder("backfill")
    warehouse.append_alerts(t.alerts.drop("inserted_at"), root, inserted_at=t.as_of)
    before = t.as_of - timedelta(days=1)
    api.run_daily_reports(t.spark, t.lake_root, root, t.items, "2026-08-03", "2026-08-20", before)
    api.run_daily_reports(t.spark, t.lake_root, root, t.items, "2026-08-03", "2026-08-20", t.as_of)
    return warehouse.read_report(t.spark, warehouse.report_path(root, "daily_station_throughput"))


@check(
    "snk5_rerun_replaces_its_day",
    f"""select {THROUGHPUT_COLUMNS}, case when report_date = date '{DAY}' then (select ms from as_of) + 86400000
      else (select ms from as_of) end inserted_at from throughput""",
)
def _(t):
    path = t.folder("throughput")
    report = reports.daily_station_throughput(t.scans)
    warehouse.overwrite_report(report, path, t.as_of)
    warehouse.overwrite_report(report.where(f"report_date = '{DAY}'"), path, t.as_of + timedelta(days=1))
    warehouse.overwrite_report(report.where("false"), path, t.as_of + timedelta(days=2))
    return warehouse.read_report(t.spark, path)


@check(
    "snk6_latest_report_versions",
    f"select {THROUGHPUT_COLUMNS} from throughput",
)
def _(t):
    # The first version was computed before the last three days had arrived completely.
    early = t.as_of - timedelta(days=3)
    first = reports.daily_station_throughput(t.scans.where(F.col("scanned_at") < S.ts(early)))
    second = reports.daily_station_throughput(t.scans)
    history = first.withColumn("inserted_at", S.ts(early)).unionByName(second.withColumn("inserted_at", S.ts(t.as_of)))
    return warehouse.read_latest(history, ["report_date", "station"]).drop("inserted_at")


# --- statistics over a range -------------------------------------------------------------------

WEEK_DAYS = "report_date >= cast((select t from as_of) as date) - 7"
WEEK_HOURS = "hour_at between (select t from as_of) - interval '7' day and (select t from as_of)"
RATE = "cast(sum(damage_count) as double) / cast(sum(scan_count) as double)"

FACILITY = {
    "throughput_total": (
        "agg6_throughput_total",
        f"select cast(sum(scan_count) as bigint) throughput_total from throughput where {WEEK_DAYS}",
    ),
    "throughput_series": (
        "agg6_throughput_series",
        f"""select cast(report_date as varchar) report_date, cast(sum(scan_count) as bigint) scan_count
        from throughput where {WEEK_DAYS} group by 1""",
    ),
    "damage_rate": ("agg7_facility_damage_rate", f"select {RATE} damage_rate from throughput where {WEEK_DAYS}"),
    "damage_by_station": (
        "agg7_damage_rate_by_station",
        f"select station, {RATE} damage_rate from throughput where {WEEK_DAYS} group by 1",
    ),
    "damage_by_category": (
        "agg8_damage_rate_by_category",
        f"select item_category, {RATE} damage_rate from by_category where {WEEK_DAYS} group by 1",
    ),
    "alert_breakdown": (
        "agg9_alert_breakdown",
        f"select alert_type, cast(sum(alert_count) as bigint) alert_count from rollup where {WEEK_HOURS} group by 1",
    ),
    "busiest_hours": (
        "agg10_busiest_hours",
        f"""select cast(hour(hour_at) as int) hour_of_day, cast(sum(alert_count) as bigint) alert_count
        from rollup where {WEEK_HOURS} group by 1""",
    ),
    "alert_trend": (
        "agg11_alert_trend",
        f"""select epoch_ms(hour_at) as "hour", alert_type, cast(sum(alert_count) as bigint) alert_count
        from rollup where {WEEK_HOURS} group by 1, 2""",
    ),
    "recent_flagged": (
        "ord5_recent_flagged",
        """select package_id, alert_type, station, detected_ms detected_at, alert_id from alerts
        where detected_at between (select t from as_of) - interval '7' day and (select t from as_of)
        order by detected_ms desc, alert_id limit 20""",
    ),
}


def _facility(t, frame: str):
    span = resolve_range("week", as_of=t.as_of)
    return api.facility_stats_from(t.spark, t.warehouse_root, t.reports_root, span)[frame]


for _frame, (_name, _sql) in FACILITY.items():
    check(_name, _sql)(lambda t, frame=_frame: _facility(t, frame))


CUSTOM_HOURS = "hour_at between timestamp '2026-08-06 00:00:00' and timestamp '2026-08-12 23:59:59'"


def _custom(t, frame: str):
    span = resolve_range(start="2026-08-06", end="2026-08-12")
    return api.facility_stats_from(t.spark, t.warehouse_root, t.reports_root, span)[frame]


@check(
    "api2_custom_range_breakdown",
    f"select alert_type, cast(sum(alert_count) as bigint) alert_count from rollup where {CUSTOM_HOURS} group by 1",
)
def _(t):
    return _custom(t, "alert_breakdown")


@check(
    "api2_custom_range_has_floor_only_on_reports",
    """select cast(report_date as varchar) report_date, cast(sum(scan_count) as bigint) scan_count from throughput
    where report_date >= date '2026-08-06' group by 1""",
)
def _(t):
    return _custom(t, "throughput_series")


STATION = "STATION_TYPE_SORT_B"


def _station(t, frame: str):
    span = resolve_range("month", as_of=t.as_of)
    return api.station_stats_from(t.spark, t.warehouse_root, t.reports_root, STATION, span)[frame]


@check(
    "agg12_station_throughput_series",
    f"""select cast(report_date as varchar) report_date, cast(sum(scan_count) as bigint) scan_count from throughput
    where station = '{STATION}' and report_date >= cast((select t from as_of) as date) - 30 group by 1""",
)
def _(t):
    return _station(t, "throughput_series")


@check(
    "agg12_station_damage_rate",
    f"""select {RATE} damage_rate from throughput
    where station = '{STATION}' and report_date >= cast((select t from as_of) as date) - 30""",
)
def _(t):
    return _station(t, "damage_rate")


@check(
    "api3_station_alert_breakdown",
    f"""select alert_type, cast(sum(alert_count) as bigint) alert_count from rollup where station = '{STATION}'
      and hour_at between (select t from as_of) - interval '30' day and (select t from as_of) group by 1""",
)
def _(t):
    return _station(t, "alert_breakdown")


@check(
    "flt7_station_equality",
    f"""select alert_id, detected_ms detected_at from alerts where station = '{STATION}'""",
)
def _(t):
    return t.alerts.where(F.col("station") == STATION).select("alert_id", "detected_at")


@check(
    "flt7_statistics_of_each_station",
    f"""select station, cast(report_date as varchar) report_date, cast(sum(scan_count) as bigint) scan_count from throughput
    where list_contains({ROUTE_LIST}, station) and report_date >= cast((select t from as_of) as date) - 30 group by 1, 2""",
)
def _(t):
    span = resolve_range("month", as_of=t.as_of)
    series = [
        api.station_stats(t.throughput, t.rollup, s, span)["throughput_series"].withColumn("station", F.lit(s)) for s in domain.ROUTE
    ]
    return reduce(DataFrame.unionByName, series)


@check(
    "scl2_lake_keys_and_range_bounds",
    """select event_id, cast(cast(scanned_at as date) as varchar) as "date", strftime(scanned_at, '%H') as "hour",
      cast(scanned_at as date) >= cast((select t from as_of) as date) - 7 of_report,
      scanned_at between (select t from as_of) - interval '7' day and (select t from as_of) of_range
    from scans""",
)
def _(t):
    span, at = resolve_range("week", as_of=t.as_of), F.col("scanned_at")
    return lake.lake_rows(t.scans).select(
        "event_id",
        "date",
        "hour",
        (F.col("date") >= F.lit(span.report_floor)).alias("of_report"),
        at.between(S.ts(span.floor), S.ts(span.ceiling)).alias("of_range"),
    )


@check(
    "flt4_date_ranges",
    """select preset, (select count(*) from throughput
        where report_date >= cast((select t from as_of) as date) - days) report_rows,
      (select count(*) from alerts where detected_at between
        (select t from as_of) - to_days(days) and (select t from as_of)) alert_rows
    from (values ('today', 1), ('week', 7), ('month', 30), ('other', 1)) v(preset, days)
    union all
    select 'custom', (select count(*) from throughput where report_date >= date '2026-08-06'),
      (select count(*) from alerts where detected_at between timestamp '2026-08-06 00:00:00'
        and timestamp '2026-08-12 23:59:59')""",
)
def _(t):
    spans = {p: resolve_range(p, as_of=t.as_of) for p in ("today", "week", "month", "other")}
    spans["custom"] = resolve_range(start="2026-08-06", end="2026-08-12")
    # One pass per table: a conditional count per range.
    days = t.throughput.agg(
        *[F.count_if(F.col("report_date") >= F.lit(s.report_floor)).alias(n) for n, s in spans.items()]
    )
    times = t.alerts.agg(
        *[F.count_if(F.col("detected_at").between(S.ts(s.floor), S.ts(s.ceiling))).alias(n) for n, s in spans.items()]
    )
    long = [df.unpivot([], list(spans), "preset", name) for df, name in ((days, "report_rows"), (times, "alert_rows"))]
    return long[0].join(long[1], "preset")


# --- one package -------------------------------------------------------------------------------


def _journey(t):
    return api.package_journey(t.scans, t.alerts, _busiest(t))


@check(
    "api1_journey_scans",
    f"""select event_id, station, scanner_id, epoch_ms(scanned_at) scanned_at, result, damage_type, damage_confidence
    from scans where package_id = {BUSIEST}""",
)
def _(t):
    return _journey(t).scans


@check(
    "api1_journey_alerts",
    f"""select alert_id, severity, station, detected_ms detected_at,
      case when alert_type = 'ALERT_TYPE_MISROUTING' then path_so_far end path_so_far,
      case when alert_type = 'ALERT_TYPE_STUCK_PACKAGE' then stuck_duration_seconds end stuck_duration_seconds
    from alerts where package_id = {BUSIEST}""",
)
def _(t):
    return _journey(t).alerts.select(
        "alert_id",
        "severity",
        "station",
        "detected_at",
        "misrouting_detail.path_so_far",
        "stuck_detail.stuck_duration_seconds",
    )


@check(
    "api1_journey_timeline",
    f"""select 'scan' kind, epoch_ms(scanned_at) at_ms, event_id id from scans where package_id = {BUSIEST}
    union all select 'alert', detected_ms, alert_id from alerts where package_id = {BUSIEST}""",
)
def _(t):
    return _journey(t).timeline.select("kind", F.col("at").alias("at_ms"), "id")


@check(
    "api7_route",
    """select event_id in_response_to_event_id, (select ms from as_of) issued_at from scans""",
)
def _(t):
    return api.route(t.scans, t.as_of).select("in_response_to_event_id", "issued_at")
