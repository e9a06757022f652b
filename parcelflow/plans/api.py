"""The questions users ask, each a lazy plan over the tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date as Date
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions import scalars as S
from parcelflow.operators import alerts as A
from parcelflow.operators import cases, floor, ingest, reports
from parcelflow.plans.ranges import DateRange
from parcelflow.sources import lake, warehouse

_P = domain.DEFAULTS
#: The column behind each sort field of the parcel grid.
SORT_COLUMNS = {"dwell_time": "dwell_ms", "detected_at": "last_scan_at", "package_id": "package_id"}


@dataclass(frozen=True)
class PackageJourney:
    scans: DataFrame
    alerts: DataFrame
    timeline: DataFrame


@dataclass(frozen=True)
class ParcelPage:
    """``page`` holds the rows, ``summary`` one row with ``total_count`` and ``has_more``."""

    page: DataFrame
    summary: DataFrame


def package_journey(scans: DataFrame, alerts: DataFrame, package_id: str) -> PackageJourney:
    """Scans oldest first, alerts newest first with their detail, and both as one timeline."""
    mine = F.col("package_id") == package_id
    seen = scans.where(mine)
    raised = alerts.where(mine)
    return PackageJourney(
        scans=seen.select(
            "event_id", "station", "scanner_id", "scanned_at", "result", "damage_type", "damage_confidence"
        ).orderBy("scanned_at", "event_id"),
        alerts=A.nest_alert_detail(raised).orderBy(F.desc("detected_at"), "alert_id"),
        timeline=cases.timeline(seen, raised).orderBy("at", F.desc("kind"), "id"),
    )


def facility_stats(
    throughput: DataFrame, by_category: DataFrame, rollup: DataFrame, alerts: DataFrame, span: DateRange
) -> dict[str, DataFrame]:
    """Nine frames, each its own plan over pre-aggregated tables."""
    daily = reports.from_date(throughput, span.report_floor)
    categories = reports.from_date(by_category, span.report_floor)
    hours = A.rollup_between(rollup, span.floor, span.ceiling)
    return {
        "throughput_total": reports.throughput_total(daily),
        "throughput_series": reports.throughput_series(daily).orderBy("report_date"),
        "damage_rate": reports.damage_rate(daily),
        "damage_by_station": reports.damage_rate(daily, "station"),
        "damage_by_category": reports.damage_rate(categories, "item_category"),
        "alert_breakdown": A.merge_rollup(hours, "alert_type"),
        "busiest_hours": A.busiest_hours(hours).orderBy("hour_of_day"),
        "alert_trend": A.merge_rollup(hours, "hour", "alert_type").orderBy("hour", "alert_type"),
        "recent_flagged": A.recent_flagged(alerts, span.floor, span.ceiling),
    }


def station_stats(throughput: DataFrame, rollup: DataFrame, station: str, span: DateRange) -> dict[str, DataFrame]:
    if station not in domain.ROUTE:
        raise ValueError("station is required")
    here = F.col("station") == station
    daily = reports.from_date(throughput, span.report_floor).where(here)
    hours = A.rollup_between(rollup, span.floor, span.ceiling).where(here)
    return {
        "throughput_series": reports.throughput_series(daily).orderBy("report_date"),
        "damage_rate": reports.damage_rate(daily),
        "alert_breakdown": A.merge_rollup(hours, "alert_type"),
    }


def facility_stats_from(spark: SparkSession, warehouse_root: str, reports_root: str, span: DateRange) -> dict[str, DataFrame]:
    """``facility_stats`` over the stored tables, each read pruned to the days of ``span``."""
    report = lambda name: warehouse.read_report(spark, warehouse.report_path(reports_root, name))
    return facility_stats(
        report("daily_station_throughput"),
        report("daily_damage_rate_by_category"),
        warehouse.read_rollup(spark, warehouse_root, span.floor, span.ceiling),
        warehouse.read_alerts(spark, warehouse_root, span.floor, span.ceiling),
        span,
    )


def station_stats_from(
    spark: SparkSession, warehouse_root: str, reports_root: str, station: str, span: DateRange
) -> dict[str, DataFrame]:
    """``station_stats`` over the stored tables, pruned in the same way."""
    throughput = warehouse.read_report(spark, warehouse.report_path(reports_root, "daily_station_throughput"))
    return station_stats(throughput, warehouse.read_rollup(spark, warehouse_root, span.floor, span.ceiling), station, span)


def list_parcels_from(spark: SparkSession, warehouse_root: str, positions: DataFrame, as_of: datetime, **options) -> ParcelPage:
    """``list_parcels`` that reads only the alerts of the lookback."""
    p = options.get("p", _P)
    alerts = warehouse.read_alerts(spark, warehouse_root, as_of - timedelta(milliseconds=p.flag_lookback_ms), as_of)
    return list_parcels(positions, alerts, as_of, **options)


def parcel_summaries(positions: DataFrame, alerts: DataFrame, as_of: datetime, p: domain.Params = _P) -> DataFrame:
    """Every parcel known at ``as_of`` with dwell, status and active flags."""
    dwell = S.dwell_ms("updated_at", as_of)
    return (
        cases.with_active_flags(floor.known_at(positions, as_of), alerts, as_of, p.flag_lookback_ms)
        .withColumn("dwell_ms", dwell)
        .select(
            "package_id",
            F.col("station").alias("current_station"),
            F.col("updated_at").alias("last_scan_at"),
            "dwell_ms",
            S.floor_seconds(F.col("dwell_ms")).alias("dwell_seconds"),
            S.parcel_status(F.col("dwell_ms"), p).alias("status"),
            "active_flags",
            "item_name",
            "item_category",
        )
    )


def list_parcels(
    positions: DataFrame,
    alerts: DataFrame,
    as_of: datetime,
    status_filter: tuple[str, ...] = (),
    limit: int = 0,
    offset: int = 0,
    sort_field: str = "",
    sort_desc: bool = False,
    search: str = "",
    after: tuple | None = None,
    p: domain.Params = _P,
) -> ParcelPage:
    """One page of the parcel grid.

    The text search looks at all parcels before paging. Ties in the sort are broken by package id.
    A page far down costs as much as its ``offset`` (``pages.read_page`` opens only the ranges of a page); ``after``, the sort value and package id of the
    last row of the page before, goes on from there at the cost of one page. ``has_more`` counts rows
    from ``offset`` on, and from ``after`` on if it is given.
    """
    field = sort_field or "dwell_time"
    if field not in domain.PARCEL_SORT_FIELDS:
        raise ValueError(f"sort_field must be one of {sorted(domain.PARCEL_SORT_FIELDS)}")
    size = min(limit, p.list_parcels_max) if limit else p.list_parcels_max
    rows = parcel_summaries(positions, alerts, as_of, p)
    if status_filter:
        rows = rows.where(F.col("status").isin(*status_filter))
    rows = rows.where(S.contains_text(search, F.col("package_id"), F.col("item_name")))
    column = SORT_COLUMNS[field]
    key = F.col(column).desc() if sort_desc else F.col(column).asc()
    total, seen = rows, F.lit(offset + size)
    if after is not None:
        value, package = (S.ts(after[0]) if column == "last_scan_at" else F.lit(after[0])), F.lit(after[1])
        beyond = F.col(column) < value if sort_desc else F.col(column) > value
        rest = beyond | ((F.col(column) == value) & (F.col("package_id") > package))
        rows = rows.where(rest)
        seen = F.lit(offset + size) + F.count_if(~rest)
    page = rows.orderBy(key, "package_id").offset(offset).limit(size).drop("dwell_ms")
    summary = total.agg(F.count(F.lit(1)).alias("total_count"), seen.alias("seen")).select(
        "total_count", (F.col("seen") < F.col("total_count")).alias("has_more")
    )
    return ParcelPage(page, summary)


def list_positions(scans: DataFrame, items: DataFrame) -> DataFrame:
    return floor.current_positions(scans, items)


def route(scans: DataFrame, issued_at: datetime) -> DataFrame:
    return ingest.route(scans, issued_at)


def daily_reports(
    scans: DataFrame,
    items: DataFrame,
    alerts: DataFrame,
    day: str | Date | None = None,
    last: str | Date | None = None,
) -> dict[str, DataFrame]:
    """The three daily reports: one day, a range of days, or (``day=None``) all days, each in one pass."""
    return {
        "daily_station_throughput": reports.daily_station_throughput(scans, day, last),
        "daily_damage_rate_by_category": reports.daily_damage_rate_by_category(scans, items, day, last),
        "daily_reconciliation": reports.daily_reconciliation(scans, alerts, day, last),
    }


def run_daily_reports(
    spark: SparkSession,
    lake_root: str,
    warehouse_root: str,
    items: DataFrame,
    first: str | Date,
    last: str | Date | None = None,
    inserted_at: datetime | None = None,
) -> None:
    """Computes and replaces the reports of one date, or of a whole backfill range at once.

    A range is one pruned scan grouped by date, not a loop over days. Running it again replaces
    the same dates.
    """
    final = last or first
    scans = lake.read_lake_range(spark, lake_root, first, final)
    end = S.utc(str(final)) + timedelta(days=1) - timedelta(microseconds=1)
    alerts = warehouse.read_alerts(spark, warehouse_root, S.utc(str(first)), end)
    for name, report in daily_reports(scans, items, alerts, first, final).items():
        warehouse.overwrite_report(report, warehouse.report_path(warehouse_root, name), inserted_at)
