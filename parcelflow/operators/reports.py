"""Daily batch reports and the range statistics read from them."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import scalars as S


def _damaged() -> Column:
    return F.col("result") == "SCAN_RESULT_DAMAGE_DETECTED"


Day = str | Date | None


def _on(df: DataFrame, column: str, day: Day, last: Day) -> DataFrame:
    """Rows of the UTC days ``day`` to ``last`` as a plain range, which prunes better than a cast."""
    dated = df.withColumn("report_date", F.to_date(column))
    if day is None:
        return dated
    start, end = (F.lit(str(d)).cast("date") for d in (day, last or day))
    return dated.where(
        (F.col(column) >= start.cast("timestamp")) & (F.col(column) < F.date_add(end, 1).cast("timestamp"))
    )


def daily_station_throughput(scans: DataFrame, day: Day = None, last: Day = None) -> DataFrame:
    """Per day and station: scans, distinct packages, damage and unreadable scans."""
    # One row per (day, station, package) first: the exact distinct count becomes a plain count and
    # a hot package or station is reduced before and across the shuffle.
    unreadable = F.col("result") == "SCAN_RESULT_UNREADABLE"
    per_package = (
        _on(scans, "scanned_at", day, last)
        .groupBy("report_date", "station", "package_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(_damaged()).alias("damaged"),
            F.count_if(unreadable).alias("unreadable"),
        )
    )
    return per_package.groupBy("report_date", "station").agg(
        F.sum("n").alias("scan_count"),
        F.count(F.lit(1)).alias("unique_packages"),
        F.sum("damaged").alias("damage_count"),
        F.sum("unreadable").alias("unreadable_count"),
    )


def daily_damage_rate_by_category(
    scans: DataFrame, items: DataFrame, day: Day = None, last: Day = None
) -> DataFrame:
    """Per day and item category: scans, damage and their ratio.

    Scans are counted per (day, item) before the catalog lookup, so the join sees one row per item
    and day, also for a very frequent or missing item id.
    """
    per_item = (
        _on(scans, "scanned_at", day, last)
        .groupBy("report_date", F.coalesce("item_id", F.lit("")).alias("item_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(_damaged()).alias("damaged"))
    )
    catalog = items.where(F.col("item_id") != "").select("item_id", "category")
    category = F.coalesce("category", F.lit("ITEM_CATEGORY_UNSPECIFIED"))
    return (
        per_item.join(catalog, "item_id", "left")
        .groupBy("report_date", category.alias("item_category"))
        .agg(F.sum("n").alias("scan_count"), F.sum("damaged").alias("damage_count"))
        .withColumn("damage_rate", S.safe_ratio(F.col("damage_count"), F.col("scan_count")))
    )


def daily_reconciliation(scans: DataFrame, alerts: DataFrame, day: Day = None, last: Day = None) -> DataFrame:
    """Raw scans against alerts per day; flags days with traffic and no alert at all.

    Every day from ``day`` to ``last`` gets a row, all zero if nothing happened.
    """
    both = _on(scans, "scanned_at", day, last).select("report_date", F.lit(1).alias("scan"), F.lit(0).alias("alert"))
    both = both.unionByName(
        _on(alerts, "detected_at", day, last).select("report_date", F.lit(0).alias("scan"), F.lit(1).alias("alert"))
    )
    if day is not None:
        start, end = (F.lit(str(d)).cast("date") for d in (day, last or day))
        nothing = scans.sparkSession.range(1).select(
            F.explode(F.sequence(start, end)).alias("report_date"), F.lit(0).alias("scan"), F.lit(0).alias("alert")
        )
        both = both.unionByName(nothing)
    quiet = (F.col("lake_event_count") > 0) & (F.col("streaming_alert_count") == 0)
    return (
        both.groupBy("report_date")
        .agg(F.sum("scan").alias("lake_event_count"), F.sum("alert").alias("streaming_alert_count"))
        .withColumn("lake_has_traffic_but_no_alerts", quiet.cast("int"))
    )


def from_date(report: DataFrame, floor: Date) -> DataFrame:
    """Report rows from a date on. Ranges on report tables have a floor only."""
    return report.where(F.col("report_date") >= F.lit(floor))


def throughput_series(throughput: DataFrame) -> DataFrame:
    return throughput.groupBy("report_date").agg(F.sum("scan_count").alias("scan_count"))


def throughput_total(throughput: DataFrame) -> DataFrame:
    return throughput.agg(F.coalesce(F.sum("scan_count"), F.lit(0)).cast("long").alias("throughput_total"))


def damage_rate(report: DataFrame, *keys: str) -> DataFrame:
    """Damage over scans from the summed counts, per key or for the whole facility."""
    grouped = report.groupBy(*keys).agg(F.sum("damage_count").alias("d"), F.sum("scan_count").alias("n"))
    return grouped.select(*keys, S.safe_ratio(F.col("d"), F.col("n")).alias("damage_rate"))


def worst_categories(by_category_rate: DataFrame) -> DataFrame:
    return by_category_rate.orderBy(F.desc("damage_rate"), "item_category")
