"""Stuck packages and damage promotion."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions import scalars as S

_P = domain.DEFAULTS


def threshold_text(threshold_ms: int) -> str:
    seconds = threshold_ms // 1000
    return f"{seconds // 60}+ minutes" if seconds >= 60 else f"{seconds}+ seconds"


def stuck_alert_columns(package: Column, station: Column, last_ms: Column, threshold_ms: int) -> list[Column]:
    """The nested alert of a package whose last scan at ``last_ms`` had no follow-up in time."""
    fire_ms = last_ms + F.lit(threshold_ms)
    return [
        F.concat(F.lit(domain.STUCK_ID), package, F.lit("-"), fire_ms.cast("string")).alias("alert_id"),
        package.alias("package_id"),
        F.lit("ALERT_TYPE_STUCK_PACKAGE").alias("alert_type"),
        F.lit("SEVERITY_WARNING").alias("severity"),
        F.concat(
            F.lit(domain.STUCK_AT),
            station,
            F.lit(domain.STUCK_FOR.format(threshold=threshold_text(threshold_ms))),
        ).alias("message"),
        station.alias("station"),
        F.timestamp_millis(fire_ms).alias("detected_at"),
        F.struct(
            F.timestamp_millis(last_ms).alias("last_scan_at"),
            S.floor_seconds(fire_ms - last_ms).alias("stuck_duration_seconds"),
            F.lit(threshold_ms // 1000).alias("threshold_seconds"),
        ).alias("stuck_detail"),
        F.lit(None).cast(domain.DAMAGE_DETAIL).alias("damage_detail"),
        F.lit(None).cast(domain.MISROUTING_DETAIL).alias("misrouting_detail"),
        F.create_map().cast("map<string,string>").alias("attributes"),
    ]


def stuck_points(
    scans: DataFrame,
    threshold_ms: int = _P.stuck_threshold_ms,
    ooo_ms: int = _P.max_out_of_orderness_ms,
    exclude_terminal: bool = False,
    final_watermark: datetime | None = None,
) -> DataFrame:
    """``package_id, station, last_ms`` of every scan without a follow-up within the threshold.

    Two scans in one slot of ``threshold_ms`` lie closer than the threshold, so only the last scan
    of a slot can be a stuck point and only the first scan of the next filled slot can rescue it.
    The per-package ordering therefore runs over one small row per filled slot. A point counts once
    the watermark (latest scan minus the allowed disorder) has passed its threshold.
    """
    at = S.millis("scanned_at")
    if final_watermark is None:
        watermark = S.only_row(scans, F.max(at)) - F.lit(ooo_ms + 1)
    else:
        watermark = F.lit(S.to_millis(final_watermark))
    slots = (
        scans.select("package_id", "event_id", "station", at.alias("at_ms"))
        .groupBy("package_id", S.slot_start(F.col("at_ms"), threshold_ms).alias("slot"))
        .agg(
            F.min("at_ms").alias("first_ms"),
            F.max(F.struct("at_ms", "event_id", "station")).alias("last"),
        )
    )
    by_time = W.partitionBy("package_id").orderBy("slot")
    points = (
        slots.withColumn("next_ms", F.lead("first_ms").over(by_time))
        .select("package_id", F.col("last.station").alias("station"), F.col("last.at_ms").alias("last_ms"), "next_ms")
        .where(F.col("next_ms").isNull() | (F.col("next_ms") - F.col("last_ms") > threshold_ms))
        .where(F.col("last_ms") + threshold_ms <= watermark)
    )
    if exclude_terminal:
        points = points.where(F.col("station") != domain.DISPATCH)
    return points.drop("next_ms")


def stuck_alerts(
    scans: DataFrame,
    threshold_ms: int = _P.stuck_threshold_ms,
    ooo_ms: int = _P.max_out_of_orderness_ms,
    exclude_terminal: bool = False,
    final_watermark: datetime | None = None,
) -> DataFrame:
    points = stuck_points(scans, threshold_ms, ooo_ms, exclude_terminal, final_watermark)
    return points.select(
        *stuck_alert_columns(F.col("package_id"), F.col("station"), F.col("last_ms"), threshold_ms)
    )


def damage_alerts(scans: DataFrame, min_confidence: float = 0.75) -> DataFrame:
    """Promotes confident damage scans to alerts.

    The alert type is declared by the tracked system but nothing there emits it; the id scheme and
    the default confidence are choices of this package.
    """
    return scans.where(
        (F.col("result") == "SCAN_RESULT_DAMAGE_DETECTED") & (F.col("damage_confidence") >= min_confidence)
    ).select(
        F.concat(F.lit("damage-"), "event_id").alias("alert_id"),
        "package_id",
        F.lit("ALERT_TYPE_DAMAGE").alias("alert_type"),
        F.lit("SEVERITY_WARNING").alias("severity"),
        F.concat(F.lit("Damage detected at "), "station", F.lit(": "), "damage_type").alias("message"),
        "station",
        F.col("scanned_at").alias("detected_at"),
        F.lit(None).cast(domain.STUCK_DETAIL).alias("stuck_detail"),
        F.struct(
            "damage_type",
            F.col("damage_confidence").cast("float").alias("confidence"),
            F.lit("").alias("image_ref"),
        ).alias("damage_detail"),
        F.lit(None).cast(domain.MISROUTING_DETAIL).alias("misrouting_detail"),
        F.create_map().cast("map<string,string>").alias("attributes"),
    )
