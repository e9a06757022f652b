"""Joins behind the case and journey views: alerts with positions, scans and other alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions import scalars as S
from parcelflow.operators.alerts import within

_P = domain.DEFAULTS


def with_active_flags(
    positions: DataFrame, alerts: DataFrame, as_of: datetime, lookback_ms: int = _P.flag_lookback_ms
) -> DataFrame:
    """Adds ``active_flags``: flag alerts of the lookback up to ``as_of`` that are not older than the
    package's last scan, in fixed order."""
    latest = [
        F.max(F.when(F.col("alert_type") == t, F.col("detected_at"))).alias(t) for t in domain.FLAG_ALERT_TYPES
    ]
    flags = (
        alerts.where(F.col("alert_type").isin(*domain.FLAG_ALERT_TYPES) & within("detected_at", as_of, lookback_ms))
        .groupBy("package_id")
        .agg(*latest)
    )
    active = F.array_compact(
        F.array(*[F.when(F.col(t) >= F.col("updated_at"), F.lit(t)) for t in domain.FLAG_ALERT_TYPES])
    )
    return (
        positions.join(flags, "package_id", "left")
        .withColumn("active_flags", active)
        .drop(*domain.FLAG_ALERT_TYPES)
    )


def displayed_alerts(live: DataFrame, seeded: DataFrame) -> DataFrame:
    """Live alerts plus seeded ones of packages without a live alert, newest first."""
    extra = seeded.join(live.select("package_id"), "package_id", "left_anti")
    return live.unionByName(extra.select(*live.columns)).orderBy(F.desc("detected_at"), "alert_id")


def seed_alerts(flagged: DataFrame) -> DataFrame:
    """Historical flagged rows as placeholder alerts."""
    return flagged.select(
        F.concat(
            F.lit(domain.SEED_ID), "package_id", F.lit("-"), S.millis("detected_at").cast("string")
        ).alias("alert_id"),
        "package_id",
        "alert_type",
        F.lit("SEVERITY_WARNING").alias("severity"),
        "station",
        F.concat(
            S.alert_label(F.col("alert_type"), "Alert"),
            F.lit(" at "),
            S.station_label(F.col("station"), "unknown station"),
        ).alias("message"),
        "detected_at",
    )


def match_detail(initial: DataFrame, detailed: DataFrame, within_ms: int = _P.detail_match_ms) -> DataFrame:
    """For each placeholder alert the newest detailed alert of the same package and type less than
    ``within_ms`` away, if any. Both sides meet on (package, type, time slot).

    Placeholder ids do not carry the type, so a match belongs to (``initial_id``, ``alert_type``)."""
    left = initial.select(
        F.col("alert_id").alias("initial_id"), "package_id", "alert_type", S.millis("detected_at").alias("t0")
    )
    slot = S.slot_start(F.col("t0"), within_ms)
    near = F.array(slot - within_ms, slot, slot + within_ms)
    right = detailed.select(
        "package_id", "alert_type", F.col("alert_id").alias("detail_id"), S.millis("detected_at").alias("t1")
    ).withColumn("slot", S.slot_start(F.col("t1"), within_ms))
    # Newest first, and the smaller id on a tie.
    first = F.min_by(F.struct("detail_id", "t1"), F.struct((-F.col("t1")).alias("t"), F.col("detail_id").alias("i")))
    return (
        left.withColumn("slot", F.explode(near))
        .join(right, ["package_id", "alert_type", "slot"])
        .where(F.abs(F.col("t1") - F.col("t0")) < within_ms)
        .groupBy("initial_id", "alert_type")
        .agg(first.alias("m"))
        .select("initial_id", "alert_type", "m.detail_id", F.timestamp_millis("m.t1").alias("detail_at"))
    )


def _near_slots(alert_ms: Column, half_width_ms: int) -> Column:
    """The slots of twice the half width that hold everything strictly less than it from a time: one or two."""
    ends = (alert_ms - F.lit(half_width_ms - 1), alert_ms + F.lit(half_width_ms - 1))
    return F.array_distinct(F.array(*[S.slot_start(end, 2 * half_width_ms) for end in ends]))


def nearby_scans(
    alerts: DataFrame, scans: DataFrame, half_width_ms: int = _P.case_half_width_ms, also: tuple[str, ...] = ()
) -> DataFrame:
    """Scans of the same package strictly less than ``half_width_ms`` from each alert; ``also`` names more columns of either side.

    Both sides carry a time slot of twice that width and meet on (package, slot): a package with very many
    scans is spread over its slots instead of joining in one task. Neither side is bounded, and the size
    of a few columns of compressed files is guessed far too low, so it is a merge join: a broadcast would
    gather two rows an alert on the driver.
    """
    more = lambda df: [c for c in also if c in df.columns]
    left = alerts.select("alert_id", "package_id", S.millis("detected_at").alias("alert_ms"), *more(alerts))
    right = scans.select("package_id", "event_id", "station", "scanned_at", *more(scans)).withColumn(
        "slot", S.slot_start(S.millis("scanned_at"), 2 * half_width_ms)
    )
    return (
        left.withColumn("slot", F.explode(_near_slots(F.col("alert_ms"), half_width_ms)))
        .join(right.hint("merge"), ["package_id", "slot"])
        .where(F.abs(S.millis("scanned_at") - F.col("alert_ms")) < half_width_ms)
        .select("alert_id", "package_id", "event_id", "station", "scanned_at", *also)
    )


def with_item_names(alerts: DataFrame, positions: DataFrame) -> DataFrame:
    """Alerts with the item on the package, or a short package title when it is unknown."""
    title = F.concat(F.lit("Package "), F.substring("package_id", 1, 8))
    names = positions.select("package_id", F.col("item_name").alias("_name"))
    return (
        alerts.join(names, "package_id", "left")
        .withColumn("item_name", F.coalesce(F.nullif(F.col("_name"), F.lit("")), title))
        .drop("_name")
    )


def timeline(scans: DataFrame, alerts: DataFrame) -> DataFrame:
    """Scans and alerts of packages as one list, tagged by ``kind``."""
    seen = scans.select(
        "package_id",
        F.lit("scan").alias("kind"),
        F.col("scanned_at").alias("at"),
        F.col("event_id").alias("id"),
        "station",
        F.col("result").alias("what"),
    )
    raised = alerts.select(
        "package_id",
        F.lit("alert").alias("kind"),
        F.col("detected_at").alias("at"),
        F.col("alert_id").alias("id"),
        "station",
        F.col("alert_type").alias("what"),
    )
    return seen.unionByName(raised)


def live_feed(positions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Position updates and alerts as one feed; exactly one branch is set per row."""
    update = F.struct(*[F.col(f.name) for f in domain.POSITION.fields])
    body = F.struct(*[F.col(f.name) for f in domain.ALERT.fields])
    updates = positions.select(
        "package_id", F.col("updated_at").alias("at"), update.alias("position_update"),
        F.lit(None).cast(domain.ALERT).alias("alert"),
    )
    raised = alerts.select(
        "package_id", F.col("detected_at").alias("at"),
        F.lit(None).cast(domain.POSITION).alias("position_update"), body.alias("alert"),
    )
    return updates.unionByName(raised)
