"""The alert table: flattening, rollups, breakdowns, lookups over alerts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions import messages
from parcelflow.functions import scalars as S
from parcelflow.operators.ingest import wire_payload

_P = domain.DEFAULTS


def union_alerts(*detectors: DataFrame) -> DataFrame:
    """One alert stream out of several detectors."""
    merged = detectors[0]
    for more in detectors[1:]:
        merged = merged.unionByName(more)
    return merged


def resolved_station() -> Column:
    """Misrouting alerts concern a journey; their station is where the package really was."""
    actual = F.coalesce(F.col("misrouting_detail.actual_station"), F.lit("STATION_TYPE_UNSPECIFIED"))
    return F.when(F.col("alert_type") == "ALERT_TYPE_MISROUTING", actual).otherwise(
        F.coalesce(F.nullif(F.col("station"), F.lit("")), F.lit("STATION_TYPE_UNSPECIFIED"))
    )


def flatten_alerts(alerts: DataFrame) -> DataFrame:
    """Nested alerts as table rows; columns of the other detail branches keep their defaults."""
    return alerts.select(
        "alert_id",
        "package_id",
        "alert_type",
        "severity",
        resolved_station().alias("station"),
        "message",
        "detected_at",
        F.coalesce("stuck_detail.stuck_duration_seconds", F.lit(0)).alias("stuck_duration_seconds"),
        F.coalesce("stuck_detail.threshold_seconds", F.lit(0)).alias("threshold_seconds"),
        F.coalesce("misrouting_detail.expected_station", F.lit("")).alias("expected_station"),
        F.coalesce("misrouting_detail.actual_station", F.lit("")).alias("actual_station"),
        F.coalesce("misrouting_detail.path_so_far", F.array().cast("array<string>")).alias("path_so_far"),
        F.coalesce("damage_detail.damage_type", F.lit("")).alias("damage_type"),
        F.coalesce("damage_detail.confidence", F.lit(0.0).cast("float")).alias("damage_confidence"),
    )


def nest_alert_detail(flat: DataFrame) -> DataFrame:
    """Table rows back to nested alerts: only the branch of the alert's own type is filled."""
    kind = F.col("alert_type")
    return flat.select(
        "alert_id",
        "package_id",
        "alert_type",
        "severity",
        "message",
        "station",
        "detected_at",
        F.when(
            kind == "ALERT_TYPE_STUCK_PACKAGE",
            F.struct(
                F.lit(None).cast("timestamp").alias("last_scan_at"),
                "stuck_duration_seconds",
                "threshold_seconds",
            ),
        ).alias("stuck_detail"),
        F.when(
            kind == "ALERT_TYPE_DAMAGE",
            F.struct(
                "damage_type",
                F.col("damage_confidence").cast("float").alias("confidence"),
                F.lit("").alias("image_ref"),
            ),
        ).alias("damage_detail"),
        F.when(
            kind == "ALERT_TYPE_MISROUTING",
            F.struct("expected_station", "actual_station", "path_so_far"),
        ).alias("misrouting_detail"),
        F.create_map().cast("map<string,string>").alias("attributes"),
    )


def with_whole_paths(alerts: DataFrame, paths: DataFrame) -> DataFrame:
    """Nested alerts with the whole path of the journey in ``path_so_far``, as consumers of the wire expect.

    ``paths`` are the rows of ``journeys.misrouted_paths``. The array of one alert is as long as its
    journey; tables keep the rows instead.
    """
    stations = F.sort_array(F.collect_list(F.struct("position", "station"))).getField("station")
    whole = paths.groupBy("alert_id", "detected_at").agg(stations.alias("_whole"))
    detail = F.when(
        F.col("misrouting_detail").isNotNull(),
        F.col("misrouting_detail").withField(
            "path_so_far", F.coalesce("_whole", F.col("misrouting_detail.path_so_far"))
        ),
    )
    return (
        alerts.join(whole, ["alert_id", "detected_at"], "left")
        .withColumn("misrouting_detail", detail)
        .select(*alerts.columns)
    )


def encode_alerts(alerts: DataFrame, fmt: str = "json") -> DataFrame:
    """Nested alerts as keyed wire records: base64 of JSON, or of the tracked system's ``binary`` messages."""
    if fmt == "binary":
        return messages.to_wire(alerts, messages.ALERT, "package_id")
    body = F.struct(*[F.col(f.name) for f in domain.ALERT.fields])
    return alerts.select(
        F.col("package_id").alias("key"), F.base64(F.to_json(body).cast("binary")).alias("value")
    )


def decode_alerts(wire: DataFrame, fmt: str = "json", **protobuf) -> tuple[DataFrame, DataFrame]:
    """``(alerts, quarantine)`` of keyed wire records; formats as in ``ingest.wire_payload``."""
    if fmt == "binary":
        read = messages.with_message(wire, messages.ALERT, domain.ALERT, "_message")
        usable = F.col("_message").isNotNull() & F.col("_message.detected_at").isNotNull()
        return read.where(usable).select("_message.*"), read.where(~usable).select(*wire.columns)
    parsed = wire_payload(domain.ALERT, fmt, **protobuf)
    # Filtered inside an array so that each record is parsed once, see ingest.wire_events.
    alerts = F.filter(F.array(parsed), lambda a: a["detected_at"].isNotNull())
    return wire.select(F.inline(alerts)), wire.where(F.size(alerts) == 0)


def missing_alerts(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Alerts of ``found`` whose id is not in ``stored``.

    Repairs what a stream has judged without its late scans: run a batch detector over the touched days
    of the lake, which keeps every scan, and append what is missing. Ids come from the content, so
    repeating it adds nothing.
    """
    return found.join(stored.select("alert_id").distinct(), "alert_id", "left_anti").select(*found.columns)


def hourly_rollup(alerts: DataFrame) -> DataFrame:
    """Partial counts per (hour, type, severity, station). Partials of the same key add up."""
    return alerts.groupBy(
        S.start_of_hour("detected_at").alias("hour"), "alert_type", "severity", "station"
    ).agg(F.count(F.lit(1)).alias("alert_count"))


def merge_rollup(partials: DataFrame, *keys: str) -> DataFrame:
    return partials.groupBy(*keys).agg(F.sum("alert_count").cast("long").alias("alert_count"))


def rollup_between(rollup: DataFrame, floor: datetime, ceiling: datetime) -> DataFrame:
    """Hour buckets in a closed range (bounds are compared with the truncated hour)."""
    return rollup.where(F.col("hour").between(S.ts(floor), S.ts(ceiling)))


def recent_rollup(rollup: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Hours from ``hours`` before ``as_of`` up to the one that holds it."""
    return merge_rollup(rollup_between(rollup, as_of - timedelta(hours=hours), as_of), "hour", "alert_type")


def busiest_hours(rollup: DataFrame) -> DataFrame:
    """Alerts per hour of day."""
    return merge_rollup(rollup, "hour").groupBy(F.hour("hour").alias("hour_of_day")).agg(
        F.sum("alert_count").alias("alert_count")
    )


def hours_of_day(busiest: DataFrame) -> DataFrame:
    """All 24 hours, zero where there were no alerts."""
    spine = busiest.sparkSession.range(24).select(F.col("id").cast("int").alias("hour_of_day"))
    return spine.join(busiest, "hour_of_day", "left").select(
        "hour_of_day", F.coalesce("alert_count", F.lit(0).cast("long")).alias("alert_count")
    )


def trend_buckets(trend: DataFrame) -> DataFrame:
    return trend.select("hour").distinct()


def trend_grid(trend: DataFrame) -> DataFrame:
    """(hour, alert type) counts with zeros for types that had no alert in an hour.

    Only types that occur somewhere in the trend get a line. The type domain is fixed and tiny, so
    each hour becomes one row that is expanded over it; no cross product of the data is built.
    """
    counts = [
        F.struct(
            F.lit(name).alias("alert_type"),
            F.coalesce(F.sum(F.when(F.col("alert_type") == name, F.col("alert_count"))), F.lit(0))
            .cast("long")
            .alias("alert_count"),
        )
        for name in domain.ALERT_TYPES
    ]
    grid = (
        trend.groupBy("hour")
        .agg(F.array(*counts).alias("cells"))
        .select("hour", F.inline("cells"))
    )
    return grid.join(trend.select("alert_type").distinct(), "alert_type", "left_semi")


def recent_flagged(alerts: DataFrame, floor: datetime, ceiling: datetime, n: int = _P.recent_flagged) -> DataFrame:
    """The newest alerts of a range."""
    return (
        alerts.where(F.col("detected_at").between(S.ts(floor), S.ts(ceiling)))
        .select("package_id", "alert_type", "station", "detected_at", "alert_id")
        .orderBy(F.desc("detected_at"), "alert_id")
        .limit(n)
    )


def within(column: str, as_of: datetime, back_ms: int) -> Column:
    """True for times from ``back_ms`` before ``as_of`` up to ``as_of``, both included."""
    return F.col(column).between(S.ts(S.to_millis(as_of) - back_ms), S.ts(as_of))


def latest_flags(
    alerts: DataFrame,
    as_of: datetime,
    types: tuple[str, ...] = domain.FLAG_ALERT_TYPES,
    lookback_ms: int = _P.flag_lookback_ms,
) -> DataFrame:
    """Latest alert time per (package, type) of the flag types in the lookback up to ``as_of``."""
    return (
        alerts.where(F.col("alert_type").isin(*types) & within("detected_at", as_of, lookback_ms))
        .groupBy("package_id", "alert_type")
        .agg(F.max("detected_at").alias("detected_at"))
    )


def latest_versions(table: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key by ``order``; a combinable aggregate, so hot keys reduce map-side.

    Rows that are equal in ``order`` are told apart by their other columns (maps by their text), so the
    choice can be repeated.
    """
    rest = [c for c in table.columns if c not in keys and c not in order]
    maps = {f.name for f in table.schema.fields if "map<" in f.dataType.simpleString()}
    last = [F.to_json(F.col(c)).alias(c) if c in maps else F.col(c) for c in rest]
    newest = F.max_by(F.struct(*order, *rest), F.struct(*order, *last)).alias("r")
    return table.groupBy(*keys).agg(newest).select(*keys, "r.*").select(*table.columns)


def latest_alerts(alerts: DataFrame) -> DataFrame:
    """One row per ``alert_id``: re-emitted alerts under a stable id count once."""
    order = [c for c in ("inserted_at", "detected_at") if c in alerts.columns]
    return latest_versions(alerts, ["alert_id"], order)


def worst_alerts(alerts: DataFrame) -> DataFrame:
    """Per package the alert of highest severity; the newest one on a tie."""
    # min_by over (-rank, -time, id) keeps the smallest id as the last tie-break.
    rank = F.struct(
        (-S.severity_rank(F.col("severity"))).alias("r"),
        (-S.millis("detected_at")).alias("t"),
        F.col("alert_id").alias("i"),
    )
    kept = F.struct("alert_id", "alert_type", "severity", "detected_at")
    return alerts.groupBy("package_id").agg(F.min_by(kept, rank).alias("a")).select("package_id", "a.*")


def journey_badges(alerts: DataFrame) -> DataFrame:
    """``Flagged`` for a package with a critical alert, ``Warning`` for one with a warning."""
    worst = F.max(S.severity_rank(F.col("severity")))
    return (
        alerts.groupBy("package_id")
        .agg(worst.alias("worst"))
        .where(F.col("worst") >= 2)
        .select("package_id", F.when(F.col("worst") == 3, "Flagged").otherwise("Warning").alias("badge"))
    )


def station_alert_state(
    alerts: DataFrame, as_of: datetime, window_ms: int = _P.station_alert_window_ms
) -> DataFrame:
    """``critical``, ``warning`` or ``normal`` per station, from the alerts of the window up to ``as_of``."""
    recent = (
        alerts.where(within("detected_at", as_of, window_ms))
        .groupBy("station")
        .agg(F.max(S.severity_rank(F.col("severity"))).alias("worst"))
    )
    worst = F.coalesce("worst", F.lit(0))
    return (
        station_spine(alerts)
        .join(recent, "station", "left")
        .select(
            "station",
            F.when(worst == 3, "critical").when(worst == 2, "warning").otherwise("normal").alias("state"),
        )
    )


def station_spine(df: DataFrame) -> DataFrame:
    """The seven stations of the route, in order."""
    spine = df.sparkSession.range(1).select(F.posexplode(S.route_array()).alias("step", "station"))
    return spine.select("station")


def newest_alerts(alerts: DataFrame, n: int = _P.live_alert_cap) -> DataFrame:
    return alerts.orderBy(F.desc("detected_at"), "alert_id").limit(n)


def newest_alerts_per_station(alerts: DataFrame, n: int = _P.station_alerts_shown) -> DataFrame:
    newest = W.partitionBy("station").orderBy(F.desc("detected_at"), "alert_id")
    return alerts.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= n)


def flagged_rows(
    flagged: DataFrame, text: str = "", sort_key: str = "time", descending: bool = True
) -> DataFrame:
    """The flagged list as shown: text filter over id and labels, then one sort key."""
    issue = S.alert_label(F.col("alert_type"), "")
    station = S.station_label(F.col("station"), "")
    shown = flagged.withColumn("issue_label", issue).withColumn("station_label", station)
    shown = shown.where(
        S.contains_text(text, F.col("package_id"), F.col("issue_label"), F.col("station_label"))
    )
    keys = {"time": "detected_at", "station": "station_label", "issue": "issue_label"}
    if sort_key not in keys:
        raise ValueError(f"sort_key must be one of {sorted(keys)}")
    key = F.col(keys[sort_key])
    return shown.orderBy(key.desc() if descending else key.asc(), "package_id", "alert_type")


def retain(alerts: DataFrame, as_of: datetime, days: int = _P.alert_retention_days) -> DataFrame:
    """Alerts young enough to be kept."""
    return alerts.where(F.col("detected_at") >= S.ts(as_of - timedelta(days=days)))
