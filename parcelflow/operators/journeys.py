"""Sessions per package, observed paths and misrouting verdicts.

Plan shape. Scans of one package that fall into the same slot of ``gap`` milliseconds always share
a session, because they lie less than the gap apart. So every slot is first reduced to one summary
row (a combinable aggregate), and only these summaries, whose number per package is bounded by
time and not by rows, are ordered per package. A package that holds a third of all scans therefore
never meets in one task: it is reduced map-side and spread over its slots. The first scans of a
slot come from a ``row_number() <= k`` filter, which Spark also applies before the shuffle.

A session row has its counts, its last scan and its path, whole up to ``PATH_STATIONS`` scans; a verdict
reads the first seven of them. Longer paths are rows (``session_scans``, ``misrouted_paths``), and an alert
that has only their head says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions import scalars as S

_GAP = domain.DEFAULTS.session_gap_ms
_HEAD = len(domain.ROUTE)
#: Scans up to which a session row and its alert hold the whole path.
PATH_STATIONS = 1_000


def _slotted(scans: DataFrame, gap_ms: int) -> DataFrame:
    at = S.millis("scanned_at")
    return scans.select(
        "package_id",
        S.slot_start(at, gap_ms).alias("slot"),
        at.alias("at_ms"),
        "event_id",
        "station",
    )


def _slot_summaries(scans: DataFrame, gap_ms: int) -> DataFrame:
    return (
        _slotted(scans, gap_ms)
        .groupBy("package_id", "slot")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("at_ms").alias("first_ms"),
            F.max(F.struct("at_ms", "event_id", "station")).alias("last"),
            F.max(F.col("station") == domain.DISPATCH).alias("dispatched"),
        )
        .withColumn("last_ms", F.col("last.at_ms"))
        .withColumn("last_station", F.col("last.station"))
        .drop("last")
    )


def _slot_heads(scans: DataFrame, gap_ms: int, keep: int) -> DataFrame:
    """The earliest ``keep`` scans of every slot, in order."""
    order = W.partitionBy("package_id", "slot").orderBy("at_ms", "event_id")
    return (
        _slotted(scans, gap_ms)
        .withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= keep)
        .groupBy("package_id", "slot")
        .agg(F.sort_array(F.collect_list(F.struct("rn", "station"))).getField("station").alias("head"))
    )


def _number_sessions(summaries: DataFrame, gap_ms: int) -> DataFrame:
    """Adds ``session_no`` per package; a scan exactly one gap later stays in the session."""
    by_time = W.partitionBy("package_id").orderBy("slot")
    away = F.col("first_ms") - F.lag("last_ms").over(by_time)
    return summaries.withColumn("opens", F.coalesce(away > gap_ms, F.lit(True)).cast("int")).withColumn(
        "session_no", F.sum("opens").over(by_time)
    )


def sessions(scans: DataFrame, gap_ms: int = _GAP, keep: int = PATH_STATIONS) -> DataFrame:
    """One row per package and session.

    ``head`` holds the first ``keep`` stations in scan order (at least as many as the route has): the
    whole path of a shorter session; ``last_station`` is the station of the last scan.
    """
    # Both sides are already partitioned by the join keys, so a merge join adds no shuffle, while a
    # broadcast would gather one of these unbounded sides on the driver.
    slots = _slot_summaries(scans, gap_ms).join(
        _slot_heads(scans, gap_ms, keep).hint("merge"), ["package_id", "slot"]
    )
    numbered = _number_scans(_number_sessions(slots, gap_ms))
    # Slots that start after the head no longer matter for it.
    head = F.when(F.col("before") < keep, F.struct("slot", "head"))
    return (
        numbered.groupBy("package_id", "session_no")
        .agg(
            F.min("first_ms").alias("first_ms"),
            F.max(F.struct("slot", "last_ms", "last_station")).alias("last"),
            F.sum("n").alias("scan_count"),
            F.max("dispatched").alias("reached_dispatch"),
            F.slice(F.flatten(F.sort_array(F.collect_list(head)).getField("head")), 1, keep).alias("head"),
        )
        .select(
            "package_id",
            F.timestamp_millis("first_ms").alias("session_start"),
            F.timestamp_millis(F.col("last.last_ms") + gap_ms).alias("session_end"),
            F.timestamp_millis("last.last_ms").alias("last_scan_at"),
            F.col("last.last_station").alias("last_station"),
            "scan_count",
            "reached_dispatch",
            "head",
        )
    )


def _number_scans(slots: DataFrame) -> DataFrame:
    """Adds ``before``: how many scans of the session lie in its earlier slots."""
    in_session = (
        W.partitionBy("package_id", "session_no").orderBy("slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return slots.withColumn("before", F.sum("n").over(in_session) - F.col("n"))


def session_scans(scans: DataFrame, gap_ms: int = _GAP) -> DataFrame:
    """Every scan with the start of its session and its ``position`` there (from 1): whole paths as rows.

    The order inside a session is (``scanned_at``, ``event_id``).
    """
    starts = _number_scans(_number_sessions(_slot_summaries(scans, gap_ms), gap_ms)).select(
        "package_id",
        "slot",
        "before",
        F.min("first_ms").over(W.partitionBy("package_id", "session_no")).alias("start_ms"),
    )
    in_slot = W.partitionBy("package_id", "slot").orderBy("scanned_at", "event_id")
    return (
        scans.withColumn("slot", S.slot_start(S.millis("scanned_at"), gap_ms))
        .withColumn("rn", F.row_number().over(in_slot))
        .join(starts, ["package_id", "slot"])
        .withColumn("session_start", F.timestamp_millis("start_ms"))
        .withColumn("position", F.col("before") + F.col("rn"))
        .drop("slot", "start_ms", "before", "rn")
    )


def misrouted_paths(scans: DataFrame, gap_ms: int = _GAP, route: tuple[str, ...] = domain.ROUTE) -> DataFrame:
    """The whole path of every misrouted session as rows, under the id and time of its alert."""
    judged = (
        verdicts(sessions(scans, gap_ms, _HEAD), route)
        .where("misrouted")
        .select(
            "package_id",
            "session_start",
            F.concat(F.lit(domain.MISROUTING_ID), "package_id").alias("alert_id"),
            F.col("last_scan_at").alias("detected_at"),
        )
    )
    return (
        session_scans(scans, gap_ms)
        .join(judged, ["package_id", "session_start"])
        .select("alert_id", "package_id", "detected_at", "position", "event_id", "station", "scanned_at")
    )


def first_deviation(path: Column, route: tuple[str, ...] = domain.ROUTE) -> Column:
    """0-based index of the first station that is not the expected one, -1 if there is none.

    Only the first ``len(route)`` scans are judged; a path may be shorter than the route.
    """
    # Past the end of a short path get() is NULL, and so is the comparison: no deviation there.
    index = F.when(F.get(path, F.lit(0)) != route[0], 0)
    for i, station in enumerate(route[1:], start=1):
        index = index.when(F.get(path, F.lit(i)) != station, i)
    return index.otherwise(-1)


def verdicts(sessions: DataFrame, route: tuple[str, ...] = domain.ROUTE) -> DataFrame:
    """Sessions plus ``deviation_index``, ``misrouted`` and the station pair that shows it.

    Without a deviation the actual station is that of the last scan.
    """
    if len(route) > _HEAD:
        raise ValueError(f"a route has at most {_HEAD} stations")
    dev = F.col("deviation_index")
    expected = F.array(*[F.lit(s) for s in route])
    return (
        sessions.withColumn("deviation_index", first_deviation(F.col("head"), route))
        .withColumn("misrouted", (dev != -1) | ~F.col("reached_dispatch"))
        .withColumn("expected_station", F.coalesce(F.get(expected, dev), F.lit(route[-1])))
        .withColumn("actual_station", F.when(dev != -1, F.get("head", dev)).otherwise(F.col("last_station")))
    )


def misrouting_alerts(sessions: DataFrame, route: tuple[str, ...] = domain.ROUTE) -> DataFrame:
    """One alert per misrouted session, in the nested alert schema.

    The id is stable per package, so a corrected journey updates its alert. ``path_so_far`` is the whole
    path as far as the sessions hold it; a longer journey's alert has its number of scans as attribute
    ``path_scans``, and :func:`misrouted_paths` has its whole path as rows (``alerts.with_whole_paths``
    puts them into alerts where arrays of that size are wanted).
    """
    cut = F.col("scan_count") > F.size("head")
    return (
        verdicts(sessions, route)
        .where("misrouted")
        .select(
            F.concat(F.lit(domain.MISROUTING_ID), "package_id").alias("alert_id"),
            "package_id",
            F.lit("ALERT_TYPE_MISROUTING").alias("alert_type"),
            F.when(F.col("reached_dispatch"), "SEVERITY_WARNING")
            .otherwise("SEVERITY_CRITICAL")
            .alias("severity"),
            F.concat(
                F.lit(domain.MISROUTING_EXPECTED),
                "expected_station",
                F.lit(domain.MISROUTING_OBSERVED),
                "actual_station",
            ).alias("message"),
            F.lit("STATION_TYPE_UNSPECIFIED").alias("station"),
            F.col("last_scan_at").alias("detected_at"),
            F.lit(None).cast(domain.STUCK_DETAIL).alias("stuck_detail"),
            F.lit(None).cast(domain.DAMAGE_DETAIL).alias("damage_detail"),
            F.struct(
                "expected_station",
                "actual_station",
                F.col("head").alias("path_so_far"),
            ).alias("misrouting_detail"),
            F.when(cut, F.create_map(F.lit(domain.PATH_SCANS), F.col("scan_count").cast("string")))
            .otherwise(F.create_map().cast("map<string,string>"))
            .alias("attributes"),
        )
    )
