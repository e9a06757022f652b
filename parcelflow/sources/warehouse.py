"""Alert, rollup and report tables as Parquet, and the CSV export.

Alerts, their hourly counts, late scans and positions are tables of parts under one root (see ``parts``), so
a batch of alerts and the counts it adds are committed together.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date as Date
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions import scalars as S
from parcelflow.operators import alerts as A
from parcelflow.sources import parts

ALERTS, ROLLUP = "alerts", "alert_hourly_rollup"
_ALERT_DAY, _ROLLUP_DAY = "detected_date", "hour_date"
_ALERT_ORDER = ("alert_type", "detected_at", "alert_id")


def report_path(root: str, name: str) -> str:
    return f"{root}/{name}"


def _alert_rows(alerts: DataFrame, inserted_at: Column) -> DataFrame:
    flat = alerts if "stuck_duration_seconds" in alerts.columns else A.flatten_alerts(alerts)
    return flat.withColumn("inserted_at", inserted_at).withColumn(_ALERT_DAY, F.to_date("detected_at"))


def append_alerts(
    alerts: DataFrame,
    root: str,
    inserted_at: datetime | None = None,
    batch_id: int | None = None,
    writer: str = "batch",
    extra: Iterable[parts.Entry] = (),
) -> None:
    """Adds a batch of alerts, and the partial counts it adds to the hourly rollup, in one commit.

    Any number of writers share the tables. A batch that the same ``writer`` repeats under its
    ``batch_id`` after a failure changes nothing; without a ``batch_id`` the batch is new. The counts are
    taken from the stored batch, so ``alerts`` is computed once. ``extra``: staged parts of other tables
    that belong to the batch.
    """
    spark = alerts.sparkSession
    owner = None if batch_id is None else writer
    if parts.done(spark, root, owner, batch_id):
        return
    stamp = F.current_timestamp() if inserted_at is None else S.ts(inserted_at)
    added = parts.stage(_alert_rows(alerts, stamp), root, ALERTS, _ALERT_DAY, *_ALERT_ORDER)
    counts = []
    if added:
        day = domain.T.StructField(_ALERT_DAY, domain.T.DateType())
        stored = parts.read_entries(spark, root, added, domain.ALERT_ROW, day)
        rollup = A.hourly_rollup(stored).withColumn(_ROLLUP_DAY, F.to_date("hour"))
        counts = parts.stage(rollup, root, ROLLUP, _ROLLUP_DAY, "hour")
    parts.commit(spark, root, [*added, *counts, *extra], (), owner, batch_id)


def _date(t: datetime | None):
    return None if t is None else t.date()


def read_alerts(
    spark: SparkSession,
    root: str,
    floor: datetime | None = None,
    ceiling: datetime | None = None,
    snapshot: parts.Snapshot | None = None,
) -> DataFrame:
    """The alert table; ``floor`` and ``ceiling`` (both included) filter by time and prune the day directories."""
    df = parts.read(spark, root, ALERTS, domain.ALERT_ROW, _ALERT_DAY, _date(floor), _date(ceiling), snapshot)
    df = df.select(*domain.ALERT_ROW.names)
    if floor is not None:
        df = df.where(F.col("detected_at") >= S.ts(floor))
    if ceiling is not None:
        df = df.where(F.col("detected_at") <= S.ts(ceiling))
    return df


def read_rollup(
    spark: SparkSession,
    root: str,
    floor: datetime | None = None,
    ceiling: datetime | None = None,
    snapshot: parts.Snapshot | None = None,
) -> DataFrame:
    """Partial hourly counts of whole days, pruned; merge them with ``alerts.merge_rollup``."""
    df = parts.read(spark, root, ROLLUP, domain.ROLLUP_ROW, _ROLLUP_DAY, _date(floor), _date(ceiling), snapshot)
    return df.select(*domain.ROLLUP_ROW.names)


def compact_alert_day(spark: SparkSession, root: str, day: Date) -> None:
    """Few files for one day of the alert and rollup tables; readers see it at once."""
    parts.compact(spark, root, ALERTS, domain.ALERT_ROW, _ALERT_DAY, day, order=_ALERT_ORDER)
    keys = ("hour", "alert_type", "severity", "station")
    parts.compact(
        spark, root, ROLLUP, domain.ROLLUP_ROW, _ROLLUP_DAY, day, lambda df: A.merge_rollup(df, *keys), ("hour",)
    )


def compact_crowded_days(spark: SparkSession, root: str, parts_from: int = 8) -> int:
    """Compacts the days of either table that are spread over many parts; returns how many."""
    snapshot = parts.load(spark, root)
    crowded = {*snapshot.crowded(ALERTS, parts_from), *snapshot.crowded(ROLLUP, parts_from)}
    for day in sorted(crowded):
        compact_alert_day(spark, root, Date.fromisoformat(day))
    return len(crowded)


def drop_expired(spark: SparkSession, root: str, as_of: datetime, days: int = domain.DEFAULTS.alert_retention_days) -> int:
    """Takes whole days that are past retention out of the alert table; returns how many.

    Their files go with the next ``clean``.
    """
    limit = as_of.date() - timedelta(days=days)
    while True:
        old = parts.days(parts.load(spark, root), ALERTS, None, limit - timedelta(days=1))
        # A compaction in between has replaced some of them: look again.
        if not old or parts.drop(spark, root, old):
            return len({e.key for e in old})


def clean(spark: SparkSession, root: str, grace_ms: int = parts.GRACE_MS) -> int:
    """Deletes files of replaced and expired parts that no reader can be using any more."""
    tables = {ALERTS: _ALERT_DAY, ROLLUP: _ROLLUP_DAY, "late_scans": "scan_date", "positions": "kept"}
    tables |= {"withdrawn_alerts": "withdrawn_date", "damage_steps": "step_date"}
    return parts.clean(spark, root, tables, grace_ms)


def overwrite_report(report: DataFrame, path: str, inserted_at: datetime | None = None) -> None:
    """Replaces the report dates present in ``report``; an empty report changes nothing."""
    stamp = F.current_timestamp() if inserted_at is None else S.ts(inserted_at)
    (
        report.withColumn("inserted_at", stamp)
        .hint("rebalance", "report_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_date")
        .parquet(path)
    )


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_latest(history: DataFrame, keys: list[str]) -> DataFrame:
    """The version with the newest ``inserted_at`` per key, for report tables kept append-only."""
    return A.latest_versions(history, keys, ["inserted_at"])


def query(spark: SparkSession, text: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Parameterised SQL over named DataFrames. Values go in as ``args``, never into the text."""
    return spark.sql(text, args=args or {}, **tables)


def scalar(df: DataFrame):
    """First column of the first row, None when there is no row."""
    row = df.first()
    return row[0] if row is not None else None


def csv_rows(flagged: DataFrame) -> DataFrame:
    """The flagged list as exported: id, issue, station, ISO time with milliseconds."""
    names = domain.CSV_HEADER
    return flagged.select(
        F.col("package_id").alias(names[0]),
        S.alert_label(F.col("alert_type"), "Alert").alias(names[1]),
        S.station_label(F.col("station"), "").alias(names[2]),
        F.date_format("detected_at", domain.ISO_MILLIS).alias(names[3]),
    )


def export_csv(flagged: DataFrame, path: str) -> None:
    """Header and every field quoted, quotes doubled. Keeps the order of ``flagged``.

    Meant for the short flagged list; for one single file coalesce it first.
    """
    (
        csv_rows(flagged)
        .write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )
