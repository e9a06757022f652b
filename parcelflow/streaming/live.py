"""Live tables and feeds: positions, damage rate, rollups, alert loading."""

from __future__ import annotations

import sys
from datetime import date as Date

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from parcelflow import domain
from parcelflow.functions import packed
from parcelflow.functions import scalars as S
from parcelflow.operators import cases, floor, ingest
from parcelflow.operators.alerts import latest_versions
from parcelflow.sources import parts, warehouse
from parcelflow.streaming import journeys

# The processor travels to the workers by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_P = domain.DEFAULTS


def with_event_time(scans: DataFrame, ooo_ms: int = _P.max_out_of_orderness_ms) -> DataFrame:
    """Event time is the scan's own ``scanned_at``, with bounded disorder."""
    return scans.withWatermark("scanned_at", f"{ooo_ms} milliseconds")


def dedup(scans: DataFrame, keep_ms: int = _P.resend_window_ms) -> DataFrame:
    """Optional: drops resent scans (same ``event_id``) that arrive within ``keep_ms`` of the first one.

    The watermark runs on the time of arrival, so a scan that is not a duplicate passes, however late it is.
    """
    arrived = scans.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", f"{keep_ms} milliseconds")
    return arrived.dropDuplicatesWithinWatermark(["event_id"]).drop("_arrived")


POSITIONS, LATE_SCANS = "positions", "late_scans"
#: Columns of a stored version of a position.
POSITION_VERSION = T.StructType([*domain.POSITION.fields, T.StructField("event_id", T.StringType())])
# Positions are one table whatever the day: the newest version of a package counts.
_ALL_DAYS = Date(1970, 1, 1)


def start_positions(
    scans: DataFrame, items: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps the position table current: every micro-batch appends the newest scan of each of its
    packages, however late, as a part of its own; readers pick the newest version."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = ingest.with_items(floor.last_scans(batch), items).select(
            "package_id",
            "station",
            F.col("scanned_at").alias("updated_at"),
            "item_name",
            "item_category",
            (F.col("result") == "SCAN_RESULT_DAMAGE_DETECTED").alias("damage_detected"),
            "event_id",
        )
        parts.append(
            newest.withColumn("kept", F.lit(_ALL_DAYS)),
            root,
            POSITIONS,
            "kept",
            "package_id",
            writer=parts.writer_of(batch),
            batch_id=batch_id,
        )

    return (
        scans.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def _newest_versions(versions: DataFrame) -> DataFrame:
    return latest_versions(versions, ["package_id"], ["updated_at", "event_id"])


def positions_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The table a new reader starts from: the newest position per package."""
    versions = parts.read(spark, root, POSITIONS, POSITION_VERSION, "kept").select(*POSITION_VERSION.names)
    return _newest_versions(versions).select(*domain.POSITION.names)


def compact_positions(spark: SparkSession, root: str) -> bool:
    """Keeps only the newest version per package of what was written so far; readers see it at once."""
    return parts.compact(
        spark, root, POSITIONS, POSITION_VERSION, "kept", _ALL_DAYS, _newest_versions, ("package_id",)
    )


def damage_rate_stream(
    scans: DataFrame,
    window_ms: int = _P.damage_window_ms,
    slide_ms: int = _P.damage_sample_ms,
    ooo_ms: int = _P.max_out_of_orderness_ms,
) -> DataFrame:
    """Sliding damage rate: counts per slide step first, then sums of steps per window, so a scan is
    counted once and only the small step rows are repeated over the windows."""
    damaged = F.count_if(F.col("result") == "SCAN_RESULT_DAMAGE_DETECTED")
    steps = (
        with_event_time(scans, ooo_ms)
        .groupBy(F.window("scanned_at", f"{slide_ms} milliseconds"))
        .agg(F.count(F.lit(1)).alias("n"), damaged.alias("d"))
        .select(F.window_time("window").alias("step_time"), "n", "d")
    )
    return (
        steps.groupBy(F.window("step_time", f"{window_ms} milliseconds", f"{slide_ms} milliseconds"))
        .agg(F.sum("n").alias("sample_size"), F.sum("d").alias("d"))
        .select(
            F.col("window.end").alias("window_end"),
            S.safe_ratio(F.col("d"), F.col("sample_size")).alias("damage_rate"),
            "sample_size",
        )
    )


DAMAGE_STEPS = "damage_steps"
_STEP = T.StructType(
    [T.StructField("step", T.TimestampType()), T.StructField("n", T.LongType()), T.StructField("d", T.LongType())]
)


def start_damage_steps(
    scans: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, slide_ms: int = _P.damage_sample_ms
) -> StreamingQuery:
    """Counts scans and damage per slide step, however late they come: each micro-batch adds partial counts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        step = F.timestamp_millis(S.slot_start(S.millis("scanned_at"), slide_ms)).alias("step")
        damaged = F.count_if(F.col("result") == "SCAN_RESULT_DAMAGE_DETECTED")
        counts = batch.groupBy(step).agg(F.count(F.lit(1)).alias("n"), damaged.alias("d"))
        parts.append(
            counts.withColumn("step_date", F.to_date("step")),
            root,
            DAMAGE_STEPS,
            "step_date",
            "step",
            writer=parts.writer_of(batch),
            batch_id=batch_id,
        )

    return (
        scans.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def damage_rates(
    spark: SparkSession,
    root: str,
    first: Date | None = None,
    last: Date | None = None,
    window_ms: int = _P.damage_window_ms,
    slide_ms: int = _P.damage_sample_ms,
) -> DataFrame:
    """Sliding damage rates over the stored steps of some days, late scans included.

    A window that :func:`damage_rate_stream` has given before a late scan came has another value here.
    """
    steps = parts.read(spark, root, DAMAGE_STEPS, _STEP, "step_date", first, last)
    merged = steps.groupBy("step").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    return floor.rates_of_steps(merged.select(S.millis("step").alias("step"), "n", "d"), window_ms, slide_ms)


def compact_damage_steps(spark: SparkSession, root: str, day: Date) -> bool:
    """Few files for one day of steps, with one row a step."""
    total = lambda df: df.groupBy("step").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    return parts.compact(spark, root, DAMAGE_STEPS, _STEP, "step_date", day, total, ("step",))


def start_alert_loader(
    alerts: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Loads nested alerts into the alert table and adds their hourly partial counts."""

    def load(batch: DataFrame, batch_id: int) -> None:
        warehouse.append_alerts(batch, root, batch_id=batch_id, writer=parts.writer_of(batch))

    return (
        alerts.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


LATE_SCAN = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in ("package_id", "event_id", "station")),
        T.StructField("scanned_at", T.TimestampType()),
    ]
)


def read_late_scans(spark: SparkSession, root: str) -> DataFrame:
    """Scans that came too late for their journey."""
    return parts.read(spark, root, LATE_SCANS, LATE_SCAN, "scan_date").select(*LATE_SCAN.names)


def start_journeys(
    scans: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    """Misrouting alerts into the alert table, scans that are too late into a table of their own; a
    batch of both is one commit."""
    options.setdefault("lateness_ms", _P.allowed_lateness_ms)

    def load(batch: DataFrame, batch_id: int) -> None:
        # Two consumers: without persisting, the second one would run the stream plan again.
        batch.persist()
        try:
            alerts = journeys.misrouting_alerts(journeys.closed_sessions(batch))
            late = journeys.late_scans(batch).withColumn("scan_date", F.to_date("scanned_at"))
            staged = parts.stage(late, root, LATE_SCANS, "scan_date", "package_id")
            warehouse.append_alerts(alerts, root, batch_id=batch_id, writer=parts.writer_of(batch), extra=staged)
        finally:
            batch.unpersist()

    return (
        journeys.session_stream(scans, **options)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def live_feed_stream(scans: DataFrame, items: DataFrame, alerts: DataFrame) -> DataFrame:
    """Position updates and alerts as one tagged stream."""
    return cases.live_feed(ingest.position_updates(scans, items), alerts)


#: Groups of packages, by a hash: a call into the state store for each package would take most of the time.
#: State is kept per group, so a checkpoint holds for one number of groups.
KNOWN_GROUPS = 8_192
# One element holds versions of many packages, in columns.
_KNOWN = "package_ids array<string>, at_ms array<bigint>, event_ids array<string>"


def _group() -> Column:
    return F.pmod(F.xxhash64("package_id"), F.lit(KNOWN_GROUPS)).alias("group")


def _age(at_ms: int | None, event_id: str | None) -> tuple:
    """Sorts versions as Spark does: null first."""
    return (at_ms is not None, at_ms or 0, event_id is not None, event_id or "")


class _Changes(StatefulProcessor):
    """Passes on what is newer than the position known of a package, in order, for a group of packages.

    A batch appends the versions that it has changed; the list is written anew when it is twice as long
    as the group has packages.
    """

    def init(self, handle):
        self._state = handle.getListState("known", _KNOWN)

    def handleInitialState(self, key, initialState, timerValues):
        self._state.appendValue((list(initialState.package_ids), list(initialState.at_ms), list(initialState.event_ids)))

    def _newer(self, versions):
        """The places of the versions (package, at_ms, event_id) that are newer than what is known, in order; they are known then."""
        known, stored = {}, 0
        for packages, times, events in self._state.get():
            # A later element holds newer versions.
            known.update(zip(packages, zip(times, events)))
            stored += len(packages)
        changed, newer = {}, []
        for k in sorted(range(len(versions)), key=lambda k: _age(*versions[k][1:])):
            package, *new = versions[k]
            old = known.get(package)
            if old is None or _age(*new) > _age(*old):
                known[package] = changed[package] = tuple(new)
                newer.append(k)
        if stored + len(changed) > 2 * len(known):
            self._state.put([self._element(known)])
        elif changed:
            self._state.appendValue(self._element(changed))
        return newer

    def handleInputRows(self, key, rows, timerValues):
        rows, names = list(rows), POSITION_VERSION.names
        for k in self._newer([(r.package_id, r.at_ms, r.event_id) for r in rows]):
            yield Row(**{name: rows[k][name] for name in names})

    def _element(self, versions):
        return (list(versions), [at_ms for at_ms, _ in versions.values()], [event_id for _, event_id in versions.values()])

    def close(self):
        pass


#: A packed update.
_UPDATE = pa.schema(
    [
        ("package_id", pa.string()),
        ("at_ms", pa.int64()),
        ("event_id", pa.string()),
        ("station", pa.string()),
        ("at_us", pa.int64()),
        ("item_name", pa.string()),
        ("item_category", pa.string()),
        ("damage_detected", pa.bool_()),
    ]
)
_UPDATE_ROW = (
    "package_id string, at_ms bigint, event_id string, station string, at_us bigint, item_name string, item_category string, "
    "damage_detected boolean"
)


class _PackedChanges(_Changes):
    """The same for packed updates: a row for each of them on the way to Python and back took most of the time."""

    def handleInputRows(self, key, rows, timerValues):
        updates = packed.unpack_all((bytes(r.packed) for r in rows), _UPDATE)
        newer = self._newer(list(zip(*(updates.column(n).to_pylist() for n in ("package_id", "at_ms", "event_id")))))
        if newer:
            yield Row(packed=packed.pack(packed.one_batch(updates.take(pa.array(newer)))))


def subscribe(scans: DataFrame, items: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """What a client that joins in the middle needs: ``(snapshot, updates)``.

    The snapshot is the position table as it stands. The updates are a stream of position changes that
    starts with the snapshot as its state: a scan that is in the snapshot already is not repeated, every
    newer one comes out. ``scans`` must have been started no later than the call (``stream.starting_now``), so
    nothing is lost in between; an overlap does no harm.
    """
    spark = scans.sparkSession
    versions = parts.read(spark, root, POSITIONS, POSITION_VERSION, "kept").select(*POSITION_VERSION.names)
    known = _newest_versions(versions)
    listed = F.collect_list(F.struct("package_id", S.millis("updated_at").alias("at_ms"), "event_id"))
    start = known.groupBy(_group()).agg(listed.alias("v")).select(
        "group", F.col("v.package_id").alias("package_ids"), F.col("v.at_ms").alias("at_ms"), F.col("v.event_id").alias("event_ids")
    )
    at_us = F.unix_micros("updated_at").alias("at_us")
    arriving = ingest.position_updates(scans, items, "event_id").select(
        _group(), "*", S.millis("updated_at").alias("at_ms"), at_us
    ).select("group", *_UPDATE.names)
    changes = arriving.mapInArrow(packed.gathered(_UPDATE, GATHERED), packed.GROUPED).groupBy("group").transformWithState(
        statefulProcessor=_PackedChanges(),
        outputStructType="packed binary",
        outputMode="update",
        timeMode="None",
        initialState=start.groupBy("group"),
    )
    updates = changes.mapInArrow(packed.opened(_UPDATE), _UPDATE_ROW).withColumn("updated_at", F.timestamp_micros("at_us"))
    return known.select(*domain.POSITION.names), updates.select(*domain.POSITION.names)


#: Rows that a reading task gathers before it hands them on, packed.
GATHERED = 400_000
#: Groups of packages and slots that the join of alerts and scans keeps its state for; a checkpoint holds for one number of groups.
NEAR_GROUPS = 1_024
_KEYED = [("package_id", pa.string()), ("slot", pa.int64()), ("at_us", pa.int64())]
_NEAR_ALERT = pa.schema([*_KEYED, ("alert_id", pa.string())])
_NEAR_SCAN = pa.schema([*_KEYED, ("event_id", pa.string()), ("station", pa.string())])
_NEAR_PAIR = pa.schema([*((n, pa.string()) for n in ("alert_id", "package_id", "event_id", "station")), ("at_us", pa.int64())])


class _Near(StatefulProcessor):
    """Pairs of alerts and scans of one group of packages and slots; both sides are kept, packed, while the other may still come."""

    def __init__(self, width_us: int):
        # Rows of a package and time of this width are late together.
        self._width, self._slot = width_us, 4 * width_us
        # A row this far behind the watermark is near no row that still may come.
        self._apart = 5 * width_us

    def init(self, handle):
        self._handle = handle
        self._kept = handle.getListState("kept", "alert boolean, oldest_us bigint, newest_us bigint, packed binary")
        self._timer = handle.getValueState("timer", "at_ms bigint")

    def _rows(self, stored, alert: bool) -> pa.Table:
        return packed.unpack_all((bytes(r[3]) for r in stored if r[0] == alert), _NEAR_ALERT if alert else _NEAR_SCAN)

    def _elements(self, alert: bool, rows: pa.Table) -> list:
        if not rows.num_rows:
            return []
        at = rows.column("at_us").to_numpy()
        return [(alert, int(at.min()), int(at.max()), packed.pack(packed.one_batch(rows)))]

    def _on_time(self, rows: pa.Table, watermark_us: int) -> pa.Table:
        """Without the rows of a package and slot of time whose last one is behind the watermark."""
        at = rows.column("at_us").to_numpy()
        if not len(at) or at.min() > watermark_us:
            return rows
        (package,) = packed.codes(rows.column("package_id"))
        slots, slot = np.unique(at // self._slot, return_inverse=True)
        _, of = np.unique(package * len(slots) + slot, return_inverse=True)
        last = np.full(of.max() + 1, np.iinfo(np.int64).min)
        np.maximum.at(last, of, at)
        return rows.filter(pa.array(last[of] > watermark_us))

    def _keep(self, stored: list, watermark_us: int) -> None:
        """Keeps what can still be near a row to come, and looks again when the oldest row cannot."""
        kept, limit = [], watermark_us - self._apart
        for alert in (True, False):
            rows = self._rows([r for r in stored if r[2] > limit], alert)
            kept += self._elements(alert, rows.filter(pa.array(rows.column("at_us").to_numpy() > limit)))
        if not kept:
            self._kept.clear()
            self._timer.clear()
            return
        self._kept.put(kept)
        # Not for every step of the watermark: a look reads and writes the whole group.
        at_ms = (max(watermark_us, min(r[1] for r in kept)) + self._apart) // 1000 + 1
        self._handle.registerTimer(at_ms)
        self._timer.update((at_ms,))

    def handleInputRows(self, key, rows, timerValues):
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        arrived = [(r.alert, None, None, r.packed) for r in rows]
        new_alerts, new_scans = (self._on_time(self._rows(arrived, alert), watermark_us) for alert in (True, False))
        stored = list(self._kept.get())
        scans = pa.concat_tables([self._rows(stored, False), new_scans]) if new_alerts.num_rows else new_scans
        alerts = self._rows(stored, True) if new_scans.num_rows else new_alerts.slice(0, 0)
        for left, right in ((new_alerts, scans), (alerts, new_scans)):
            for of_left, of_right in packed.near(left, right, self._width):
                found = right.take(of_right).append_column("alert_id", left.column("alert_id").take(of_left))
                yield Row(packed=packed.pack(packed.one_batch(found.select(_NEAR_PAIR.names))))
        added = self._elements(True, new_alerts) + self._elements(False, new_scans)
        if self._timer.get() is None:
            self._keep([*stored, *added], watermark_us)
        else:
            for element in added:
                self._kept.appendValue(element)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._keep(list(self._kept.get()), timerValues.getCurrentWatermarkInMs() * 1000)
        return iter(())

    def close(self):
        pass


def _packed_side(keyed: DataFrame, schema: pa.Schema, groups: int) -> DataFrame:
    """``group, packed`` of the rows that a task has met, by a hash of package and slot: a busy package is spread over its slots."""
    group = F.pmod(F.xxhash64("package_id", "slot"), F.lit(groups)).alias("group")
    return keyed.select(group, *schema.names).mapInArrow(packed.gathered(schema, GATHERED), packed.GROUPED)


def _timed(rows: DataFrame, at: str, delay_ms: int) -> DataFrame:
    """The rows that have a time and a package, with a watermark and ``at_us``."""
    known = rows.where(F.col(at).isNotNull() & F.col("package_id").isNotNull())
    return known.withWatermark(at, f"{delay_ms} milliseconds").withColumn("at_us", F.unix_micros(at))


def nearby_scan_stream(
    alerts: DataFrame,
    scans: DataFrame,
    half_width_ms: int = _P.case_half_width_ms,
    delay_ms: int = _P.max_out_of_orderness_ms,
) -> DataFrame:
    """Stream-stream form of ``cases.nearby_scans``: both sides have a watermark, behind which old state is dropped.

    ``delay_ms`` is how late a scan or alert may come; state is kept that much longer, and for two and a half widths
    once or twice. Both sides meet on (package, time slot), packed by groups of these: a row of the state for each
    package and slot cost several calls into the state store, which took most of the time of a large table.
    """
    # Wide slots: an alert near the border of its slot is there twice.
    width, slot = half_width_ms * 1000, 24 * half_width_ms * 1000
    at = F.col("at_us")
    # Alerts that are near the border of their slot are near scans of the next one.
    reach = F.array_distinct(F.array(*[S.slot_start(at + d, slot) for d in (1 - width, 0, width - 1)]))
    left = _timed(alerts, "detected_at", half_width_ms + delay_ms).withColumn("slot", F.explode(reach))
    right = _timed(scans, "scanned_at", delay_ms).withColumn("slot", S.slot_start(at, slot))
    sides = _packed_side(left, _NEAR_ALERT, NEAR_GROUPS).withColumn("alert", F.lit(True)).unionByName(
        _packed_side(right, _NEAR_SCAN, NEAR_GROUPS).withColumn("alert", F.lit(False))
    )
    pairs = sides.groupBy("group").transformWithState(
        statefulProcessor=_Near(width), outputStructType="packed binary", outputMode="append", timeMode="EventTime"
    )
    found = pairs.mapInArrow(packed.opened(_NEAR_PAIR), "alert_id string, package_id string, event_id string, station string, at_us bigint")
    return found.select("alert_id", "package_id", "event_id", "station", F.timestamp_micros("at_us").alias("scanned_at"))
