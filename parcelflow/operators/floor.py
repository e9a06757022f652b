"""Current state of the facility: positions, occupancy, KPIs, moves, queue depth, damage rate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions import scalars as S
from parcelflow.operators.alerts import station_spine, within
from parcelflow.operators.ingest import with_items

_P = domain.DEFAULTS


def _damaged() -> Column:
    return F.col("result") == "SCAN_RESULT_DAMAGE_DETECTED"


def last_scans(scans: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The latest scan per package by (``scanned_at``, ``event_id``), up to ``as_of`` if it is given."""
    if as_of is not None:
        scans = scans.where(F.col("scanned_at") <= S.ts(as_of))
    latest = F.max(F.struct("scanned_at", "event_id", "station", "result", "item_id")).alias("s")
    return scans.groupBy("package_id").agg(latest).select("package_id", "s.*")


def current_positions(scans: DataFrame, items: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One row per package: where it was last seen (up to ``as_of``), and what it is."""
    return with_items(last_scans(scans, as_of), items).select(
        "package_id",
        "station",
        F.col("scanned_at").alias("updated_at"),
        "item_name",
        "item_category",
        _damaged().alias("damage_detected"),
    )


def evict_stale(positions: DataFrame, as_of: datetime, stale_ms: int = _P.position_stale_ms) -> DataFrame:
    """Drops positions that are strictly older than the staleness limit, or newer than ``as_of``."""
    return positions.where(within("updated_at", as_of, stale_ms))


def known_at(positions: DataFrame, as_of: datetime) -> DataFrame:
    """Positions that are not newer than ``as_of``. What a package did before a newer one is in the
    scans: see ``current_positions(scans, items, as_of)``."""
    return positions.where(F.col("updated_at") <= S.ts(as_of))


def occupancy(positions: DataFrame) -> DataFrame:
    """Packages per station, zero for empty stations of the route."""
    counts = positions.groupBy("station").agg(F.count(F.lit(1)).alias("n"))
    return station_spine(positions).join(counts, "station", "left").select(
        "station", F.coalesce("n", F.lit(0).cast("long")).alias("packages")
    )


def _dwell(as_of: datetime) -> Column:
    return S.millis(S.ts(as_of)) - S.millis("updated_at")


def _at_risk(dwell: Column, p: domain.Params) -> Column:
    return (dwell >= int(p.stuck_threshold_ms * p.at_risk_fraction)) & (dwell < p.stuck_threshold_ms)


def kpis(positions: DataFrame, as_of: datetime, p: domain.Params = _P) -> DataFrame:
    """In transit, at risk and delayed at ``as_of``. Delayed includes packages at risk and stuck ones."""
    dwell = _dwell(as_of)
    return known_at(positions, as_of).agg(
        F.count(F.lit(1)).alias("in_transit"),
        F.count_if(_at_risk(dwell, p)).alias("at_risk"),
        F.count_if(dwell >= p.delayed_threshold_ms).alias("delayed"),
    )


def station_kpis(positions: DataFrame, as_of: datetime, p: domain.Params = _P) -> DataFrame:
    """Per station; here a package at risk does not also count as delayed."""
    dwell = _dwell(as_of)
    risk = _at_risk(dwell, p)
    counts = known_at(positions, as_of).groupBy("station").agg(
        F.count(F.lit(1)).alias("o"),
        F.count_if(~risk & (dwell >= p.delayed_threshold_ms)).alias("d"),
        F.count_if(risk).alias("r"),
    )
    zero = F.lit(0).cast("long")
    return station_spine(positions).join(counts, "station", "left").select(
        "station",
        F.coalesce("o", zero).alias("occupancy"),
        F.coalesce("d", zero).alias("delayed"),
        F.coalesce("r", zero).alias("at_risk"),
    )


def packages_per_station(positions: DataFrame, n: int = _P.station_packages_shown) -> DataFrame:
    """The first ``n`` packages per station (newest first) and how many more there are."""
    newest = W.partitionBy("station").orderBy(F.desc("updated_at"), "package_id")
    first = positions.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= n)
    # Counted apart from the window: counts reduce map-side, a count() over the window would not.
    totals = positions.groupBy("station").agg(F.count(F.lit(1)).alias("total"))
    return first.join(totals, "station").withColumn(
        "overflow", F.greatest(F.col("total") - n, F.lit(0).cast("long"))
    )


def newest_events(scans: DataFrame, n: int = _P.live_event_cap) -> DataFrame:
    return scans.orderBy(F.desc("scanned_at"), F.desc("event_id")).limit(n)


def station_moves(scans: DataFrame, slot_ms: int = 300_000) -> DataFrame:
    """Station changes per package, and whether each was one step forward on the route.

    Scans are compared inside (package, time slot), which spreads a hot package over its slots. Only
    the first and last scan of each slot are then compared across slots.
    """
    slotted = scans.select(
        "package_id", S.slot_start(S.millis("scanned_at"), slot_ms).alias("slot"), "scanned_at", "event_id", "station"
    )
    in_slot = W.partitionBy("package_id", "slot").orderBy("scanned_at", "event_id")
    local = slotted.withColumn("from_station", F.lag("station").over(in_slot)).withColumn(
        "is_last", F.lead("station").over(in_slot).isNull()
    )
    across = W.partitionBy("package_id").orderBy("scanned_at", "event_id")
    edges = (
        local.where(F.col("from_station").isNull() | F.col("is_last"))
        .withColumn("before", F.lag("station").over(across))
        .where(F.col("from_station").isNull())
        .withColumn("from_station", F.col("before"))
        .drop("before")
    )
    pairs = local.where(F.col("from_station").isNotNull()).unionByName(edges)
    step = S.route_index(F.col("from_station"))
    return pairs.where(F.col("from_station") != F.col("station")).select(
        "package_id",
        "event_id",
        "from_station",
        F.col("station").alias("to_station"),
        F.col("scanned_at").alias("moved_at"),
        ((step >= 0) & (S.route_index(F.col("station")) == step + 1)).alias("adjacent"),
    )


def live_damage_rate(scans: DataFrame, as_of: datetime, window_ms: int = _P.damage_window_ms) -> DataFrame:
    """Damage rate and sample size over the scans of the last ``window_ms``."""
    recent = scans.where(
        F.col("scanned_at").between(S.ts(S.to_millis(as_of) - window_ms), S.ts(as_of))
    )
    return recent.agg(F.count(F.lit(1)).alias("sample_size"), F.count_if(_damaged()).alias("d")).select(
        S.safe_ratio(F.col("d"), F.col("sample_size")).alias("damage_rate"), "sample_size"
    )


def damage_rate_series(
    scans: DataFrame, window_ms: int = _P.damage_window_ms, slide_ms: int = _P.damage_sample_ms
) -> DataFrame:
    """Sliding-window damage rate. Scans are counted per slide step once; only the step counts,
    not the scans, are then repeated over the windows they belong to."""
    if window_ms % slide_ms:
        raise ValueError("window_ms must be a multiple of slide_ms")
    at = S.millis("scanned_at")
    steps = scans.groupBy(S.slot_start(at, slide_ms).alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(_damaged()).alias("d")
    )
    return rates_of_steps(steps, window_ms, slide_ms)


def rates_of_steps(steps: DataFrame, window_ms: int, slide_ms: int) -> DataFrame:
    """Sliding-window damage rates from counts per step (``step`` in ms, ``n`` scans, ``d`` damaged)."""
    ends = F.sequence(F.col("step") + slide_ms, F.col("step") + window_ms, F.lit(slide_ms).cast("long"))
    return (
        steps.select(F.explode(ends).alias("end_ms"), "n", "d")
        .groupBy("end_ms")
        .agg(F.sum("n").alias("sample_size"), F.sum("d").alias("d"))
        .select(
            F.timestamp_millis("end_ms").alias("window_end"),
            S.safe_ratio(F.col("d"), F.col("sample_size")).alias("damage_rate"),
            "sample_size",
        )
    )


def queue_depth(
    scans: DataFrame,
    as_of: datetime,
    window_ms: int = _P.queue_window_ms,
    sample_ms: int = _P.queue_sample_ms,
    stale_ms: int | None = _P.position_stale_ms,
) -> DataFrame:
    """Packages per station at every sample tick of the window that ends at ``as_of``.

    A package can only change the picture once per tick, so scans reduce to its last scan per tick
    (everything before the window to one base scan). Each of these adds a package to a station at
    its tick and takes it away at the tick of the next one, or when the position goes stale; the
    depth is the running sum of the changes. No package-by-tick product is built. With ``stale_ms``
    scans that are stale at the first tick are not read at all.
    """
    end = S.to_millis(as_of)
    start = end - window_ms
    ticks = window_ms // sample_ms + 1
    at = S.millis("scanned_at")
    seen = scans.where(F.col("scanned_at") <= S.ts(end))
    if stale_ms is not None:
        seen = seen.where(F.col("scanned_at") >= S.ts(start - stale_ms))
    first_tick = lambda ms: F.greatest(  # noqa: E731  first tick at or after a time
        F.ceil((ms - F.lit(start)) / F.lit(sample_ms)), F.lit(0)
    ).cast("int")
    per_tick = (
        seen.select("package_id", "event_id", "station", at.alias("at_ms"))
        .groupBy("package_id", first_tick(F.col("at_ms")).alias("tick"))
        .agg(F.max(F.struct("at_ms", "event_id", "station")).alias("s"))
    )
    leaves = F.coalesce(F.lead("tick").over(W.partitionBy("package_id").orderBy("tick")), F.lit(ticks))
    if stale_ms is not None:
        # Gone at the first tick that lies strictly more than stale_ms after the scan.
        leaves = F.least(leaves, first_tick(F.col("s.at_ms") + F.lit(stale_ms + 1)))
    stays = per_tick.withColumn("leaves", leaves).where(F.col("leaves") > F.col("tick"))
    change = F.inline(
        F.array(
            F.struct(F.col("tick"), F.lit(1).alias("delta")),
            F.struct(F.col("leaves").alias("tick"), F.lit(-1).alias("delta")),
        )
    )
    changes = (
        stays.select(F.col("s.station").alias("station"), change)
        .groupBy("station", "tick")
        .agg(F.sum("delta").alias("delta"))
    )
    spine = scans.sparkSession.range(ticks).select(
        F.col("id").cast("int").alias("tick"), F.explode(S.route_array()).alias("station")
    )
    running = W.partitionBy("station").orderBy("tick")
    return spine.join(changes, ["station", "tick"], "left").select(
        "station",
        F.timestamp_millis(F.lit(start) + F.col("tick") * F.lit(sample_ms).cast("long")).alias("sampled_at"),
        F.sum(F.coalesce("delta", F.lit(0).cast("long"))).over(running).alias("packages"),
    )
