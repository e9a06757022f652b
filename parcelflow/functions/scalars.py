"""Column helpers. All of them stay inside JVM codegen."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import domain


def utc(text: str) -> datetime:
    """``'2026-08-10 12:00:00'`` (or an ISO date) as an aware UTC datetime."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def to_millis(moment: datetime) -> int:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return round(moment.timestamp() * 1000)


def ts(moment: datetime | int) -> Column:
    """Timestamp literal from a datetime (naive means UTC) or epoch milliseconds."""
    millis = moment if isinstance(moment, int) else to_millis(moment)
    return F.timestamp_millis(F.lit(millis))


def millis(column: str | Column) -> Column:
    return F.unix_millis(F.col(column) if isinstance(column, str) else column)


def start_of_hour(column: str | Column) -> Column:
    return F.date_trunc("hour", column)


def partition_date(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def partition_hour(column: str | Column) -> Column:
    return F.date_format(column, "HH")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def dwell_ms(updated_at: str | Column, as_of: datetime | int) -> Column:
    """Time since the last scan, never negative."""
    return F.greatest(F.lit(0).cast("long"), millis(ts(as_of)) - millis(updated_at))


def floor_seconds(ms: Column) -> Column:
    return (slot_start(ms, 1000) / F.lit(1000)).cast("int")


def parcel_status(dwell: Column, p: domain.Params = domain.DEFAULTS) -> Column:
    return (
        F.when(dwell >= p.stuck_threshold_ms, "PARCEL_STATUS_STUCK")
        .when(dwell >= p.delayed_threshold_ms, "PARCEL_STATUS_DELAYED")
        .otherwise("PARCEL_STATUS_IN_TRANSIT")
    )


def strip_prefix(column: Column, prefix: str) -> Column:
    return F.when(column.startswith(prefix), F.substring(column, len(prefix) + 1, 1 << 30)).otherwise(column)


def lane(station: Column) -> Column:
    return F.concat(F.lit("lane-"), strip_prefix(station, "STATION_TYPE_"), F.lit("-1"))


def label(column: Column, labels: dict[str, str], default: str) -> Column:
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), F.lit(default))


def station_label(column: Column, default: str = "Unknown") -> Column:
    return label(column, domain.STATION_LABELS, default)


def category_label(column: Column, default: str = "Unknown") -> Column:
    return label(column, domain.ITEM_CATEGORY_LABELS, default)


def alert_label(column: Column, default: str = "Unknown") -> Column:
    return label(column, domain.ALERT_TYPE_LABELS, default)


def severity_label(column: Column, default: str = "unspecified") -> Column:
    return label(column, domain.SEVERITY_LABELS, default)


def damage_label(column: Column, default: str = "Unspecified") -> Column:
    return label(column, domain.DAMAGE_TYPE_LABELS, default)


def severity_rank(column: Column) -> Column:
    """0..3 in the order of ``domain.SEVERITIES``; an unknown name ranks 0."""
    names = F.array(*[F.lit(s) for s in domain.SEVERITIES])
    return F.greatest(F.array_position(names, column).cast("int") - 1, F.lit(0))


def attribute(attributes: Column, key: str) -> Column:
    """Map lookup, ``''`` when the key or the whole map is missing."""
    return F.coalesce(F.try_element_at(attributes, F.lit(key)), F.lit(""))


def enum_name(column: Column, names: tuple[str, ...], unspecified: str) -> Column:
    """Strict enum check: empty becomes UNSPECIFIED, an unknown name fails the query."""
    bad = F.raise_error(F.concat(F.lit("unknown enum name: "), column)).cast("string")
    return (
        F.when(F.coalesce(column, F.lit("")) == "", F.lit(unspecified))
        .when(column.isin(*names), column)
        .otherwise(bad)
    )


def route_array() -> Column:
    return F.array(*[F.lit(s) for s in domain.ROUTE])


def route_index(station: Column) -> Column:
    """0-based step on the route, -1 for a station that is not on it."""
    return F.array_position(route_array(), station).cast("int") - 1


def next_station(station: Column) -> Column:
    """The following stop, UNSPECIFIED after the last stop and for unknown stations."""
    step = route_index(station)
    following = F.when(step >= 0, F.get(route_array(), step + 1))
    return F.coalesce(following, F.lit("STATION_TYPE_UNSPECIFIED"))


def contains_text(needle: str, *columns: Column) -> Column:
    """Case-insensitive substring match on any of the columns; a blank needle matches all."""
    wanted = needle.strip().lower()
    if not wanted:
        return F.lit(True)
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.lower(c).contains(wanted)
    return hit


def slot_start(ms: Column, width: int) -> Column:
    """Start (epoch ms) of the ``width``-ms slot that holds an epoch-ms value."""
    return ms - F.pmod(ms, F.lit(width).cast("long"))


def only_row(df: DataFrame, expr: Column) -> Column:
    """A whole-table aggregate as a scalar subquery (runs once, returns one value)."""
    return df.agg(expr.alias("v")).scalar()
