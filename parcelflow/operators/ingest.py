"""From wire records to scans, routing decisions and position updates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow import domain
from parcelflow.functions import messages
from parcelflow.functions import scalars as S

_DAMAGED = "SCAN_RESULT_DAMAGE_DETECTED"


def lake_columns() -> list[Column]:
    """Lake columns of a decoded scan event; damage is blank unless the scan reports damage."""
    damaged = F.col("result") == _DAMAGED
    damage_type = S.enum_name(
        F.col("damage_assessment.damage_type"), domain.DAMAGE_TYPES, "DAMAGE_TYPE_UNSPECIFIED"
    )
    text = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    return [
        text("event_id"),
        text("package_id"),
        S.enum_name(F.col("station"), domain.STATION_TYPES, "STATION_TYPE_UNSPECIFIED").alias("station"),
        text("scanner_id"),
        F.col("scanned_at"),
        S.enum_name(F.col("result"), domain.SCAN_RESULTS, "SCAN_RESULT_UNSPECIFIED").alias("result"),
        F.when(damaged, damage_type).otherwise("").alias("damage_type"),
        F.when(damaged, F.coalesce(F.col("damage_assessment.confidence"), F.lit(0.0)))
        .otherwise(0.0)
        .cast("float")
        .alias("damage_confidence"),
        S.attribute(F.col("attributes"), "item_id").alias("item_id"),
    ]


def _known(column: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(column, F.lit("")).isin("", *names)


def _usable(event: Column) -> Column:
    """False for a record without event time, or with an enum name outside its domain."""
    return (
        event["scanned_at"].isNotNull()
        & _known(event["station"], domain.STATION_TYPES)
        & _known(event["result"], domain.SCAN_RESULTS)
        & _known(event["damage_assessment"]["damage_type"], domain.DAMAGE_TYPES)
    )


def wire_payload(schema: T.StructType, fmt: str = "json", **protobuf) -> Column:
    """The ``value`` column (base64 text) parsed; null fields where it cannot be.

    ``fmt='json'`` needs nothing else; ``fmt='protobuf'`` uses Spark's protobuf package with
    ``message_name`` and ``descriptor_path``.
    """
    payload = F.try_to_binary("value", F.lit("base64"))
    if fmt == "json":
        return F.from_json(payload.cast("string"), schema, {"mode": "PERMISSIVE"})
    if fmt == "protobuf":
        from pyspark.sql.protobuf.functions import from_protobuf

        options = {"mode": "PERMISSIVE", "enums.as.ints": "false"}
        return from_protobuf(payload, protobuf["message_name"], protobuf["descriptor_path"], options)
    raise ValueError(f"unknown wire format: {fmt}")


def wire_events(fmt: str = "json", **protobuf) -> Column:
    """The ``value`` column decoded: an array of one event, empty where it cannot be decoded.

    An array, because filtering inside it parses each record once; as a plain column the optimizer
    would copy the parser into every condition that follows.
    """
    return F.filter(F.array(wire_payload(domain.SCAN_EVENT, fmt, **protobuf)), _usable)


def decode_scans(wire: DataFrame, fmt: str = "json", **protobuf) -> tuple[DataFrame, DataFrame]:
    """``(scans, quarantine)``: lake rows, and the wire records that could not be decoded.

    ``fmt='binary'`` reads the tracked system's own messages (see ``functions.messages``).
    """
    if fmt == "binary":
        names = wire.columns
        read = messages.with_message(wire, messages.SCAN_EVENT, domain.SCAN_EVENT, "_message")
        usable = F.col("_message").isNotNull() & _usable(F.col("_message"))
        return read.where(usable).select("_message.*").select(*lake_columns()), read.where(~usable).select(*names)
    events = wire_events(fmt, **protobuf)
    good = wire.select(F.inline(events)).select(*lake_columns())
    return good, wire.where(F.size(events) == 0)


def encode_scans(scans: DataFrame, fmt: str = "json") -> DataFrame:
    """Lake rows as keyed wire records (``key`` = package, so per-package order holds)."""
    columns = (
        "event_id",
        "package_id",
        "station",
        "scanner_id",
        "scanned_at",
        "result",
        F.struct(
            F.col("damage_type"),
            F.col("damage_confidence").cast("float").alias("confidence"),
            F.lit("").alias("image_ref"),
        ).alias("damage_assessment"),
        F.create_map(F.lit("item_id"), F.col("item_id")).alias("attributes"),
    )
    if fmt == "binary":
        return messages.to_wire(scans.select(*columns), messages.SCAN_EVENT, "package_id")
    return scans.select(
        F.col("package_id").alias("key"), F.base64(F.to_json(F.struct(*columns)).cast("binary")).alias("value")
    )


def valid_scans(scans: DataFrame) -> DataFrame:
    """Scans that can be routed and published: both ids present."""
    return scans.where(
        (F.coalesce(F.col("event_id"), F.lit("")) != "") & (F.coalesce(F.col("package_id"), F.lit("")) != "")
    )


def route(scans: DataFrame, issued_at: datetime) -> DataFrame:
    """The routing instruction for every valid scan."""
    result, following = F.col("result"), S.next_station(F.col("station"))
    unreadable = result == "SCAN_RESULT_UNREADABLE"
    damaged = result == _DAMAGED
    last_stop = following == "STATION_TYPE_UNSPECIFIED"
    damage = F.coalesce(F.nullif(F.col("damage_type"), F.lit("")), F.lit("DAMAGE_TYPE_UNSPECIFIED"))
    return valid_scans(scans).select(
        F.col("event_id").alias("in_response_to_event_id"),
        "package_id",
        F.when(unreadable, "ROUTING_ACTION_HOLD")
        .when(damaged, "ROUTING_ACTION_FLAG_FOR_REVIEW")
        .when(last_stop, "ROUTING_ACTION_HOLD")
        .otherwise("ROUTING_ACTION_PROCEED")
        .alias("action"),
        F.when(unreadable | damaged | last_stop, "").otherwise(S.lane(following)).alias("next_lane_id"),
        F.when(unreadable, "STATION_TYPE_UNSPECIFIED").otherwise(following).alias("next_station"),
        F.when(unreadable, domain.REASON_UNREADABLE)
        .when(damaged, F.concat(F.lit(domain.REASON_DAMAGE), damage))
        .when(last_stop, domain.REASON_FINAL_STATION)
        .otherwise("")
        .alias("reason"),
        S.ts(issued_at).alias("issued_at"),
    )


def with_items(df: DataFrame, items: DataFrame) -> DataFrame:
    """Left lookup of ``item_name`` (default ``''``) and ``item_category`` (default UNSPECIFIED).

    No broadcast hint: Spark broadcasts the catalog while its size stays under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond. For that case rows without an
    item get a key of their own (their event where there is one, so that a busy package spreads too),
    so that they do not pile up in one partition.
    """
    catalog = items.select(
        F.col("item_id").alias("lookup"), F.col("name").alias("_name"), F.col("category").alias("_category")
    ).where(F.col("lookup") != "")
    blank = F.coalesce(F.col("item_id"), F.lit("")) == ""
    own_key = F.concat(F.lit("\u0000"), F.col("event_id" if "event_id" in df.columns else "package_id"))
    return (
        df.withColumn("lookup", F.when(blank, own_key).otherwise(F.col("item_id")))
        .join(catalog, "lookup", "left")
        .withColumn("item_name", F.coalesce("_name", F.lit("")))
        .withColumn("item_category", F.coalesce("_category", F.lit("ITEM_CATEGORY_UNSPECIFIED")))
        .drop("lookup", "_name", "_category")
    )


def position_updates(scans: DataFrame, items: DataFrame, *more: str) -> DataFrame:
    """Every scan as a position update, with ``more`` of its columns (also on a stream: the item side is static)."""
    return with_items(scans, items).select(
        "package_id",
        "station",
        F.col("scanned_at").alias("updated_at"),
        "item_name",
        "item_category",
        (F.col("result") == _DAMAGED).alias("damage_detected"),
        *more,
    )
