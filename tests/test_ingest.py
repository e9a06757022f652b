from __future__ import annotations

import base64
import json

import pytest
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.functions import scalars as S
from parcelflow.operators import ingest
from parcelflow.sources import lake
from tests.helpers import BASE, at


def routed(spark, station, result="SCAN_RESULT_OK", damage_type="", event_id="e", package_id="p"):
    df = spark.createDataFrame(
        [(event_id, package_id, f"STATION_TYPE_{station}", result, damage_type)],
        "event_id string, package_id string, station string, result string, damage_type string",
    )
    return ingest.route(df, at(BASE)).collect()


def test_next_stop(spark):
    (r,) = routed(spark, "INTAKE")
    assert r.action == "ROUTING_ACTION_PROCEED"
    assert r.next_station == "STATION_TYPE_INDUCTION" and r.next_lane_id == "lane-INDUCTION-1"
    assert r.in_response_to_event_id == "e" and r.reason == ""
    assert routed(spark, "SORT_A")[0].next_station == "STATION_TYPE_SORT_B"


def test_final_station_holds(spark):
    (r,) = routed(spark, "DISPATCH")
    assert r.action == "ROUTING_ACTION_HOLD" and "final station" in r.reason


def test_unreadable_holds(spark):
    (r,) = routed(spark, "SORT_A", "SCAN_RESULT_UNREADABLE")
    assert r.action == "ROUTING_ACTION_HOLD" and "unreadable" in r.reason
    assert r.next_station == "STATION_TYPE_UNSPECIFIED"


def test_damage_is_flagged_with_a_next_stop(spark):
    (r,) = routed(spark, "SORT_A", "SCAN_RESULT_DAMAGE_DETECTED", "DAMAGE_TYPE_CRUSHED")
    assert r.action == "ROUTING_ACTION_FLAG_FOR_REVIEW"
    assert r.next_station == "STATION_TYPE_SORT_B" and r.next_lane_id == ""
    assert "DAMAGE_TYPE_CRUSHED" in r.reason


def test_unknown_station_has_no_next_stop(spark):
    (r,) = routed(spark, "UNSPECIFIED")
    assert r.action == "ROUTING_ACTION_HOLD"


@pytest.mark.parametrize("event_id, package_id", [("", "p"), ("e", ""), (None, "p")])
def test_invalid_scans_are_not_routed(spark, event_id, package_id):
    assert routed(spark, "INTAKE", event_id=event_id, package_id=package_id) == []


def wire(spark, *events):
    rows = [("p", base64.b64encode(json.dumps(e).encode()).decode() if isinstance(e, dict) else e) for e in events]
    return spark.createDataFrame(rows, "key string, value string")


def event(**changes):
    return {
        "event_id": "e1", "package_id": "p", "station": "STATION_TYPE_SORT_A", "scanner_id": "s",
        "scanned_at": "2023-11-14T22:13:20.000Z", "result": "SCAN_RESULT_OK",
        "damage_assessment": {"damage_type": "DAMAGE_TYPE_WET", "confidence": 0.87},
        "attributes": {"item_id": "i-1"},
    } | changes


def test_damage_columns_are_blank_unless_damaged(spark):
    ok, _ = ingest.decode_scans(wire(spark, event()))
    r = ok.first()
    assert (r.damage_type, r.damage_confidence, r.item_id) == ("", 0.0, "i-1")
    hurt, _ = ingest.decode_scans(wire(spark, event(result="SCAN_RESULT_DAMAGE_DETECTED")))
    r = hurt.first()
    assert r.damage_type == "DAMAGE_TYPE_WET" and abs(r.damage_confidence - 0.87) < 1e-6


def test_missing_item_and_enum_defaults(spark):
    good, _ = ingest.decode_scans(wire(spark, event(attributes={}, station="", result=None)))
    r = good.first()
    assert (r.item_id, r.station, r.result) == ("", "STATION_TYPE_UNSPECIFIED", "SCAN_RESULT_UNSPECIFIED")


def test_bad_records_go_to_quarantine(spark):
    bad = ["not base64!", base64.b64encode(b"{broken").decode(), event(scanned_at=None), event(station="STATION_TYPE_MOON")]
    good, quarantine = ingest.decode_scans(wire(spark, event(), *bad))
    assert good.count() == 1 and quarantine.count() == 4


def test_partition_of_event_time(spark):
    good, _ = ingest.decode_scans(wire(spark, event()))
    r = lake.lake_rows(good).first()
    assert (r["date"], r["hour"]) == ("2023-11-14", "22")


def test_unknown_enum_name_fails(spark):
    df = spark.createDataFrame([("ALERT_TYPE_NEW",)], "x string")
    with pytest.raises(Exception, match="unknown enum name"):
        df.select(S.enum_name(F.col("x"), domain.ALERT_TYPES, "ALERT_TYPE_UNSPECIFIED")).collect()


def test_item_lookup_defaults(spark):
    items = spark.createDataFrame([("i-1", "Lamp", "ITEM_CATEGORY_HOME_GOODS")], "item_id string, name string, category string")
    rows = [("p", "i-1"), ("q", "i-2"), ("r", ""), ("s", None)]
    df = spark.createDataFrame(rows, "package_id string, item_id string")
    got = {r.package_id: (r.item_name, r.item_category) for r in ingest.with_items(df, items).collect()}
    assert got["p"] == ("Lamp", "ITEM_CATEGORY_HOME_GOODS")
    assert got["q"] == got["r"] == got["s"] == ("", "ITEM_CATEGORY_UNSPECIFIED")


def test_items_join_also_works_without_broadcast(spark):
    items = spark.createDataFrame([("i-1", "Lamp", "ITEM_CATEGORY_HOME_GOODS")], "item_id string, name string, category string")
    rows = [(f"p{i}", "" if i % 3 == 0 else "i-1") for i in range(300)]
    df = spark.createDataFrame(rows, "package_id string, item_id string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ingest.with_items(df, items).groupBy("item_name").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {r[0]: r[1] for r in got} == {"": 100, "Lamp": 200}
