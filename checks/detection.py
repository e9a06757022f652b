"""Sessions, verdicts, stuck packages, ingest and scalar functions."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks.oracle import ROUTE_LIST, label_case, sessions_sql, stuck_sql
from checks.registry import check
from parcelflow import domain
from parcelflow.functions import scalars as S
from parcelflow.operators import alerts as A
from parcelflow.operators import dwell, floor, ingest, journeys

HALF_DAY = 12 * 3_600_000
SIX_HOURS = 6 * 3_600_000

ALERT_COLUMNS = """alert_id, package_id, alert_type, severity, station, message, detected_ms detected_at,
  stuck_duration_seconds, threshold_seconds, expected_station, actual_station, path_so_far,
  damage_type, damage_confidence"""


# --- sessions and verdicts ---------------------------------------------------------------------


@check(
    "win1_sessions",
    """select package_id, start_ms session_start, last_ms + 1200000 session_end, last_ms last_scan_at,
      scan_count, reached reached_dispatch from sess""",
)
def _(t):
    return journeys.sessions(t.scans).select(
        "package_id", "session_start", "session_end", "last_scan_at", "scan_count", "reached_dispatch"
    )


@check(
    "win1_sessions_long_gap",
    f"""select package_id, start_ms session_start, last_ms last_scan_at, scan_count,
      array_to_string(path[1:1000], '>') head, path[len(path)] last_station from ({sessions_sql("scans_long", HALF_DAY)})""",
)
def _(t):
    return journeys.sessions(t.scans_events, HALF_DAY).select(
        "package_id", "session_start", "last_scan_at", "scan_count", "head", "last_station"
    )


PATH_ROWS_SQL = """
select package_id, start_ms session_start, unnest(range(1, len(path) + 1)) as "position", unnest(path) station from ({sessions})"""


@check("win2_ordered_paths", PATH_ROWS_SQL.format(sessions="select * from sess"))
def _(t):
    return journeys.session_scans(t.scans).select("package_id", "session_start", "position", "station")


@check("win2_ordered_long_paths", PATH_ROWS_SQL.format(sessions=sessions_sql("scans_long", HALF_DAY)))
def _(t):
    rows = journeys.session_scans(t.scans_events, HALF_DAY)
    return rows.select("package_id", "session_start", "position", "station")


LONG_VERDICT_SQL = f"""
select *, case when dev <> -1 then path[dev + 1] else path[len(path)] end actual_station
from ({sessions_sql("scans_long", HALF_DAY)}) where dev <> -1 or not reached"""


@check(
    "win4_misrouted_paths",
    f"""select concat('misrouting-', package_id) alert_id, last_ms detected_at,
      unnest(range(1, len(path) + 1)) as "position", unnest(path) station from ({LONG_VERDICT_SQL})""",
)
def _(t):
    rows = journeys.misrouted_paths(t.scans_events, HALF_DAY)
    return rows.select("alert_id", "detected_at", "position", "station")


@check(
    "win4_alerts_with_whole_paths",
    f"""select concat('misrouting-', package_id) alert_id, last_ms detected_at, actual_station,
      array_to_string(path, '>') path_so_far from ({LONG_VERDICT_SQL})""",
)
def _(t):
    alerts = journeys.misrouting_alerts(journeys.sessions(t.scans_events, HALF_DAY))
    whole = A.with_whole_paths(alerts, journeys.misrouted_paths(t.scans_events, HALF_DAY))
    return A.flatten_alerts(whole).select("alert_id", "detected_at", "actual_station", "path_so_far")


@check(
    "win2_session_scans",
    """select package_id, event_id, station, epoch_ms(scanned_at) scanned_at,
      min(epoch_ms(scanned_at)) over (partition by package_id, sno) session_start
    from (select *, sum(case when gap is null or gap > 1200000 then 1 else 0 end)
        over (partition by package_id order by scanned_at, event_id) sno
      from (select *, epoch_ms(scanned_at) - lag(epoch_ms(scanned_at))
          over (partition by package_id order by scanned_at, event_id) gap from scans))""",
)
def _(t):
    return journeys.session_scans(t.scans).select(
        "package_id", "event_id", "station", "scanned_at", "session_start"
    )


@check(
    "win3_first_deviation",
    "select package_id, start_ms session_start, cast(dev as int) deviation_index from sess",
)
def _(t):
    return journeys.sessions(t.scans).select(
        "package_id", "session_start", journeys.first_deviation(F.col("head")).alias("deviation_index")
    )


@check(
    "win4_verdicts",
    """select package_id, start_ms session_start, cast(dev as int) deviation_index, misrouted,
      expected_station, actual_station from verdict""",
)
def _(t):
    return journeys.verdicts(journeys.sessions(t.scans)).select(
        "package_id", "session_start", "deviation_index", "misrouted", "expected_station", "actual_station"
    )


@check("win4_misrouting_alerts", f"select {ALERT_COLUMNS} from misrouting")
def _(t):
    return A.flatten_alerts(journeys.misrouting_alerts(journeys.sessions(t.scans)))


@check(
    "win4_verdict_counts",
    """select misrouted, reached reached_dispatch, dev <> -1 deviated, count(*) sessions
    from verdict group by 1, 2, 3""",
)
def _(t):
    return (
        journeys.verdicts(journeys.sessions(t.scans))
        .groupBy("misrouted", "reached_dispatch", (F.col("deviation_index") != -1).alias("deviated"))
        .agg(F.count(F.lit(1)).alias("sessions"))
    )


@check("win5_stuck_points", "select package_id, station, last_ms from stuck_point")
def _(t):
    return dwell.stuck_points(t.scans)


@check(
    "win5_stuck_points_long_threshold",
    stuck_sql("scans_long", SIX_HOURS),
)
def _(t):
    return dwell.stuck_points(t.scans_events, SIX_HOURS)


@check(
    "win5_stuck_points_before_dispatch",
    "select package_id, station, last_ms from stuck_point where station <> 'STATION_TYPE_DISPATCH'",
)
def _(t):
    return dwell.stuck_points(t.scans, exclude_terminal=True)


@check(
    "win5_stuck_points_at_watermark",
    """select package_id, station, ms last_ms from (
      select package_id, station, epoch_ms(scanned_at) ms,
        lead(epoch_ms(scanned_at)) over (partition by package_id order by scanned_at, event_id) next_ms
      from scans)
    where (next_ms is null or next_ms - ms > 600000) and ms + 600000 <= (select ms from as_of) - 86400000""",
)
def _(t):
    return dwell.stuck_points(t.scans, final_watermark=t.as_of - timedelta(days=1))


@check("win6_stuck_alerts", f"select {ALERT_COLUMNS} from stuck")
def _(t):
    return A.flatten_alerts(dwell.stuck_alerts(t.scans))


@check("str13_damage_alerts", f"select {ALERT_COLUMNS} from damage")
def _(t):
    return A.flatten_alerts(dwell.damage_alerts(t.scans))


@check("set3_union_of_detectors", "select alert_id, alert_type, severity, station, detected_ms detected_at from alerts")
def _(t):
    return A.flatten_alerts(t.detected()).select("alert_id", "alert_type", "severity", "station", "detected_at")


@check(
    "win7_station_moves",
    f"""select package_id, event_id, prev from_station, station to_station, epoch_ms(scanned_at) moved_at,
      list_position({ROUTE_LIST}, station) = list_position({ROUTE_LIST}, prev) + 1 adjacent
    from (select *, lag(station) over (partition by package_id order by scanned_at, event_id) prev from scans)
    where prev <> station""",
)
def _(t):
    return floor.station_moves(t.scans)


@check(
    "win7_station_moves_long",
    f"""select package_id, event_id, prev from_station, station to_station, epoch_ms(scanned_at) moved_at,
      list_position({ROUTE_LIST}, station) = list_position({ROUTE_LIST}, prev) + 1 adjacent
    from (select *, lag(station) over (partition by package_id order by scanned_at, event_id) prev
      from scans_long)
    where prev <> station""",
)
def _(t):
    return floor.station_moves(t.scans_events)


# --- wire, routing, projections ----------------------------------------------------------------


def _wire(t):
    """Every scan on the wire. Scans without damage carry an assessment too, which must be blanked."""
    damage_type = F.coalesce(F.nullif(F.col("damage_type"), F.lit("")), F.lit("DAMAGE_TYPE_OTHER"))
    return ingest.encode_scans(t.scans.withColumn("damage_type", damage_type))


@check(
    "prj1_decode_scans",
    """select event_id, package_id, station, scanner_id, epoch_ms(scanned_at) scanned_at, result, damage_type,
      cast(cast(damage_confidence as real) as double) damage_confidence, item_id from scans""",
)
def _(t):
    return ingest.decode_scans(_wire(t))[0]


@check(
    "prj1_binary_scans",
    """select event_id, package_id, station, scanner_id, epoch_ms(scanned_at) scanned_at, result, damage_type,
      cast(cast(damage_confidence as real) as double) damage_confidence, item_id from scans""",
)
def _(t):
    return ingest.decode_scans(ingest.encode_scans(t.scans, "binary"), "binary")[0]


@check(
    "scl17_base64_of_the_wire",
    """select package_id as key, cast(substr(package_id, 5) as bigint) % 4 <> 0 decoded, count(*) records from scans group by 1, 2""",
)
def _(t):
    # The values of every fourth package are no base64.
    damaged = F.substring("key", 5, 20).cast("long") % 4 == 0
    wire = _wire(t).withColumn("value", F.when(damaged, F.concat(F.lit("%"), "value")).otherwise(F.col("value")))
    good, bad = ingest.decode_scans(wire)
    both = good.select(F.col("package_id").alias("key"), F.lit(True).alias("decoded")).unionByName(
        bad.select("key", F.lit(False).alias("decoded"))
    )
    return both.groupBy("key", "decoded").agg(F.count(F.lit(1)).alias("records"))


def _cut_wire(t):
    """Binary wire records, those of every fourth package one byte short."""
    wire = ingest.encode_scans(t.scans, "binary")
    whole = F.unbase64("value")
    cut = F.base64(F.substring(whole, F.lit(1), F.octet_length(whole) - 1))
    damaged = F.substring("key", 5, 20).cast("long") % 4 == 0
    return wire.withColumn("value", F.when(damaged, cut).otherwise(F.col("value")))


@check(
    "prj1_binary_quarantine",
    "select package_id as key, count(*) records from scans where cast(substr(package_id, 5) as bigint) % 4 = 0 group by 1",
)
def _(t):
    return ingest.decode_scans(_cut_wire(t), "binary")[1].groupBy("key").agg(F.count(F.lit(1)).alias("records"))


@check(
    "prj1_binary_neighbours_unharmed",
    "select event_id, station from scans where cast(substr(package_id, 5) as bigint) % 4 <> 0",
)
def _(t):
    return ingest.decode_scans(_cut_wire(t), "binary")[0].select("event_id", "station")


def _broken_wire(t):
    """Wire records in which those of unreadable scans are damaged beyond decoding."""
    wire = ingest.encode_scans(t.scans).withColumn("value", F.reverse("value"))
    bad = wire.join(t.scans.where("result = 'SCAN_RESULT_UNREADABLE'").select("package_id").distinct(),
                    F.col("key") == F.col("package_id"), "left_semi")
    good = ingest.encode_scans(t.scans).join(bad.select("key").distinct(), "key", "left_anti")
    return good.select("key", "value").unionByName(bad.select("key", "value"))


@check(
    "flt2_decoded_despite_bad_records",
    """select event_id, package_id, station from scans where package_id not in
      (select package_id from scans where result = 'SCAN_RESULT_UNREADABLE')""",
)
def _(t):
    return ingest.decode_scans(_broken_wire(t))[0].select("event_id", "package_id", "station")


@check(
    "flt2_quarantine",
    """select package_id as key, count(*) as records from scans where package_id in
      (select package_id from scans where result = 'SCAN_RESULT_UNREADABLE') group by 1""",
)
def _(t):
    return ingest.decode_scans(_broken_wire(t))[1].groupBy("key").agg(F.count(F.lit(1)).alias("records"))


@check("prj2_flatten_alerts", f"select {ALERT_COLUMNS} from alerts")
def _(t):
    return A.flatten_alerts(t.detected())


@check("prj2_binary_alerts", f"select {ALERT_COLUMNS} from alerts")
def _(t):
    return A.flatten_alerts(A.decode_alerts(A.encode_alerts(t.detected(), "binary"), "binary")[0])


@check(
    "prj3_resolved_station",
    "select alert_type, station, count(*) as alerts_raised from alerts group by 1, 2",
)
def _(t):
    return (
        t.detected()
        .select("alert_type", A.resolved_station().alias("station"))
        .groupBy("alert_type", "station")
        .agg(F.count(F.lit(1)).alias("alerts_raised"))
    )


@check(
    "prj4_nested_detail",
    """select alert_id, detected_ms detected_at,
      case when alert_type = 'ALERT_TYPE_STUCK_PACKAGE' then threshold_seconds end threshold_seconds,
      case when alert_type = 'ALERT_TYPE_DAMAGE' then damage_type end damage_type,
      case when alert_type = 'ALERT_TYPE_MISROUTING' then path_so_far end path_so_far
    from alerts""",
)
def _(t):
    return A.nest_alert_detail(t.alerts).select(
        "alert_id",
        "detected_at",
        "stuck_detail.threshold_seconds",
        "damage_detail.damage_type",
        "misrouting_detail.path_so_far",
    )


@check("prj5_alert_wire_round_trip", f"select {ALERT_COLUMNS} from alerts")
def _(t):
    return A.flatten_alerts(A.decode_alerts(A.encode_alerts(t.detected()))[0])


@check(
    "prj7_enum_names",
    """select event_id, case when damage_type = '' then 'DAMAGE_TYPE_UNSPECIFIED' else damage_type end damage_type,
      station, result from scans""",
)
def _(t):
    return t.scans.select(
        "event_id",
        S.enum_name(F.col("damage_type"), domain.DAMAGE_TYPES, "DAMAGE_TYPE_UNSPECIFIED").alias("damage_type"),
        S.enum_name(F.col("station"), domain.STATION_TYPES, "STATION_TYPE_UNSPECIFIED").alias("station"),
        S.enum_name(F.col("result"), domain.SCAN_RESULTS, "SCAN_RESULT_UNSPECIFIED").alias("result"),
    )


ROUTING_SQL = f"""
select event_id in_response_to_event_id, package_id,
  case when result = 'SCAN_RESULT_UNREADABLE' then 'ROUTING_ACTION_HOLD'
    when result = 'SCAN_RESULT_DAMAGE_DETECTED' then 'ROUTING_ACTION_FLAG_FOR_REVIEW'
    when station = 'STATION_TYPE_DISPATCH' then 'ROUTING_ACTION_HOLD'
    else 'ROUTING_ACTION_PROCEED' end as action,
  case when result = 'SCAN_RESULT_OK' and station <> 'STATION_TYPE_DISPATCH'
    then concat('lane-', substr(following, 14), '-1') else '' end next_lane_id,
  case when result = 'SCAN_RESULT_UNREADABLE' then 'STATION_TYPE_UNSPECIFIED' else following end next_station,
  case when result = 'SCAN_RESULT_UNREADABLE' then 'barcode unreadable, needs manual identification'
    when result = 'SCAN_RESULT_DAMAGE_DETECTED' then concat('damage detected: ', damage_type)
    when station = 'STATION_TYPE_DISPATCH' then 'package has reached final station' else '' end reason
from (select *, coalesce({ROUTE_LIST}[list_position({ROUTE_LIST}, station) + 1], 'STATION_TYPE_UNSPECIFIED')
  following from scans)"""


@check("prj8_routing_decisions", ROUTING_SQL)
def _(t):
    return ingest.route(t.scans, t.as_of).drop("issued_at")


@check(
    "prj10_position_updates",
    """select s.package_id, s.station, epoch_ms(s.scanned_at) updated_at, coalesce(i.name, '') item_name,
      coalesce(i.category, 'ITEM_CATEGORY_UNSPECIFIED') item_category,
      s.result = 'SCAN_RESULT_DAMAGE_DETECTED' damage_detected
    from scans s left join items i on i.item_id = s.item_id""",
)
def _(t):
    return ingest.position_updates(t.scans, t.items)


@check(
    "flt1_valid_scans",
    "select event_id, package_id, station, result from scans where item_id <> '' and result <> 'SCAN_RESULT_DAMAGE_DETECTED'",
)
def _(t):
    # Scans without an item lose their package id, damaged ones their event id.
    holes = t.scans.withColumn("package_id", F.when(F.col("item_id") != "", F.col("package_id")).otherwise(""))
    holes = holes.withColumn(
        "event_id", F.when(F.col("result") != "SCAN_RESULT_DAMAGE_DETECTED", F.col("event_id"))
    )
    return ingest.valid_scans(holes).select("event_id", "package_id", "station", "result")


# --- scalar functions --------------------------------------------------------------------------


@check(
    "scl1_start_of_hour",
    "select epoch_ms(date_trunc('hour', scanned_at)) as hour_at, count(*) n from scans group by 1",
)
def _(t):
    return t.scans.groupBy(S.start_of_hour("scanned_at").alias("hour_at")).agg(F.count(F.lit(1)).alias("n"))


@check(
    "scl2_date_parts",
    """select event_id, cast(cast(scanned_at as date) as varchar) scan_date, cast(hour(scanned_at) as int) scan_hour,
      strftime(scanned_at, '%Y%m%d') day_key, strftime(scanned_at, '%Y%m') month_key,
      cast(cast(scanned_at as date) - 7 as varchar) week_before,
      epoch_ms(scanned_at - interval '60' minute) hour_before
    from scans""",
)
def _(t):
    at = F.col("scanned_at")
    return t.scans.select(
        "event_id",
        F.to_date(at).alias("scan_date"),
        F.hour(at).alias("scan_hour"),
        F.date_format(at, "yyyyMMdd").alias("day_key"),
        F.date_format(at, "yyyyMM").alias("month_key"),
        F.date_sub(F.to_date(at), 7).alias("week_before"),
        (at - F.expr("INTERVAL 60 MINUTES")).alias("hour_before"),
    )


@check(
    "scl3_unix_millis",
    "select event_id, epoch_ms(scanned_at) scanned_ms, epoch_ms(scanned_at) scanned_at from scans",
)
def _(t):
    return t.scans.select("event_id", S.millis("scanned_at").alias("scanned_ms")).withColumn(
        "scanned_at", F.timestamp_millis("scanned_ms")
    )


@check(
    "scl4_partition_strings",
    "select event_id, strftime(scanned_at, '%Y-%m-%d') date_part, strftime(scanned_at, '%H') hour_part from scans",
)
def _(t):
    return t.scans.select(
        "event_id",
        S.partition_date("scanned_at").alias("date_part"),
        S.partition_hour("scanned_at").alias("hour_part"),
    )


@check(
    "scl5_safe_ratio",
    """select package_id, case when bad = 0 then cast(0 as double) else damaged / cast(bad as double) end ratio
    from (select package_id, count(*) filter (result <> 'SCAN_RESULT_OK') bad,
      count(*) filter (result = 'SCAN_RESULT_DAMAGE_DETECTED') damaged from scans group by 1)""",
)
def _(t):
    bad = F.count_if(F.col("result") != "SCAN_RESULT_OK")
    damaged = F.count_if(F.col("result") == "SCAN_RESULT_DAMAGE_DETECTED")
    counts = t.scans.groupBy("package_id").agg(bad.alias("bad"), damaged.alias("damaged"))
    return counts.select("package_id", S.safe_ratio(F.col("damaged"), F.col("bad")).alias("ratio"))


@check(
    "scl6_dwell",
    """select event_id, greatest(0, (select ms from as_of) - 86400000 - epoch_ms(scanned_at)) dwell_ms,
      cast(greatest(0, (select ms from as_of) - 86400000 - epoch_ms(scanned_at)) // 1000 as int) dwell_seconds
    from scans""",
)
def _(t):
    dwell_ms = S.dwell_ms("scanned_at", t.as_of - timedelta(days=1))
    return t.scans.select("event_id", dwell_ms.alias("dwell_ms")).withColumn(
        "dwell_seconds", S.floor_seconds(F.col("dwell_ms"))
    )


@check(
    "scl7_parcel_status",
    """select package_id, case when d >= 600000 then 'PARCEL_STATUS_STUCK' when d >= 300000
      then 'PARCEL_STATUS_DELAYED' else 'PARCEL_STATUS_IN_TRANSIT' end status
    from (select package_id, (select ms from as_of) - epoch_ms(updated_at) d from positions)""",
)
def _(t):
    return t.positions.select("package_id", S.parcel_status(S.dwell_ms("updated_at", t.as_of)).alias("status"))


@check(
    "scl8_lane_names",
    "select event_id, substr(station, 14) short_station, concat('lane-', substr(station, 14), '-1') lane from scans",
)
def _(t):
    station = F.col("station")
    return t.scans.select(
        "event_id", S.strip_prefix(station, "STATION_TYPE_").alias("short_station"), S.lane(station).alias("lane")
    )


@check(
    "scl9_labels",
    f"""select event_id, {label_case("station", domain.STATION_LABELS, "Unknown")} station_label,
      {label_case("damage_type", domain.DAMAGE_TYPE_LABELS, "Unspecified")} damage_label,
      {label_case("coalesce(category, '')", domain.ITEM_CATEGORY_LABELS, "Unknown")} category_label
    from scans s left join items i on i.item_id = s.item_id""",
)
def _(t):
    category = F.nullif(F.col("item_category"), F.lit("ITEM_CATEGORY_UNSPECIFIED"))
    return ingest.with_items(t.scans, t.items).select(
        "event_id",
        S.station_label(F.col("station")).alias("station_label"),
        S.damage_label(F.col("damage_type")).alias("damage_label"),
        S.category_label(category).alias("category_label"),
    )


@check(
    "scl9_alert_labels",
    f"""select alert_id, {label_case("alert_type", domain.ALERT_TYPE_LABELS, "Unknown")} issue_label,
      {label_case("severity", domain.SEVERITY_LABELS, "unspecified")} severity_label from alerts""",
)
def _(t):
    return t.alerts.select(
        "alert_id",
        S.alert_label(F.col("alert_type")).alias("issue_label"),
        S.severity_label(F.col("severity")).alias("severity_label"),
    )


@check("scl14_map_default", "select event_id, item_id, '' as missing from scans")
def _(t):
    events = ingest.encode_scans(t.scans).select(F.inline(ingest.wire_events()))
    return events.select(
        "event_id",
        S.attribute(F.col("attributes"), "item_id").alias("item_id"),
        S.attribute(F.col("attributes"), "no_such_key").alias("missing"),
    )


@check(
    "scl15_path_arrays",
    """select package_id, start_ms session_start, list_contains(path, 'STATION_TYPE_DISPATCH') has_dispatch,
      path[1] first_station, path[len(path)] last_station, cast(len(path) as int) path_length from sess""",
)
def _(t):
    return journeys.sessions(t.scans).select(
        "package_id",
        "session_start",
        F.array_contains("head", domain.DISPATCH).alias("has_dispatch"),
        F.get("head", F.lit(0)).alias("first_station"),
        F.element_at("head", -1).alias("last_station"),
        F.size("head").alias("path_length"),
    )


@check(
    "scl17_base64",
    "select event_id, to_base64(encode(event_id)) encoded, event_id decoded from scans",
)
def _(t):
    return t.scans.select("event_id", F.base64(F.col("event_id").cast("binary")).alias("encoded")).withColumn(
        "decoded", F.unbase64("encoded").cast("string")
    )
