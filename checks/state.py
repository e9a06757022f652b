"""Current state, joins, ordering and lists."""

from __future__ import annotations

from datetime import timedelta, timezone

from pyspark.sql import functions as F

from checks.oracle import ROUTE_LIST, label_case, severity_rank
from checks.registry import check
from parcelflow import domain
from parcelflow.functions import scalars as S
from parcelflow.operators import alerts as A
from parcelflow.operators import cases, floor, ingest, reports
from parcelflow.plans import api, pages
from parcelflow.sources import lake

SPINE = f"(select unnest({ROUTE_LIST}) station)"
POSITION_COLUMNS = "package_id, station, epoch_ms(updated_at) updated_at, item_name, item_category, damage_detected"


def _noon(t):
    """A busy moment: noon of the tenth day before the newest scan."""
    return (t.as_of - timedelta(days=10)).replace(hour=12, minute=0, second=0, microsecond=0)


NOON = "(date_trunc('day', (select t from as_of) - interval '10' day) + interval '12' hour)"


# --- positions and floor state -----------------------------------------------------------------


@check("agg14_current_positions", f"select {POSITION_COLUMNS} from positions")
def _(t):
    return floor.current_positions(t.scans, t.items)


@check("api5_list_positions", f"select {POSITION_COLUMNS} from positions")
def _(t):
    return api.list_positions(t.scans, t.items)


@check(
    "agg15_station_occupancy",
    f"""select s.station, count(p.package_id) packages from {SPINE} s
      left join positions p on p.station = s.station group by 1""",
)
def _(t):
    return floor.occupancy(t.positions)


@check(
    "agg15_occupancy_of_live_positions",
    f"""select s.station, count(p.package_id) packages from {SPINE} s left join positions p
      on p.station = s.station and p.updated_at >= (select t from as_of) - interval '30' minute group by 1""",
)
def _(t):
    return floor.occupancy(floor.evict_stale(t.positions, t.as_of))


@check(
    "flt10_evict_stale_positions",
    f"""select {POSITION_COLUMNS} from positions
      where updated_at >= (select t from as_of) - interval '30' minute""",
)
def _(t):
    return floor.evict_stale(t.positions, t.as_of)


# Positions as they were at NOON.
POSITIONS_THEN = f"""(select package_id, station, scanned_at updated_at from (
  select *, row_number() over (partition by package_id order by scanned_at desc, event_id desc) rn
  from scans where scanned_at <= {NOON}) where rn = 1)"""


@check(
    "agg14_positions_at_noon",
    f"select package_id, station, epoch_ms(updated_at) updated_at from {POSITIONS_THEN}",
)
def _(t):
    return floor.current_positions(t.scans, t.items, _noon(t)).select("package_id", "station", "updated_at")


@check(
    "agg16_kpis_at_noon",
    f"""select count(*) in_transit, count(*) filter (d >= 480000 and d < 600000) at_risk,
      count(*) filter (d >= 300000) as delayed
    from (select epoch_ms({NOON}) - epoch_ms(updated_at) d from positions where updated_at <= {NOON})""",
)
def _(t):
    return floor.kpis(t.positions, _noon(t))


@check(
    "agg17_station_kpis_at_noon",
    f"""select s.station, count(p.package_id) occupancy,
      count(*) filter (d >= 300000 and not (d >= 480000 and d < 600000)) as delayed,
      count(*) filter (d >= 480000 and d < 600000) at_risk
    from {SPINE} s left join
      (select *, epoch_ms({NOON}) - epoch_ms(updated_at) d from positions where updated_at <= {NOON}) p
      on p.station = s.station
    group by 1""",
)
def _(t):
    return floor.station_kpis(t.positions, _noon(t))


@check(
    "flt10_evict_stale_positions_at_noon",
    f"""select {POSITION_COLUMNS} from positions
      where updated_at between {NOON} - interval '30' minute and {NOON}""",
)
def _(t):
    return floor.evict_stale(t.positions, _noon(t))


@check(
    "agg16_kpis",
    """select count(*) in_transit, count(*) filter (d >= 480000 and d < 600000) at_risk,
      count(*) filter (d >= 300000) as delayed
    from (select (select ms from as_of) - epoch_ms(updated_at) d from positions)""",
)
def _(t):
    return floor.kpis(t.positions, t.as_of)


@check(
    "agg17_station_kpis",
    f"""select s.station, count(p.package_id) occupancy,
      count(*) filter (d >= 300000 and not (d >= 480000 and d < 600000)) as delayed,
      count(*) filter (d >= 480000 and d < 600000) at_risk
    from {SPINE} s left join
      (select *, (select ms from as_of) - epoch_ms(updated_at) d from positions) p on p.station = s.station
    group by 1""",
)
def _(t):
    return floor.station_kpis(t.positions, t.as_of)


@check(
    "agg18_station_alert_state",
    f"""select s.station, case coalesce(w, 0) when 3 then 'critical' when 2 then 'warning' else 'normal' end state
    from {SPINE} s left join (select station, max({severity_rank("severity")}) w from alerts
      where detected_ms between epoch_ms({NOON}) - 300000 and epoch_ms({NOON}) group by 1) a
      on a.station = s.station""",
)
def _(t):
    return A.station_alert_state(t.alerts, _noon(t))


@check(
    "agg19_worst_alert_per_package",
    f"""select package_id, alert_id, alert_type, severity, detected_ms detected_at from (
      select *, row_number() over (partition by package_id
        order by {severity_rank("severity")} desc, detected_ms desc, alert_id) rn from alerts) where rn = 1""",
)
def _(t):
    return A.worst_alerts(t.alerts)


@check(
    "agg20_journey_badges",
    """select package_id, case when bool_or(severity = 'SEVERITY_CRITICAL') then 'Flagged' else 'Warning' end badge
    from alerts where severity in ('SEVERITY_CRITICAL', 'SEVERITY_WARNING') group by 1""",
)
def _(t):
    return A.journey_badges(t.alerts)


@check(
    "agg21_live_damage_rate",
    f"""select case when n = 0 then cast(0 as double) else d / cast(n as double) end damage_rate, n sample_size
    from (select count(*) n, count(*) filter (result = 'SCAN_RESULT_DAMAGE_DETECTED') d from scans
      where scanned_at between {NOON} - interval '10' minute and {NOON})""",
)
def _(t):
    return floor.live_damage_rate(t.scans, _noon(t))


@check(
    "agg21_damage_rate_series",
    """select end_ms window_end, d / cast(n as double) damage_rate, n sample_size from (
      select end_ms, count(*) n, count(*) filter (result = 'SCAN_RESULT_DAMAGE_DETECTED') d from (
        select result, unnest(range(ms - ms % 15000 + 15000, ms - ms % 15000 + 600001, 15000)) end_ms
        from (select result, epoch_ms(scanned_at) ms from scans)) group by 1)""",
)
def _(t):
    return floor.damage_rate_series(t.scans)


QUEUE_SQL = """
select s.station, tick sampled_at, count(p.package_id) packages
from (select unnest({route}) station) s
cross join (select unnest(range({end} - 1800000, {end} + 1, 20000)) tick) k
left join (select package_id, station, epoch_ms(scanned_at) ms,
    lead(epoch_ms(scanned_at)) over (partition by package_id order by scanned_at, event_id) next_ms from scans) p
  on p.station = s.station and p.ms <= tick and (p.next_ms is null or p.next_ms > tick) {stale}
group by 1, 2"""


@check(
    "agg22_queue_depth",
    QUEUE_SQL.format(route=ROUTE_LIST, end=f"epoch_ms({NOON})", stale="and p.ms >= tick - 1800000"),
)
def _(t):
    return floor.queue_depth(t.scans, _noon(t))


@check(
    "agg22_queue_depth_from_pruned_lake",
    QUEUE_SQL.format(route=ROUTE_LIST, end=f"epoch_ms({NOON})", stale="and p.ms >= tick - 1800000"),
)
def _(t):
    noon = _noon(t)
    return floor.queue_depth(lake.read_lake_between(t.spark, t.lake_root, noon - timedelta(hours=1), noon), noon)


@check(
    "agg22_queue_depth_without_eviction",
    QUEUE_SQL.format(route=ROUTE_LIST, end=f"epoch_ms({NOON})", stale=""),
)
def _(t):
    return floor.queue_depth(t.scans, _noon(t), stale_ms=None)


# --- joins -------------------------------------------------------------------------------------


@check(
    "jn1_scans_with_category",
    """select event_id, coalesce(i.category, 'ITEM_CATEGORY_UNSPECIFIED') item_category
    from scans s left join items i on i.item_id = s.item_id""",
)
def _(t):
    return ingest.with_items(t.scans, t.items).select("event_id", "item_category")


@check(
    "jn2_scans_with_item",
    """select event_id, coalesce(i.name, '') item_name, coalesce(i.category, 'ITEM_CATEGORY_UNSPECIFIED') item_category
    from scans s left join items i on i.item_id = s.item_id""",
)
def _(t):
    return ingest.with_items(t.scans, t.items).select("event_id", "item_name", "item_category")


FLAGS_SQL = """
select p.package_id, concat_ws('>',
  max(case when a.alert_type = 'ALERT_TYPE_MISROUTING' then a.alert_type end),
  max(case when a.alert_type = 'ALERT_TYPE_DAMAGE' then a.alert_type end)) active_flags
from positions p left join (
  select package_id, alert_type, max(detected_ms) ms from alerts
  where alert_type in ('ALERT_TYPE_MISROUTING', 'ALERT_TYPE_DAMAGE') and detected_ms between {now} - {back} and {now}
  group by 1, 2) a on a.package_id = p.package_id and a.ms >= epoch_ms(p.updated_at)
group by 1"""
LATEST = "(select ms from as_of)"


@check("jn3_active_flags", FLAGS_SQL.format(back=30 * 86_400_000, now=LATEST))
def _(t):
    return cases.with_active_flags(t.positions, t.alerts, t.as_of, 30 * 86_400_000).select(
        "package_id", "active_flags"
    )


@check("jn3_active_flags_at_noon", FLAGS_SQL.format(back=30 * 86_400_000, now=f"epoch_ms({NOON})"))
def _(t):
    return cases.with_active_flags(t.positions, t.alerts, _noon(t), 30 * 86_400_000).select(
        "package_id", "active_flags"
    )


@check(
    "agg13_latest_flags",
    f"""select package_id, alert_type, max(detected_ms) detected_at from alerts
    where alert_type in ('ALERT_TYPE_MISROUTING', 'ALERT_TYPE_DAMAGE')
      and detected_ms between epoch_ms({NOON}) - 2592000000 and epoch_ms({NOON}) group by 1, 2""",
)
def _(t):
    return A.latest_flags(t.alerts, _noon(t), lookback_ms=30 * 86_400_000)


@check(
    "flt6_flag_alerts_in_lookback",
    f"""select package_id, alert_type, max(detected_ms) detected_at from alerts
    where alert_type in ('ALERT_TYPE_MISROUTING', 'ALERT_TYPE_DAMAGE')
      and detected_ms between epoch_ms({NOON}) - 3600000 and epoch_ms({NOON}) group by 1, 2""",
)
def _(t):
    return A.latest_flags(t.alerts, _noon(t))


@check(
    "jn5_live_over_seeded_alerts",
    f"""select alert_id, package_id, severity, message, detected_at from (
      select alert_id, package_id, severity, message, detected_ms detected_at from alerts
        where detected_at >= {NOON}
      union all
      select concat('seed-', package_id, '-', detected_ms), package_id, 'SEVERITY_WARNING',
        concat({label_case("alert_type", domain.ALERT_TYPE_LABELS, "Alert")}, ' at ',
          {label_case("station", domain.STATION_LABELS, "unknown station")}), detected_ms from alerts
        where detected_at < {NOON} and package_id not in (select package_id from alerts where detected_at >= {NOON}))""",
)
def _(t):
    noon = S.ts(_noon(t))
    live = t.alerts.where(F.col("detected_at") >= noon).select(
        "alert_id", "package_id", "alert_type", "severity", "station", "message", "detected_at"
    )
    seeded = cases.seed_alerts(t.alerts.where(F.col("detected_at") < noon))
    return cases.displayed_alerts(live, seeded).select(
        "alert_id", "package_id", "severity", "message", "detected_at"
    )


@check(
    "jn6_match_detailed_alert",
    """select initial_id, alert_type, detail_id, detail_at from (
      select concat('seed-', a.package_id, '-', a.detected_ms) initial_id, a.alert_type, b.alert_id detail_id,
        b.detected_ms detail_at, row_number() over (partition by a.package_id, a.alert_type, a.detected_ms
          order by b.detected_ms desc, b.alert_id) rn
      from alerts a join alerts b on a.package_id = b.package_id and a.alert_type = b.alert_type
        and abs(a.detected_ms - b.detected_ms) < 1000) where rn = 1""",
)
def _(t):
    return cases.match_detail(cases.seed_alerts(t.alerts), t.alerts)


@check(
    "jn7_scans_near_alerts",
    """select a.alert_id, a.detected_ms alert_at, s.event_id, s.station, epoch_ms(s.scanned_at) scanned_at
    from alerts a join scans s on s.package_id = a.package_id
      and abs(epoch_ms(s.scanned_at) - a.detected_ms) < 1800000""",
)
def _(t):
    near = cases.nearby_scans(
        t.alerts.withColumn("alert_id", F.concat_ws("|", "alert_id", S.millis("detected_at"))), t.scans
    )
    parts = F.split("alert_id", r"\|")
    return near.select(
        parts[0].alias("alert_id"), parts[1].cast("long").alias("alert_at"), "event_id", "station", "scanned_at"
    )


@check(
    "jn8_hours_of_day",
    """select cast(h as int) hour_of_day, coalesce(n, 0) alert_count from (select unnest(range(24)) h)
    left join (select hour(detected_at) hh, count(*) n from alerts
      group by 1) on hh = h""",
)
def _(t):
    return A.hours_of_day(A.busiest_hours(t.rollup))


@check(
    "jn9_trend_grid",
    """select epoch_ms(h.hour_at) as "hour", k.alert_type, coalesce(n, 0) alert_count
    from (select distinct hour_at from rollup) h cross join (select distinct alert_type from rollup) k
    left join (select hour_at, alert_type, cast(sum(alert_count) as bigint) n from rollup group by 1, 2) c
      on c.hour_at = h.hour_at and c.alert_type = k.alert_type""",
)
def _(t):
    return A.trend_grid(A.merge_rollup(t.rollup, "hour", "alert_type"))


@check(
    "jn10_alerts_with_item_names",
    """select a.alert_id, a.detected_ms detected_at,
      coalesce(nullif(p.item_name, ''), concat('Package ', substr(a.package_id, 1, 8))) item_name
    from alerts a left join positions p on p.package_id = a.package_id""",
)
def _(t):
    return cases.with_item_names(t.alerts, t.positions).select("alert_id", "detected_at", "item_name")


@check(
    "set1_timeline",
    """select package_id, 'scan' kind, epoch_ms(scanned_at) at_ms, event_id id, station, result what from scans
    union all select package_id, 'alert', detected_ms, alert_id, station, alert_type from alerts""",
)
def _(t):
    return cases.timeline(t.scans, t.alerts).withColumnRenamed("at", "at_ms")


@check(
    "set2_live_feed",
    """select package_id, epoch_ms(updated_at) at_ms, station position_station, null alert_id from positions
    union all select package_id, detected_ms, null, alert_id from alerts""",
)
def _(t):
    return cases.live_feed(t.positions, A.nest_alert_detail(t.alerts)).select(
        "package_id",
        F.col("at").alias("at_ms"),
        F.col("position_update.station").alias("position_station"),
        F.col("alert.alert_id").alias("alert_id"),
    )


@check("set4_trend_buckets", """select distinct epoch_ms(hour_at) as "hour" from rollup""")
def _(t):
    return A.trend_buckets(A.merge_rollup(t.rollup, "hour", "alert_type"))


# --- filters, orders and lists -----------------------------------------------------------------

PARCELS_SQL = """
select p.package_id, p.station current_station, epoch_ms(p.updated_at) last_scan_at,
  cast(((select ms from as_of) - epoch_ms(p.updated_at)) // 1000 as int) dwell_seconds,
  case when (select ms from as_of) - epoch_ms(p.updated_at) >= 600000 then 'PARCEL_STATUS_STUCK'
    when (select ms from as_of) - epoch_ms(p.updated_at) >= 300000 then 'PARCEL_STATUS_DELAYED'
    else 'PARCEL_STATUS_IN_TRANSIT' end status,
  f.active_flags, p.item_name, p.item_category
from positions p join ({flags}) f on f.package_id = p.package_id""".format(
    flags=FLAGS_SQL.format(back=3_600_000, now=LATEST)
)


@check("api4_parcel_summaries", PARCELS_SQL)
def _(t):
    return api.parcel_summaries(t.positions, t.alerts, t.as_of).drop("dwell_ms")


@check(
    "api4_list_parcels_longest_dwell",
    f"{PARCELS_SQL} order by epoch_ms(p.updated_at), p.package_id limit 50 offset 100",
)
def _(t):
    return api.list_parcels(t.positions, t.alerts, t.as_of, limit=50, offset=100, sort_desc=True).page


@check(
    "api4_list_parcels_default_page",
    f"{PARCELS_SQL} order by epoch_ms(p.updated_at) desc, p.package_id limit 200",
)
def _(t):
    return api.list_parcels(t.positions, t.alerts, t.as_of).page


@check(
    "api4_parcel_summaries_at_noon",
    f"""select package_id, cast((epoch_ms({NOON}) - epoch_ms(updated_at)) // 1000 as int) dwell_seconds
    from positions where updated_at <= {NOON}""",
)
def _(t):
    return api.parcel_summaries(t.positions, t.alerts, _noon(t)).select("package_id", "dwell_seconds")


@check(
    "api4_next_page_after_a_row",
    f"{PARCELS_SQL} order by epoch_ms(p.updated_at) desc, p.package_id limit 200 offset 50",
)
def _(t):
    positions = t.stored(t.positions, "positions")  # for both pages
    first = api.list_parcels_from(t.spark, t.warehouse_root, positions, t.as_of, limit=50, sort_field="detected_at", sort_desc=True)
    last = first.page.collect()[-1]  # one page of fifty rows
    after = (last["last_scan_at"].astimezone(timezone.utc), last["package_id"])
    return api.list_parcels_from(
        t.spark, t.warehouse_root, positions, t.as_of, sort_field="detected_at", sort_desc=True, after=after
    ).page


@check("ord3_list_parcels_by_package", f"{PARCELS_SQL} order by p.package_id desc limit 200")
def _(t):
    return api.list_parcels(
        t.positions, t.alerts, t.as_of, limit=1000, sort_field="package_id", sort_desc=True
    ).page


@check(
    "ord3_list_parcels_by_time",
    f"{PARCELS_SQL} order by epoch_ms(p.updated_at) desc, p.package_id limit 200",
)
def _(t):
    return api.list_parcels(t.positions, t.alerts, t.as_of, sort_field="detected_at", sort_desc=True).page


@check(
    "ord4_page_summary",
    """select count(*) total_count, 150 < count(*) has_more from positions
    where (select ms from as_of) - epoch_ms(updated_at) >= 600000""",
)
def _(t):
    return api.list_parcels(
        t.positions, t.alerts, t.as_of, status_filter=("PARCEL_STATUS_STUCK",), limit=50, offset=100
    ).summary


def _stored_order(t, **order):
    """The grid in its order, cut into forty ranges or so, and the number of all positions.

    The positions, a shuffle of all scans, are computed once and not for every count; a parcel has one summary.
    """
    positions = t.stored(t.positions, "positions")
    summaries, folder = api.parcel_summaries(positions, t.alerts, t.as_of), t.folder("order")
    known = floor.known_at(positions, t.as_of).count()
    pages.write_order(summaries, folder, rows_per_range=max(1, known // 40), **order)
    return summaries, folder, positions.count()


@check(
    "ord4_deep_page",
    f"""{PARCELS_SQL} order by epoch_ms(p.updated_at) desc, p.package_id
    limit 120 offset (select count(*) * 3 // 4 from positions)""",
)
def _(t):
    summaries, folder, n = _stored_order(t, sort_field="detected_at", sort_desc=True)
    return pages.read_page(summaries, folder, limit=120, offset=n * 3 // 4).page


@check(
    "ord4_deep_page_of_a_status",
    f"""select * from ({PARCELS_SQL}) where status = 'PARCEL_STATUS_STUCK' order by package_id
    limit 200 offset (select count(*) // 2 from positions)""",
)
def _(t):
    summaries, folder, n = _stored_order(t, sort_field="package_id")
    return pages.read_page(summaries, folder, ("PARCEL_STATUS_STUCK",), offset=n // 2).page


@check(
    "ord4_deep_page_summary",
    """select count(*) total_count, count(*) // 2 + 200 < count(*) has_more from positions""",
)
def _(t):
    summaries, folder, n = _stored_order(t)
    return pages.read_page(summaries, folder, offset=n // 2).summary


@check(
    "flt5_status_filter",
    f"""select * from ({PARCELS_SQL}) where status in ('PARCEL_STATUS_IN_TRANSIT', 'PARCEL_STATUS_DELAYED')
    order by last_scan_at desc, package_id limit 200""",
)
def _(t):
    return api.list_parcels(
        t.positions, t.alerts, t.as_of, status_filter=("PARCEL_STATUS_IN_TRANSIT", "PARCEL_STATUS_DELAYED")
    ).page


@check(
    "flt8_parcel_search",
    f"""select * from ({PARCELS_SQL}) where contains(lower(package_id), 'kg-12') or contains(lower(item_name), 'kg-12')
    order by last_scan_at desc, package_id limit 200""",
)
def _(t):
    return api.list_parcels(t.positions, t.alerts, t.as_of, search="  KG-12 ").page


FLAGGED_SQL = f"""
select package_id, alert_type, station, detected_ms detected_at, alert_id,
  {label_case("alert_type", {k: v for k, v in domain.ALERT_TYPE_LABELS.items()}, "")} issue_label,
  {label_case("station", domain.STATION_LABELS, "")} station_label from alerts"""


@check(
    "flt9_flagged_search",
    f"""select * from ({FLAGGED_SQL}) where contains(lower(package_id), 'sort') or contains(lower(issue_label), 'sort')
      or contains(lower(station_label), 'sort')""",
)
def _(t):
    rows = t.alerts.select("package_id", "alert_type", "station", "detected_at", "alert_id")
    return A.flagged_rows(rows, text=" Sort ", sort_key="station", descending=False)


def _placed(ordered, n: int = 300):
    """The first rows of an ordered frame with their place in it."""
    return ordered.limit(n).coalesce(1).withColumn("place", F.monotonically_increasing_id())


def _place_sql(rows: str, order: str, n: int = 300) -> str:
    return f"select *, row_number() over (order by {order}) - 1 place from ({rows}) order by {order} limit {n}"


FLAGGED_ORDERS = {"time": "detected_at", "station": "station_label", "issue": "issue_label"}
for _key, _column in FLAGGED_ORDERS.items():
    for _down in (True, False):

        @check(
            f"ord8_flagged_by_{_key}{'_down' if _down else ''}",
            "select place, {0} from ({1})".format(
                _column, _place_sql(FLAGGED_SQL, f"{_column} {'desc' if _down else 'asc'}, package_id, alert_type")
            ),
        )
        def _(t, key=_key, down=_down, column=_column):
            rows = t.alerts.select("package_id", "alert_type", "station", "detected_at", "alert_id")
            return _placed(A.flagged_rows(rows, sort_key=key, descending=down)).select("place", column)


@check(
    "ord6_newest_events",
    "select event_id, station, epoch_ms(scanned_at) scanned_at from scans order by scanned_at desc, event_id desc limit 500",
)
def _(t):
    return floor.newest_events(t.scans).select("event_id", "station", "scanned_at")


@check(
    "ord6_newest_alerts",
    "select alert_id, detected_ms detected_at from alerts order by detected_ms desc, alert_id limit 100",
)
def _(t):
    return A.newest_alerts(t.alerts).select("alert_id", "detected_at")


@check(
    "ord7_newest_alerts_per_station",
    """select station, cast(rn as int) as rank, alert_id, detected_ms detected_at from (
      select *, row_number() over (partition by station order by detected_ms desc, alert_id) rn from alerts)
    where rn <= 10""",
)
def _(t):
    return A.newest_alerts_per_station(t.alerts).select("station", "rank", "alert_id", "detected_at")


@check(
    "ord7_packages_per_station",
    """select station, cast(rn as int) as rank, package_id, total, greatest(total - 12, 0) overflow from (
      select *, row_number() over (partition by station order by updated_at desc, package_id) rn,
        count(*) over (partition by station) total from positions) where rn <= 12""",
)
def _(t):
    return floor.packages_per_station(t.positions).select("station", "rank", "package_id", "total", "overflow")


@check("ord1_scans_by_time", _place_sql("select event_id, package_id, epoch_ms(scanned_at) scanned_at from scans "
       "where package_id = (select package_id from scans group by 1 order by count(*) desc, 1 limit 1)", "scanned_at, event_id"))
def _(t):
    busiest = t.scans.groupBy("package_id").count().orderBy(F.desc("count"), "package_id").first()[0]
    journey = api.package_journey(t.scans, t.alerts, busiest).scans
    return _placed(journey).select("event_id", F.lit(busiest).alias("package_id"), "scanned_at", "place")


@check("ord2_alerts_newest_first", _place_sql("select alert_id, detected_ms detected_at from alerts "
       "where package_id = (select package_id from alerts group by 1 order by count(*) desc, 1 limit 1)", "detected_at desc, alert_id"))
def _(t):
    busiest = t.alerts.groupBy("package_id").count().orderBy(F.desc("count"), "package_id").first()[0]
    return _placed(api.package_journey(t.scans, t.alerts, busiest).alerts).select("alert_id", "detected_at", "place")


@check(
    "ord9_worst_categories",
    _place_sql("""select item_category, cast(sum(damage_count) as double) / cast(sum(scan_count) as double) damage_rate
    from by_category group by 1""", "damage_rate desc, item_category"),
)
def _(t):
    return _placed(reports.worst_categories(reports.damage_rate(t.by_category, "item_category")))
