"""SQL definitions of the intermediate results, for the comparison engine.

Written from the operator semantics with window functions, independently of the Spark plans.
"""

from __future__ import annotations

from parcelflow import domain
from parcelflow.sources import tables

ROUTE_LIST = "[" + ", ".join(f"'{s}'" for s in domain.ROUTE) + "]"


def label_case(column: str, labels: dict[str, str], default: str) -> str:
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in labels.items())
    return f"case {column} {arms} else '{default}' end"


def severity_rank(column: str) -> str:
    arms = " ".join(f"when '{s}' then {i}" for i, s in enumerate(domain.SEVERITIES))
    return f"case {column} {arms} else 0 end"


def sessions_sql(source: str, gap_ms: int) -> str:
    return f"""
select package_id, sno, min(ms) start_ms, max(ms) last_ms, count(*) scan_count,
  bool_or(station = 'STATION_TYPE_DISPATCH') reached, list(station order by pos) path,
  coalesce(min(case when pos <= 7 and station <> {ROUTE_LIST}[pos] then pos - 1 end), -1) dev
from (
  select *, row_number() over (partition by package_id, sno order by ms, event_id) pos
  from (
    select *, sum(case when prev_ms is null or ms - prev_ms > {gap_ms} then 1 else 0 end)
      over (partition by package_id order by ms, event_id) sno
    from (
      select package_id, event_id, station, epoch_ms(scanned_at) ms,
        lag(epoch_ms(scanned_at)) over (partition by package_id order by epoch_ms(scanned_at), event_id) prev_ms
      from {source})))
group by package_id, sno"""


def stuck_sql(source: str, threshold_ms: int, ooo_ms: int = 30_000) -> str:
    return f"""
select package_id, station, ms last_ms from (
  select package_id, station, epoch_ms(scanned_at) ms,
    lead(epoch_ms(scanned_at)) over (partition by package_id order by epoch_ms(scanned_at), event_id) next_ms
  from {source})
where (next_ms is null or next_ms - ms > {threshold_ms})
  and ms + {threshold_ms} <= (select max(epoch_ms(scanned_at)) from {source}) - {ooo_ms + 1}"""


# A view may use the views above it.
VIEWS = {
    "scans": tables.SCANS_SQL.format(lineitem="lineitem"),
    "items": tables.ITEMS_SQL.format(part="part"),
    "scans_events": tables.SCANS_EVENTS_SQL.format(events="events"),
    # Event times count in whole milliseconds.
    "scans_long": """
select event_id, package_id, station, date_trunc('milliseconds', scanned_at) scanned_at, result, item_id
from scans_events""",
    "as_of": "select max(scanned_at) t, max(epoch_ms(scanned_at)) ms from scans",
    "sess": sessions_sql("scans", 1_200_000),
    "verdict": f"""
select *, (dev <> -1 or not reached) misrouted,
  case when dev <> -1 then {ROUTE_LIST}[dev + 1] else 'STATION_TYPE_DISPATCH' end expected_station,
  case when dev <> -1 then path[dev + 1] else path[len(path)] end actual_station
from sess""",
    "misrouting": """
select concat('misrouting-', package_id) alert_id, package_id, 'ALERT_TYPE_MISROUTING' alert_type,
  case when reached then 'SEVERITY_WARNING' else 'SEVERITY_CRITICAL' end severity,
  actual_station station,
  concat('Package journey diverged from expected path: expected ', expected_station,
    ', observed path ends at ', actual_station) message,
  last_ms detected_ms, 0 stuck_duration_seconds, 0 threshold_seconds, expected_station, actual_station,
  array_to_string(path[1:1000], '>') path_so_far, '' damage_type, cast(0 as double) damage_confidence
from verdict where misrouted""",
    "stuck_point": stuck_sql("scans", 600_000),
    "stuck": """
select concat('stuck-', package_id, '-', last_ms + 600000) alert_id, package_id,
  'ALERT_TYPE_STUCK_PACKAGE' alert_type, 'SEVERITY_WARNING' severity, station,
  concat('Package stuck at ', station, ' for 10+ minutes with no further scan') message,
  last_ms + 600000 detected_ms, 600 stuck_duration_seconds, 600 threshold_seconds,
  '' expected_station, '' actual_station, '' path_so_far, '' damage_type,
  cast(0 as double) damage_confidence
from stuck_point""",
    "damage": """
select concat('damage-', event_id) alert_id, package_id, 'ALERT_TYPE_DAMAGE' alert_type,
  'SEVERITY_WARNING' severity, station,
  concat('Damage detected at ', station, ': ', damage_type) message,
  epoch_ms(scanned_at) detected_ms, 0 stuck_duration_seconds, 0 threshold_seconds,
  '' expected_station, '' actual_station, '' path_so_far, damage_type,
  cast(cast(damage_confidence as real) as double) damage_confidence
from scans where result = 'SCAN_RESULT_DAMAGE_DETECTED' and damage_confidence >= 0.75""",
    "alerts": """
select *, epoch_ms(detected_ms) detected_at from (
  select * from stuck union all select * from misrouting union all select * from damage)""",
    "positions": """
select s.package_id, s.station, s.scanned_at updated_at, coalesce(i.name, '') item_name,
  coalesce(i.category, 'ITEM_CATEGORY_UNSPECIFIED') item_category,
  s.result = 'SCAN_RESULT_DAMAGE_DETECTED' damage_detected
from (select *, row_number() over (partition by package_id order by scanned_at desc, event_id desc) rn
  from scans) s left join items i on i.item_id = s.item_id and s.item_id <> ''
where rn = 1""",
    "throughput": """
select cast(scanned_at as date) report_date, station, count(*) scan_count,
  count(distinct package_id) unique_packages,
  count(*) filter (result = 'SCAN_RESULT_DAMAGE_DETECTED') damage_count,
  count(*) filter (result = 'SCAN_RESULT_UNREADABLE') unreadable_count
from scans group by 1, 2""",
    "by_category": """
select *, damage_count / cast(scan_count as double) damage_rate from (
  select cast(scanned_at as date) report_date,
    coalesce(i.category, 'ITEM_CATEGORY_UNSPECIFIED') item_category, count(*) scan_count,
    count(*) filter (result = 'SCAN_RESULT_DAMAGE_DETECTED') damage_count
  from scans s left join items i on i.item_id = s.item_id group by 1, 2)""",
    "rollup": """
select date_trunc('hour', detected_at) as hour_at, alert_type, severity, station, count(*) alert_count
from alerts group by 1, 2, 3, 4""",
}
