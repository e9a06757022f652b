"""Scan, item and long-running-package views over the star-schema test tables.

Each view is one SQL text that Spark and any ANSI engine read alike. ``{lineitem}``, ``{part}``
and ``{events}`` stand for the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCANS_SQL = """
select event_id, package_id, station,
  concat('scanner-', lower(substr(station, 14))) scanner_id,
  scanned_at, result,
  case when result = 'SCAN_RESULT_DAMAGE_DETECTED' then dt else '' end damage_type,
  case when result = 'SCAN_RESULT_DAMAGE_DETECTED' then cast(conf as double)
    else cast(0.0 as double) end damage_confidence,
  item_id
from (
  select concat('evt-', cast(l_orderkey as varchar(20)), '-', cast(rn as varchar(20))) event_id,
    concat('pkg-', cast(l_orderkey as varchar(20))) package_id,
    case pos when 1 then 'STATION_TYPE_INTAKE' when 2 then 'STATION_TYPE_INDUCTION'
      when 3 then 'STATION_TYPE_SORT_A' when 4 then 'STATION_TYPE_SORT_B'
      when 5 then 'STATION_TYPE_QC_CHECK' when 6 then 'STATION_TYPE_STAGING'
      else 'STATION_TYPE_DISPATCH' end station,
    timestamp '2026-08-01 00:00:00' + interval '1' second * cast((l_orderkey % 28) * 86400
      + (l_orderkey % 1440) * 60 + rn * 180 + (l_partkey % 60)
      + case when l_suppkey % 20 = 0 then 1500 else 0 end as int) scanned_at,
    case when l_returnflag = 'R' and l_suppkey % 3 = 0 then 'SCAN_RESULT_DAMAGE_DETECTED'
      when l_partkey % 20 = 0 then 'SCAN_RESULT_UNREADABLE' else 'SCAN_RESULT_OK' end result,
    case l_partkey % 3 when 0 then 'DAMAGE_TYPE_CRUSHED' when 1 then 'DAMAGE_TYPE_TORN'
      else 'DAMAGE_TYPE_WET' end dt,
    0.7 + l_discount conf,
    case when l_partkey % 25 = 0 then '' else concat('item-', cast(l_partkey as varchar(20))) end item_id
  from (
    select l.*, case when l_orderkey % 3 = 0 then l_linenumber
      else cast(((rn - 1) % 7) + 1 as int) end pos
    from (
      select *, row_number() over (partition by l_orderkey
        order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) rn
      from {lineitem}) l))
"""

ITEMS_SQL = """
select concat('item-', cast(p_partkey as varchar(20))) item_id, p_name name,
  concat(substr(p_type, 1, 3), '-', cast(p_partkey as varchar(20))) sku,
  case p_type when 'ECONOMY' then 'ITEM_CATEGORY_GROCERY' when 'LARGE' then 'ITEM_CATEGORY_HOME_GOODS'
    when 'MEDIUM' then 'ITEM_CATEGORY_APPAREL' when 'PROMO' then 'ITEM_CATEGORY_TOYS'
    when 'SMALL' then 'ITEM_CATEGORY_ELECTRONICS' else 'ITEM_CATEGORY_BOOKS_MEDIA' end category,
  p_retailprice / 1000 unit_weight_kg, cast(p_size as bigint) stock_quantity
from {part} where p_partkey % 10 <> 3
"""

SCANS_EVENTS_SQL = """
select concat('evt-', cast(event_id as varchar(20))) event_id,
  concat('pkg-u', cast(user_id as varchar(20))) package_id,
  case event_id % 7 when 0 then 'STATION_TYPE_INTAKE' when 1 then 'STATION_TYPE_INDUCTION'
    when 2 then 'STATION_TYPE_SORT_A' when 3 then 'STATION_TYPE_SORT_B' when 4 then 'STATION_TYPE_QC_CHECK'
    when 5 then 'STATION_TYPE_STAGING' else 'STATION_TYPE_DISPATCH' end station,
  cast(ts as timestamp) scanned_at,
  case event_type when 'error' then 'SCAN_RESULT_UNREADABLE' when 'purchase' then 'SCAN_RESULT_DAMAGE_DETECTED'
    else 'SCAN_RESULT_OK' end result,
  concat('item-', replace(replace(props, '{{"k": ', ''), '}}', '')) item_id
from {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCANS_SQL, lineitem=table(spark, sf_dir, "lineitem"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ITEMS_SQL, part=table(spark, sf_dir, "part"))


def scans_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCANS_EVENTS_SQL, events=table(spark, sf_dir, "events"))
