"""Streaming operators, each run over a whole table as a file stream until it is caught up."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from checks.detection import ALERT_COLUMNS, HALF_DAY, SIX_HOURS
from checks.oracle import ROUTE_LIST, sessions_sql, stuck_sql
from checks.registry import check
from checks.stored import LAKE_COLUMNS
from parcelflow.functions import scalars as S
from parcelflow.operators import alerts as A
from parcelflow.operators import dwell, ingest
from parcelflow.sources import lake, stream, warehouse
from parcelflow.streaming import journeys, live, nearby, repair, stuck

NOW = {"availableNow": True}


def stream_check(name: str, sql: str):
    """Like ``check``. The number of state partitions is fixed by the first batch of a stream, with a
    state store each: these streams start with one per core at most."""

    def register(build):
        def run(t):
            setting, cores = "spark.sql.shuffle.partitions", t.spark.sparkContext.defaultParallelism
            before = t.spark.conf.get(setting)
            t.spark.conf.set(setting, str(min(int(before), cores)))
            try:
                return build(t)
            finally:
                t.spark.conf.set(setting, before)

        return check(name, sql)(run)

    return register


def files(t, df: DataFrame, name: str) -> DataFrame:
    """A table as a file stream."""
    path = t.folder(name)
    df.write.parquet(path)
    return t.spark.readStream.schema(df.schema).parquet(path)


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def collected(t, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream into Parquet and reads the result back."""
    out, checkpoint = t.folder(name), t.folder(f"{name}-checkpoint")
    if mode != "append":
        # Rows of an update stream, each of which comes once here.
        write = lambda batch, k: batch.write.parquet(f"{out}/batch={k}")
        finish(df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode).trigger(**NOW).start())
        return t.spark.read.schema(df.schema).parquet(out)
    writer = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    finish(writer.outputMode("append").trigger(**NOW).start())
    return t.spark.read.schema(df.schema).parquet(out)


def in_steps(t, parts: list[DataFrame], name: str, start) -> None:
    """Feeds a file stream part by part: ``start(stream, checkpoint)`` runs once after each, a restart every time."""
    inbox, checkpoint = t.folder(f"{name}-inbox"), t.folder(f"{name}-checkpoint")
    for part in parts:
        part.write.mode("append").parquet(inbox)
        finish(start(t.spark.readStream.schema(part.schema).parquet(inbox), checkpoint))


def scan_stream(t) -> DataFrame:
    return files(t, lake.lake_rows(t.scans).drop("date", "hour"), "scan-files")


def long_stream(t) -> DataFrame:
    return files(t, t.scans_events, "long-scan-files")


def alert_wire_stream(t) -> DataFrame:
    return files(t, A.encode_alerts(t.detected()), "alert-wire")


@stream_check("src1_scan_stream_from_wire", f"select {LAKE_COLUMNS} from scans")
def _(t):
    path = t.folder("wire")
    stream.publish(ingest.encode_scans(t.scans), fmt="parquet", path=path)
    scans = stream.read_scan_stream(t.spark, fmt="parquet", path=path)
    return collected(t, scans, "decoded")


@stream_check("src1_scan_stream_from_binary_wire", f"select {LAKE_COLUMNS} from scans")
def _(t):
    path = t.folder("binary-wire")
    stream.publish(ingest.encode_scans(t.scans, "binary"), fmt="parquet", path=path)
    scans = stream.read_scan_stream(t.spark, fmt="parquet", payload={"fmt": "binary"}, path=path)
    return collected(t, scans, "binary-decoded")


@stream_check("snk1_published_scans", "select package_id as key, count(*) as records from scans group by 1")
def _(t):
    path = t.folder("published")
    stream.publish(ingest.encode_scans(t.scans), fmt="parquet", path=path)
    return t.spark.read.schema(stream.WIRE).parquet(path).groupBy("key").agg(F.count(F.lit(1)).alias("records"))


@stream_check("snk2_published_alerts", f"select {ALERT_COLUMNS} from alerts")
def _(t):
    nested, _ = A.decode_alerts(alert_wire_stream(t))
    out = t.folder("alert-topic")
    finish(
        stream.start_publish(
            A.encode_alerts(nested), t.folder("alert-topic-checkpoint"), fmt="parquet", trigger=NOW, path=out
        )
    )
    return A.flatten_alerts(A.decode_alerts(t.spark.read.schema(stream.WIRE).parquet(out))[0])


@stream_check(
    "snk3_lake_stream_with_restart",
    f"""select {LAKE_COLUMNS}, cast(cast(scanned_at as date) as varchar) as "date",
      cast(hour(scanned_at) as int) as "hour" from scans""",
)
def _(t):
    rows = lake.lake_rows(t.scans).drop("date", "hour")
    inbox, root, checkpoint = t.folder("inbox"), t.folder("stream-lake"), t.folder("stream-lake-checkpoint")
    middle = F.lit("2026-08-15").cast("timestamp")
    for part in (rows.where(F.col("scanned_at") < middle), rows.where(F.col("scanned_at") >= middle)):
        part.write.mode("append").parquet(inbox)
        # Each run is a restart from the same checkpoint.
        finish(stream.start_lake_stream(stream.read_scan_table_stream(t.spark, inbox), root, checkpoint, NOW))
    return lake.read_lake(t.spark, root)


@stream_check("snk4_alert_loader_stream", f"select {ALERT_COLUMNS} from alerts")
def _(t):
    root = t.folder("loaded")
    nested, _ = A.decode_alerts(alert_wire_stream(t))
    finish(live.start_alert_loader(nested, root, t.folder("loader-checkpoint"), NOW))
    return warehouse.read_alerts(t.spark, root).drop("inserted_at")


@stream_check("snk4_two_loaders_with_restart", f"select {ALERT_COLUMNS} from alerts")
def _(t):
    root = t.folder("two-loaders")
    nested = A.decode_alerts(t.stored(A.encode_alerts(t.detected()), "loaders-wire"))[0]
    for kinds in (["ALERT_TYPE_STUCK_PACKAGE"], ["ALERT_TYPE_MISROUTING", "ALERT_TYPE_DAMAGE"]):
        own = nested.where(F.col("alert_type").isin(*kinds))
        parts = [own.where(f"pmod(xxhash64(alert_id), 2) = {k}") for k in (0, 1)]
        in_steps(t, parts, f"loader-{kinds[0]}", lambda s, c: live.start_alert_loader(s, root, c, NOW))
    return warehouse.read_alerts(t.spark, root).drop("inserted_at")


@stream_check(
    "str7_incremental_rollup",
    """select epoch_ms(hour_at) as "hour", alert_type, severity, station, alert_count from rollup""",
)
def _(t):
    root, checkpoint, inbox = t.folder("rolled"), t.folder("rolled-checkpoint"), t.folder("rolled-inbox")
    wire = t.stored(A.encode_alerts(t.detected()), "rolled-wire")
    for kind in ("stuck-", "misrouting-", "damage-"):
        # Three runs, one detector each, add their partial counts to the same table.
        part = A.decode_alerts(wire)[0].where(F.col("alert_id").startswith(kind))
        A.encode_alerts(part).write.mode("append").parquet(inbox)
        nested, _ = A.decode_alerts(stream.read_wire_stream(t.spark, fmt="parquet", path=inbox))
        finish(live.start_alert_loader(nested, root, checkpoint, NOW))
    return A.merge_rollup(warehouse.read_rollup(t.spark, root), "hour", "alert_type", "severity", "station")


@stream_check(
    "str4_stuck_stream",
    f"""select concat('stuck-', package_id, '-', last_ms + {SIX_HOURS}) alert_id, package_id, station,
      last_ms + {SIX_HOURS} detected_at, 21600 stuck_duration_seconds
    from ({stuck_sql("scans_long", SIX_HOURS, ooo_ms=-SIX_HOURS)})
    where last_ms + {SIX_HOURS} - (last_ms + {SIX_HOURS}) % 60000 + 60000
      <= (select max(epoch_ms(scanned_at)) from scans_long) - 30000""",
)
def _(t):
    found = collected(t, stuck.stuck_stream(long_stream(t), SIX_HOURS), "stuck")
    return A.flatten_alerts(found).select(
        "alert_id", "package_id", "station", "detected_at", "stuck_duration_seconds"
    )


def _closed_sql(gap_ms: int) -> str:
    return f"""
select package_id, case when reached then 'SEVERITY_WARNING' else 'SEVERITY_CRITICAL' end severity,
  case when dev <> -1 then {ROUTE_LIST}[dev + 1] else 'STATION_TYPE_DISPATCH' end expected_station,
  case when dev <> -1 then path[dev + 1] else path[len(path)] end actual_station,
  array_to_string(path[1:1000], '>') path_so_far, last_ms detected_at
from ({sessions_sql("scans_long", gap_ms)})
where (dev <> -1 or not reached)
  and last_ms + {gap_ms} <= (select max(epoch_ms(scanned_at)) from scans_long) - 30000"""


JOURNEY_COLUMNS = ["package_id", "severity", "expected_station", "actual_station", "path_so_far", "detected_at"]


@stream_check("str5_journey_stream", _closed_sql(HALF_DAY))
def _(t):
    found = collected(t, journeys.journey_stream(long_stream(t), gap_ms=HALF_DAY), "journeys")
    return A.flatten_alerts(found).select(*JOURNEY_COLUMNS)


# Lateness covers the whole month, so every late scan makes its session fire again.
def _judged_sql(source: str) -> str:
    return f"""select package_id, severity, path_so_far, detected_at from (
      {_closed_sql(HALF_DAY).replace("scans_long", source)})"""


@stream_check(
    "str6_journey_stream_refire",
    f"""select * from ({_judged_sql("(select * from scans_long where cast(substr(event_id, 5) as bigint) % 25 <> 0)")})
    union select * from ({_judged_sql("scans_long")})""",
)
def _(t):
    root = t.folder("refire")
    rows = t.scans_events
    late = F.substring("event_id", 5, 20).cast("long") % 25 == 0
    month = 40 * 86_400_000
    in_steps(
        t,
        [rows.where(~late), rows.where(late)],
        "refire",
        lambda s, c: live.start_journeys(s, root, c, NOW, gap_ms=HALF_DAY, lateness_ms=month),
    )
    columns = ["package_id", "severity", "path_so_far", "detected_at"]
    return warehouse.read_alerts(t.spark, root).select(*columns).distinct()


@stream_check(
    "str8_position_table",
    """select package_id, station, epoch_ms(updated_at) updated_at, item_name, item_category, damage_detected
    from positions""",
)
def _(t):
    root = t.folder("positions")
    rows = lake.lake_rows(t.scans).drop("date", "hour")
    middle = F.lit("2026-08-15").cast("timestamp")
    # The newer half arrives first: scans of the older half are days late.
    parts = [rows.where(F.col("scanned_at") >= middle), rows.where(F.col("scanned_at") < middle)]
    in_steps(t, parts, "positions", lambda s, c: live.start_positions(s, t.items, root, c, NOW))
    live.compact_positions(t.spark, root)
    return live.positions_snapshot(t.spark, root)


@stream_check(
    "src2_stream_from_now",
    f"select {LAKE_COLUMNS} from scans where scanned_at >= timestamp '2026-08-15 00:00:00'",
)
def _(t):
    path, marker, checkpoint, out = (t.folder(f"now-{x}") for x in ("wire", "marker", "checkpoint", "out"))
    middle, late = (F.lit(f"2026-08-{day}").cast("timestamp") for day in (15, 22))
    at = F.col("scanned_at")

    def run():
        scans = stream.read_scan_stream(t.spark, "parquet", "latest", {"fmt": "binary"}, f"{marker}/start", path=path)
        writer = scans.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        finish(writer.trigger(**NOW).start())

    for part in (t.scans.where(at < middle), t.scans.where((at >= middle) & (at < late)), t.scans.where(at >= late)):
        # Started when the first part was there; the last part comes after a restart.
        stream.publish(ingest.encode_scans(part, "binary"), fmt="parquet", path=path)
        run()
    return t.spark.read.schema(lake.PARTITIONED).parquet(out).drop("date", "hour")


@stream_check(
    "api6_subscriber_in_the_middle",
    """select 'snapshot' kind, package_id, station, epoch_ms(updated_at) updated_at from (
      select package_id, station, scanned_at updated_at,
        row_number() over (partition by package_id order by scanned_at desc, event_id desc) rn
      from scans where scanned_at < timestamp '2026-08-20 00:00:00') where rn = 1
    union all
    select 'update', package_id, station, epoch_ms(scanned_at) from scans
    where scanned_at >= timestamp '2026-08-20 00:00:00'""",
)
def _(t):
    root, inbox, marker = t.folder("subscribed"), t.folder("subscribed-inbox"), t.folder("subscribed-marker")
    rows, at = lake.lake_rows(t.scans).drop("date", "hour"), F.col("scanned_at")
    middle, joined = (F.lit(f"2026-08-{day}").cast("timestamp") for day in (10, 20))

    def arrive(part):
        part.write.mode("append").parquet(inbox)

    def keep():
        scans = stream.read_scan_table_stream(t.spark, inbox)
        finish(live.start_positions(scans, t.items, root, f"{marker}-positions", NOW))

    arrive(rows.where(at < middle))
    keep()
    scans = stream.read_scan_table_stream(t.spark, inbox, f"{marker}/start")
    # These scans are in the snapshot and in the subscriber's stream.
    arrive(rows.where((at >= middle) & (at < joined)))
    keep()
    snapshot, updates = live.subscribe(scans, t.items, root)
    snapshot = snapshot.select(F.lit("snapshot").alias("kind"), "package_id", "station", "updated_at")
    arrive(rows.where(at >= joined))
    keep()
    return snapshot.unionByName(collected(t, updates, "updates", "update").select(F.lit("update").alias("kind"), "package_id", "station", "updated_at"))


@stream_check(
    "snk8_late_scans",
    """select event_id, package_id, station, epoch_ms(scanned_at) scanned_at from scans
    where cast(substr(package_id, 5) as bigint) % 40 = 7 and scanned_at < (select t from as_of) - interval '1' day""",
)
def _(t):
    root = t.folder("late")
    rows = lake.lake_rows(t.scans).drop("date", "hour")
    # Whole packages come late, so none of their scans can join an open session.
    late = F.substring("package_id", 5, 20).cast("long") % 40 == 7
    old = F.col("scanned_at") < S.ts(t.as_of - timedelta(days=1))
    parts = [rows.where(~late), rows.where(late & old)]
    in_steps(t, parts, "journeys", lambda s, c: live.start_journeys(s, root, c, NOW))
    return live.read_late_scans(t.spark, root)


@stream_check("str4_stuck_alerts_repaired", "select package_id, station, last_ms + 600000 detected_at from stuck_point")
def _(t):
    root = t.folder("repaired")
    rows = lake.lake_rows(t.scans).drop("date", "hour")
    middle = F.lit("2026-08-15").cast("timestamp")
    parts = [rows.where(F.col("scanned_at") >= middle), rows.where(F.col("scanned_at") < middle)]

    def start(scans, checkpoint):
        return live.start_alert_loader(stuck.stuck_stream(scans), root, checkpoint, NOW)

    in_steps(t, parts, "stuck", start)
    # The older half came too late for the stream; the lake has it, and the batch detector adds what is missing.
    stored = warehouse.read_alerts(t.spark, root)
    found = dwell.stuck_alerts(lake.read_lake(t.spark, t.lake_root))
    warehouse.append_alerts(A.missing_alerts(found, stored), root, inserted_at=t.as_of)
    return warehouse.read_alerts(t.spark, root).select("package_id", "station", "detected_at")


def _repaired(t):
    """A lake and alerts of four fifths of the scans; the others come late, in two batches."""
    if not hasattr(t, "repaired"):
        root, lake_root = t.folder("followed-up"), t.folder("followed-up-lake")
        rows = lake.lake_rows(t.scans).drop("date", "hour")
        part = F.pmod(F.xxhash64("event_id"), F.lit(10))
        late = (part < 2) & (F.col("scanned_at") < S.ts(t.as_of - timedelta(days=1)))

        def start(scans, checkpoint):
            return repair.start_lake_with_repair(scans, lake_root, root, checkpoint, NOW)

        warehouse.append_alerts(dwell.stuck_alerts(rows.where(~late)), root, inserted_at=t.as_of)
        in_steps(t, [rows.where(~late), rows.where(late & (part == 0)), rows.where(late & (part == 1))], "follow-up", start)
        t.repaired = root
    return t.repaired


@stream_check("str4_alerts_followed_up_for_late_scans", "select package_id, station, last_ms + 600000 detected_at from stuck_point")
def _(t):
    return repair.standing_alerts(t.spark, _repaired(t)).select("package_id", "station", "detected_at")


@stream_check(
    "str11_replay_lake_through_detector",
    """select package_id, station, last_ms + 600000 detected_at from stuck_point
    where last_ms + 600000 - (last_ms + 600000) % 60000 + 60000 <= (select ms from as_of) - 30000""",
)
def _(t):
    scans = lake.replay(t.spark, t.lake_root)
    found = collected(t, stuck.stuck_stream(scans), "replayed")
    return A.flatten_alerts(found).select("package_id", "station", "detected_at")


@stream_check("str9_dedup_keeps_late_scans", f"select {LAKE_COLUMNS} from scans")
def _(t):
    rows = lake.lake_rows(t.scans).drop("date", "hour")
    middle = F.lit("2026-08-15").cast("timestamp")
    resent = rows.where("result <> 'SCAN_RESULT_OK'")
    newer, older = rows.where(F.col("scanned_at") >= middle), rows.where(F.col("scanned_at") < middle)
    out = t.folder("deduplicated")

    def start(scans, checkpoint):
        writer = live.dedup(scans, keep_ms=60 * 86_400_000).writeStream.format("parquet").option("path", out)
        return writer.option("checkpointLocation", checkpoint).trigger(**NOW).start()

    in_steps(t, [newer.unionByName(resent), older.unionByName(resent)], "resent", start)
    return t.spark.read.schema(rows.schema).parquet(out)


@stream_check(
    "str12_damage_rate_stream",
    """select end_ms window_end, d / cast(n as double) damage_rate, n sample_size from (
      select end_ms, count(*) n, count(*) filter (result = 'SCAN_RESULT_DAMAGE_DETECTED') d from (
        select result, unnest(range(ms - ms % 15000 + 15000, ms - ms % 15000 + 600001, 15000)) end_ms
        from (select result, epoch_ms(scanned_at) ms from scans)) group by 1)
    where end_ms <= (select ms from as_of) - 30000""",
)
def _(t):
    return collected(t, live.damage_rate_stream(scan_stream(t)), "damage-rate")


@stream_check(
    "str12_damage_rate_with_late_scans",
    """select end_ms window_end, d / cast(n as double) damage_rate, n sample_size from (
      select end_ms, count(*) n, count(*) filter (result = 'SCAN_RESULT_DAMAGE_DETECTED') d from (
        select result, unnest(range(ms - ms % 15000 + 15000, ms - ms % 15000 + 600001, 15000)) end_ms
        from (select result, epoch_ms(scanned_at) ms from scans)) group by 1)""",
)
def _(t):
    root = t.folder("damage-steps")
    rows, middle = lake.lake_rows(t.scans).drop("date", "hour"), F.lit("2026-08-15").cast("timestamp")
    # Two weeks late, and every seventh scan later still.
    last = F.pmod(F.xxhash64("event_id"), F.lit(7)) == 0
    older = F.col("scanned_at") < middle
    in_steps(
        t,
        [rows.where(~older & ~last), rows.where(older & ~last), rows.where(last)],
        "damage-steps",
        lambda s, c: live.start_damage_steps(s, root, c, NOW),
    )
    live.compact_damage_steps(t.spark, root, date(2026, 8, 10))
    warehouse.clean(t.spark, root, grace_ms=0)
    return live.damage_rates(t.spark, root)


def _hourly(t, parts: list[DataFrame], name: str) -> DataFrame:
    """Scans per hour of event time, from a stream that is fed part by part."""
    out = t.folder(name)

    def start(scans, checkpoint):
        hours = live.with_event_time(scans).groupBy(F.window("scanned_at", "1 hour")).agg(F.count(F.lit(1)).alias("scan_count"))
        rows = hours.select(F.col("window.start").alias("hour"), "scan_count")
        return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(**NOW).start()

    in_steps(t, parts, name, start)
    return t.spark.read.schema("hour timestamp, scan_count long").parquet(out)


HOURLY_SQL = """select epoch_ms(h) as "hour", n scan_count from (
  select date_trunc('hour', scanned_at) h, count(*) n from scans {where} group by 1)
where h + interval '1' hour <= (select t from as_of) - interval '30' second"""


@stream_check("prj6_event_time_whatever_the_arrival", HOURLY_SQL.format(where=""))
def _(t):
    # All scans arrive together and in no order of time: only their own time counts.
    return _hourly(t, [lake.lake_rows(t.scans).drop("date", "hour").repartition(8, F.xxhash64("event_id"))], "event-time")


@stream_check(
    "str1_rows_behind_the_watermark_are_dropped", HOURLY_SQL.format(where="where scanned_at >= timestamp '2026-08-15 00:00:00'")
)
def _(t):
    rows, middle = lake.lake_rows(t.scans).drop("date", "hour"), F.lit("2026-08-15").cast("timestamp")
    # The older half comes after the newer one has moved the watermark.
    return _hourly(t, [rows.where(F.col("scanned_at") >= middle), rows.where(F.col("scanned_at") < middle)], "watermark")


@stream_check(
    "set2_live_feed_stream",
    """select package_id, epoch_ms(scanned_at) at_ms, station position_station, null alert_id from scans
    union all select package_id, detected_ms, null, alert_id from alerts""",
)
def _(t):
    nested, _ = A.decode_alerts(alert_wire_stream(t))
    feed = live.live_feed_stream(scan_stream(t), t.items, nested)
    return collected(t, feed, "feed").select(
        "package_id",
        F.col("at").alias("at_ms"),
        F.col("position_update.station").alias("position_station"),
        F.col("alert.alert_id").alias("alert_id"),
    )


@stream_check(
    "jn7_interval_join_of_streams",
    """select a.alert_id, s.event_id, s.station, epoch_ms(s.scanned_at) scanned_at
    from alerts a join scans s on s.package_id = a.package_id
      and abs(epoch_ms(s.scanned_at) - a.detected_ms) < 1800000""",
)
def _(t):
    nested, _ = A.decode_alerts(alert_wire_stream(t))
    near = live.nearby_scan_stream(nested, scan_stream(t))
    return collected(t, near, "near").drop("package_id")


@stream_check(
    "jn7_interval_join_with_late_rows",
    """select a.alert_id, s.event_id, s.station, epoch_ms(s.scanned_at) scanned_at,
      s.scanned_at < timestamp '2026-08-15 00:00:00' late
    from alerts a join scans s on s.package_id = a.package_id
      and abs(epoch_ms(s.scanned_at) - a.detected_ms) < 1800000""",
)
def _(t):
    nested, _ = A.decode_alerts(alert_wire_stream(t))
    rows, middle = lake.lake_rows(t.scans).drop("date", "hour"), F.lit("2026-08-15").cast("timestamp")
    root = t.folder("nearby")
    # All alerts and the newer half of the scans come first, the older half far behind them.
    steps = [rows.where(F.col("scanned_at") >= middle), rows.where(F.col("scanned_at") < middle)]
    in_steps(t, steps, "nearby-scans", lambda s, c: nearby.start_nearby(nested, s, root, c, NOW))
    return nearby.read_nearby(t.spark, root).drop("package_id")
