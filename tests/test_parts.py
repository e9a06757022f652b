"""Commits of the stored tables: what readers see while writers, compactions and clean-ups meet."""

from __future__ import annotations

import threading
from datetime import date, timedelta
from pathlib import Path

import pytest

from parcelflow import domain
from parcelflow.functions.scalars import utc
from parcelflow.sources import lake, parts, warehouse

DAY = date(2026, 8, 1)
ROW = domain.T.StructType([domain.T.StructField("name", domain.T.StringType())])


def rows(spark, *names, day=DAY):
    return spark.createDataFrame([(n, day) for n in names], "name string, day date")


def add(spark, root, *names, **options):
    parts.append(rows(spark, *names), root, "t", "day", "name", **options)


def seen(spark, root):
    return sorted(r.name for r in parts.read(spark, root, "t", ROW, "day").collect())


@pytest.mark.parametrize("step", ["read_entries", "stage", "commit", "_load"])
def test_a_part_that_lands_at_any_step_of_a_compaction_is_seen_once(spark, tmp_path, monkeypatch, step):
    for when in ("before", "after"):
        root = str(tmp_path / f"{step}-{when}")
        add(spark, root, "a")
        add(spark, root, "b")
        plain, landed = getattr(parts, step), []

        def stepped(*args, when=when, plain=plain, root=root, landed=landed, **kwargs):
            def land():
                if not landed:
                    landed.append(True)
                    monkeypatch.setattr(parts, step, plain)
                    new = parts.stage(rows(spark, "c"), root, "t", "day")
                    # A lock held by the compaction's own commit would keep another process out of nothing.
                    monkeypatch.setattr(parts, "_PUBLISHING", threading.Lock())
                    parts.commit(spark, root, new)

            if when == "before":
                land()
            out = plain(*args, **kwargs)
            if when == "after":
                land()
            return out

        monkeypatch.setattr(parts, step, stepped)
        parts.compact(spark, root, "t", ROW, "day", DAY)
        monkeypatch.setattr(parts, step, plain)
        assert landed and seen(spark, root) == ["a", "b", "c"]
        parts.compact(spark, root, "t", ROW, "day", DAY)
        parts.clean(spark, root, {"t": "day"}, grace_ms=0)
        assert seen(spark, root) == ["a", "b", "c"]
        assert len(parts.load(spark, root).entries) == 1


def test_a_reader_keeps_its_snapshot_through_a_compaction(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, "a")
    add(spark, root, "b")
    reader = parts.read(spark, root, "t", ROW, "day")
    parts.compact(spark, root, "t", ROW, "day", DAY)
    parts.clean(spark, root, {"t": "day"})  # within the grace nothing goes
    assert sorted(r.name for r in reader.collect()) == ["a", "b"] == seen(spark, root)


def test_files_fall_after_compaction_and_clean_up(spark, tmp_path):
    root = str(tmp_path)
    for name in "abcde":
        add(spark, root, name)
    waiting = parts.stage(rows(spark, "later"), root, "t", "day")
    files = lambda: len(list(Path(root).rglob("*.parquet")))
    assert files() == 6
    parts.compact(spark, root, "t", ROW, "day", DAY)
    assert parts.clean(spark, root, {"t": "day"}, grace_ms=3_600_000) == 0
    parts.commit(spark, root, waiting)
    assert parts.clean(spark, root, {"t": "day"}, grace_ms=0) == 5
    assert files() == 2 and len(list(Path(root).glob("_snapshots/*.json"))) == 1
    assert seen(spark, root) == ["a", "b", "c", "d", "e", "later"]


def test_of_two_compactions_one_wins(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    add(spark, root, "a")
    add(spark, root, "b")
    plain = parts.commit

    def late(*args, **kwargs):
        monkeypatch.setattr(parts, "commit", plain)
        assert parts.compact(spark, root, "t", ROW, "day", DAY)
        return plain(*args, **kwargs)

    monkeypatch.setattr(parts, "commit", late)
    assert not parts.compact(spark, root, "t", ROW, "day", DAY)
    assert seen(spark, root) == ["a", "b"]


def test_a_repeated_batch_changes_nothing_even_after_a_compaction(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, "a", writer="w", batch_id=1)
    add(spark, root, "b", writer="v", batch_id=1)
    add(spark, root, "a", writer="w", batch_id=1)
    parts.compact(spark, root, "t", ROW, "day", DAY)
    add(spark, root, "a", writer="w", batch_id=1)
    add(spark, root, "c", writer="w", batch_id=2)
    assert seen(spark, root) == ["a", "b", "c"]


def test_writers_at_the_same_time_all_get_in(spark, tmp_path):
    root = str(tmp_path)
    staged = [parts.stage(rows(spark, f"n{k}"), root, "t", "day") for k in range(12)]
    threads = [threading.Thread(target=parts.commit, args=(spark, root, s)) for s in staged]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(seen(spark, root)) == 12 and parts.load(spark, root).version == 12


def test_empty_batches_and_tables(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root)
    assert seen(spark, root) == [] and parts.load(spark, root).entries == ()
    assert not parts.compact(spark, root, "t", ROW, "day", DAY)
    assert parts.clean(spark, f"{root}/none", {"t": "day"}) == 0


def test_alerts_and_counts_come_together(spark, tmp_path, monkeypatch):
    root, at = str(tmp_path), utc("2026-08-01 10:00:00")
    alert = spark.createDataFrame(
        [("a", "p", "ALERT_TYPE_STUCK_PACKAGE", "SEVERITY_WARNING", "m", "STATION_TYPE_SORT_A", at, None, None, None, {})], domain.ALERT
    )
    plain = parts.commit

    def fail(*args, **kwargs):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(parts, "commit", fail)
    with pytest.raises(RuntimeError):
        warehouse.append_alerts(alert, root, batch_id=1)
    assert warehouse.read_alerts(spark, root).count() == warehouse.read_rollup(spark, root).count() == 0
    monkeypatch.setattr(parts, "commit", plain)
    for _ in range(2):
        warehouse.append_alerts(alert, root, batch_id=1)
    assert warehouse.read_alerts(spark, root).count() == warehouse.read_rollup(spark, root).count() == 1
    for batch in range(2, 10):
        warehouse.append_alerts(alert, root, batch_id=batch)
    assert warehouse.compact_crowded_days(spark, root) == 1
    assert len(parts.load(spark, root).entries) == 2 and warehouse.read_rollup(spark, root).count() == 1
    # The parts of nine batches, and those of the lost attempt.
    assert warehouse.clean(spark, root, grace_ms=0) == 20


def test_one_package_opens_the_days_on_which_it_was_seen(spark, tmp_path):
    root, start = str(tmp_path), utc("2026-08-01 00:00:00")
    full = [
        (f"e{p}-{d}", f"p{p}", "STATION_TYPE_INTAKE", "s", start + timedelta(days=d, minutes=p), "SCAN_RESULT_OK", "", 0.0, "")
        for d in range(8) for p in range(40) if p == 0 or d == p % 8
    ]
    lake.write_lake(spark.createDataFrame(full, domain.LAKE_ROW), root)
    for d in range(8):
        assert lake.compact_day(spark, root, str((start + timedelta(days=d)).date()), buckets=4)
    own = lambda p: lake.read_package_scans(spark, root, p, buckets=4)
    assert len(own("p0").inputFiles()) == 8 and own("p0").count() == 8
    assert len(own("p3").inputFiles()) == 1 and [r.event_id for r in own("p3").collect()] == ["e3-3"]
    assert own("nobody").count() == 0
    # A late scan of another day is found although its part has no index yet, and indexed with the next compaction.
    late = ("late", "p3", "STATION_TYPE_SORT_A", "s", start + timedelta(days=6), "SCAN_RESULT_OK", "", 0.0, "")
    lake.write_lake(spark.createDataFrame([late], domain.LAKE_ROW), root)
    assert {r.event_id for r in own("p3").collect()} == {"e3-3", "late"}
    assert lake.compact_day(spark, root, "2026-08-07", buckets=4)
    assert len(own("p3").inputFiles()) == 2 and len(own("p5").inputFiles()) == 1
    lake.clean_lake(spark, root, grace_ms=0)
    assert own("p3").count() == 2 and lake.read_lake(spark, root).count() == len(full) + 1


def test_replay_reads_each_scan_once(spark, tmp_path):
    root, start = str(tmp_path / "lake"), utc("2026-08-01 00:00:00")
    for k in range(3):
        row = (f"e{k}", "p", "STATION_TYPE_INTAKE", "s", start + timedelta(hours=k), "SCAN_RESULT_OK", "", 0.0, "")
        lake.write_lake(spark.createDataFrame([row], domain.LAKE_ROW), root)
    lake.compact_day(spark, root, "2026-08-01", buckets=2)
    out = str(tmp_path / "out")
    query = lake.replay(spark, root).writeStream.format("parquet").option("path", out)
    query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).select("event_id").collect()) == ["e0", "e1", "e2"]
    with pytest.raises(FileNotFoundError):
        lake.replay(spark, str(tmp_path / "none"))
