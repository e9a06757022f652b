"""Clients that join in the middle: the snapshot, and a stream of what is newer."""

from __future__ import annotations

from pyspark.sql import Row

from parcelflow.functions.scalars import to_millis
from parcelflow.streaming import live
from tests.helpers import BASE, SCHEMA, frame, scan

NOW = {"availableNow": True}


class _List:
    """A list state that counts its calls."""

    def __init__(self):
        self.rows, self.calls = [], 0

    def get(self):
        self.calls += 1
        return iter(self.rows)

    def put(self, rows):
        self.calls += 1
        self.rows = list(rows)

    def appendValue(self, row):
        self.calls += 1
        self.rows.append(row)


class _Handle:
    def __init__(self):
        self.state = _List()

    def getListState(self, name, schema):
        return self.state


def _version(package, at_ms, event_id):
    rest = dict.fromkeys(n for n in live.POSITION_VERSION.names if n not in ("package_id", "event_id"))
    return Row(package_id=package, at_ms=at_ms, event_id=event_id, **rest)


def _changed(step, *rows):
    return [(r.package_id, r.event_id) for r in step.handleInputRows((0,), iter(rows), None)]


def test_a_group_of_packages_costs_two_calls_into_the_state_store():
    # Two or three calls for each package took most of the time of a large table.
    handle, step = _Handle(), live._Changes()
    step.init(handle)
    rows = [_version(f"p{k}", k, f"e{k}") for k in range(500)]
    assert len(_changed(step, *rows)) == 500 and handle.state.calls == 2
    assert _changed(step, *rows) == [] and handle.state.calls == 3


def test_known_versions_are_written_anew_and_stay_known():
    handle, step = _Handle(), live._Changes()
    step.init(handle)
    step.handleInitialState((0,), Row(package_ids=["p", "q"], at_ms=[5, 5], event_ids=["b", "b"]), None)
    assert _changed(step, _version("p", 5, "c"), _version("p", 5, "a"), _version("q", 4, "z")) == [("p", "c")]
    assert len(handle.state.rows) == 2
    # In order, each of them, and a package that is new.
    assert _changed(step, _version("p", 9, "a"), _version("p", 6, "a"), _version("r", 1, "a")) == [
        ("r", "a"), ("p", "a"), ("p", "a"),
    ]
    assert _changed(step, _version("p", 10, "a"), _version("q", 6, "a")) == [("q", "a"), ("p", "a")]
    # More than twice the three packages: one element.
    assert len(handle.state.rows) == 1
    assert _changed(step, _version("p", 9, "z"), _version("q", 6, "a"), _version("r", 1, "a")) == []


def test_versions_without_a_time_or_an_id_are_the_oldest():
    handle, step = _Handle(), live._Changes()
    step.init(handle)
    assert _changed(step, _version(None, None, "a"), _version(None, 1, None), _version(None, 1, "a")) == [
        (None, "a"), (None, None), (None, "a"),
    ]
    assert _changed(step, _version(None, 1, None), _version(None, None, "z")) == []


def test_a_subscriber_gets_what_is_newer_in_every_micro_batch(spark, tmp_path):
    inbox, root, out = (str(tmp_path / x) for x in ("in", "wh", "out"))
    items = spark.createDataFrame([("i1", "Lamp", "ITEM_CATEGORY_TOYS")], "item_id string, name string, category string")

    def arrive(*rows):
        frame(spark, list(rows)).coalesce(1).write.mode("append").parquet(inbox)

    def scans():
        return spark.readStream.schema(SCHEMA).parquet(inbox)

    arrive(scan("p", "N", BASE + 5000), scan("q", "I", BASE))
    live.start_positions(scans(), items, root, str(tmp_path / "cp"), NOW).awaitTermination()
    snapshot = {r.package_id for r in live.positions_snapshot(spark, root).collect()}
    write = lambda batch, k: batch.write.mode("append").parquet(out)
    for rows in (
        [scan("p", "I", BASE + 4000), scan("p", "A", BASE + 6000), scan("p", "B", BASE + 7000), scan("r", "I", BASE)],
        [scan("p", "A", BASE + 6500), scan("q", "N", BASE + 1), scan("r", "I", BASE - 1)],
    ):
        arrive(*rows)
        _, updates = live.subscribe(scans(), items, root)
        writer = updates.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "sub"))
        writer.outputMode("update").trigger(**NOW).start().awaitTermination()
    got = sorted((r.package_id, to_millis(r.updated_at) - BASE) for r in spark.read.parquet(out).collect())
    assert snapshot == {"p", "q"} and got == [("p", 6000), ("p", 7000), ("q", 1), ("r", 0)]


def test_packed_updates_come_and_go_as_one_row():
    # A row for each update on the way to Python and back took most of the time of a large table.
    handle, step = _Handle(), live._PackedChanges()
    step.init(handle)
    step.handleInitialState((0,), Row(package_ids=["p1", "p2"], at_ms=[5, 50], event_ids=["a", "a"]), None)
    rows = [(f"p{k}", k if k % 7 else None, f"e{k}", "S", k * 1000, None, "C", False) for k in range(300)]
    batch = live.pa.RecordBatch.from_pylist([dict(zip(live._UPDATE.names, r, strict=True)) for r in rows], live._UPDATE)
    half = [Row(packed=bytearray(live.packed.pack(batch.slice(s, 150)))) for s in (0, 150)]
    (out,) = step.handleInputRows((0,), iter(half), None)
    found = live.packed.unpack(out.packed, live._UPDATE).to_pylist()
    assert handle.state.calls == 3 and sorted(r["package_id"] for r in found) == sorted(f"p{k}" for k in range(300) if k not in (1, 2))
    assert {tuple(r.values()) for r in found} < set(rows)
    assert list(step.handleInputRows((0,), iter(half), None)) == []
