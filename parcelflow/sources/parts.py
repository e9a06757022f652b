"""Tables that many writers append to: Parquet parts, and one snapshot that says which of them count.

A part is the folder ``<root>/<table>/part=<id>/<key>=<value>/``, written once and never changed. The
snapshot ``<root>/_snapshots/<version>.json`` names every part that counts, for all tables of the root. A
commit reads the newest snapshot, adds and removes names and publishes the next version under a name that
must not exist yet; whoever comes second tries again on top of the first. So a commit is seen whole or
not at all, over all tables it touches, and a reader, which reads one snapshot once, never sees a part
together with the run that replaces it.

The snapshot also keeps the last batch of every streaming writer: a batch that is repeated after a failure
changes nothing, even if its first attempt has been compacted since. Files that no snapshot names any
more are deleted by ``clean`` after a time in which readers can finish.

Publishing needs a file system that refuses to rename onto an existing name (HDFS and the like); on a plain
local disk writers of one process are kept apart by a lock. The snapshot is small while keys are compacted:
a short line per part, for example a few per finished day and those since the last compaction.
"""

from __future__ import annotations

import json
import random
import threading
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date as Date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from parcelflow.functions import packed

#: Attempts to publish before giving up, and how long files without a name stay.
ATTEMPTS, GRACE_MS = 200, 3_600_000
_PUBLISHING = threading.Lock()


@dataclass(frozen=True, order=True)
class Entry:
    """One part of a table under one key value."""

    table: str
    part: str
    key: str


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    entries: tuple[Entry, ...] = ()
    #: The last batch of each streaming writer.
    batches: dict[str, int] = field(default_factory=dict)

    def of(self, table: str) -> list[Entry]:
        return [e for e in self.entries if e.table == table]

    def crowded(self, table: str, parts: int) -> list[str]:
        """Key values with at least that many parts."""
        return sorted(key for key, n in Counter(e.key for e in self.of(table)).items() if n >= parts)


class _Files:
    """A root's folder through Spark's file system layer."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.root = root
        self._fs = self.path("").getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self.path(name))

    def names(self, name: str) -> dict[str, int]:
        """The names in a folder with the time of their last change; none where there is no folder."""
        if not self.exists(name):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs.listStatus(self.path(name))}

    def text(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def publish(self, name: str, text: str) -> bool:
        """Writes a file as a whole; False where the name is taken."""
        folder, _, own = name.rpartition("/")
        draft = f"{folder}/.{own}-{uuid.uuid4().hex}".lstrip("/")
        stream = self._fs.create(self.path(draft), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(self.path(draft), self.path(name), options)
            return True
        except Py4JJavaError as error:
            self.delete(draft)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                return False
            raise


def publish_once(spark: SparkSession, path: str, text: str) -> str:
    """Writes a small file unless it is there already; returns what it holds."""
    root, name = path.rsplit("/", 1)
    files = _Files(spark, root)
    with _PUBLISHING:
        if not files.exists(name):
            files.publish(name, text)
        return files.text(name)


def exists(spark: SparkSession, root: str) -> bool:
    return _Files(spark, root).exists()


def _version(name: str) -> int:
    return int(name.removesuffix(".json"))


def _versions(files: _Files) -> dict[str, int]:
    return {n: t for n, t in files.names("_snapshots").items() if n.endswith(".json") and not n.startswith(".")}


def _load(files: _Files) -> Snapshot:
    versions = _versions(files)
    if not versions:
        return Snapshot()
    newest = max(versions, key=_version)
    stored = json.loads(files.text(f"_snapshots/{newest}"))
    entries = tuple(Entry(*e) for e in stored["entries"])
    return Snapshot(_version(newest), entries, stored["batches"])


def load(spark: SparkSession, root: str) -> Snapshot:
    """The newest snapshot; an empty one where nothing was committed yet."""
    return _load(_Files(spark, root))


def commit(
    spark: SparkSession,
    root: str,
    add: Iterable[Entry] = (),
    remove: Iterable[Entry] = (),
    writer: str | None = None,
    batch_id: int | None = None,
) -> bool:
    """Publishes a snapshot with ``add`` and without ``remove``.

    False, with nothing changed, if the ``writer`` has committed this batch before, or if something to be
    removed is gone already because another compaction came first.
    """
    files, add, remove = _Files(spark, root), tuple(add), frozenset(remove)
    for _ in range(ATTEMPTS):
        with _PUBLISHING:
            now = _load(files)
            if writer is not None and now.batches.get(writer, -1) >= batch_id:
                return False
            if not remove <= set(now.entries):
                return False
            kept = [e for e in now.entries if e not in remove]
            batches = now.batches if writer is None else now.batches | {writer: batch_id}
            text = json.dumps({"entries": [[e.table, e.part, e.key] for e in (*kept, *add)], "batches": batches})
            if files.publish(f"_snapshots/{now.version + 1:020d}.json", text):
                return True
        time.sleep(random.random() / 5)
    raise RuntimeError(f"no commit to {root} in {ATTEMPTS} attempts")


def writer_of(batch: DataFrame) -> str:
    """The identity of the streaming query that a micro-batch belongs to; its checkpoint keeps it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def done(spark: SparkSession, root: str, writer: str | None, batch_id: int | None) -> bool:
    """True if the writer has committed this batch, so that its work need not be repeated."""
    return writer is not None and load(spark, root).batches.get(writer, -1) >= batch_id


def new_part() -> str:
    return f"p{uuid.uuid4().hex}"


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Size of a shuffle partition of packed rows, which are several times as large when unpacked and sorted.
PACKED_BYTES = "16m"


def _packed_by_day(df: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` after a shuffle that brings those of a day together, packed on the way."""
    schema = to_arrow_schema(df.schema)
    days = df.select(F.coalesce(F.unix_date(key), F.lit(-1)).cast("long").alias("group"), "*")
    packs = days.mapInArrow(packed.gathered(schema, 400_000), packed.GROUPED)
    return packs.hint("rebalance", "group").mapInArrow(packed.opened(schema), df.schema)


def stage(
    df: DataFrame,
    root: str,
    table: str,
    key: str,
    *order: str,
    by: tuple[str, ...] = (),
    part: str | None = None,
    options: dict[str, str] | None = None,
    pack: bool = False,
) -> list[Entry]:
    """Writes the rows of ``df`` as a part that nobody sees before it is committed.

    ``key`` is the column that readers prune by, ``by`` are columns for folders below it. ``rebalance`` lets
    AQE size the files; inside a file rows are in ``order``. With ``pack`` (``key`` a date, no ``by``) rows are
    shuffled packed, which takes a fraction of the disk for long texts, and some time in Python.
    """
    spark, part = df.sparkSession, part or new_part()
    sized = (_packed_by_day(df, key) if pack else df.hint("rebalance", key, *by)).sortWithinPartitions(key, *by, *order)
    # The session of a stateful stream has AQE off. A micro-batch is finished rows, so its write may have it on.
    settings = {"spark.sql.adaptive.enabled": "true"} | ({_ADVISORY: PACKED_BYTES} if pack else {})
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        sized.write.options(**(options or {})).partitionBy(key, *by).parquet(f"{root}/{table}/part={part}")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    folders = _Files(spark, root).names(f"{table}/part={part}")
    return sorted(Entry(table, part, n.split("=", 1)[1]) for n in folders if n.startswith(f"{key}="))


def append(
    df: DataFrame,
    root: str,
    table: str,
    key: str,
    *order: str,
    writer: str | None = None,
    batch_id: int | None = None,
    by: tuple[str, ...] = (),
    options: dict[str, str] | None = None,
) -> None:
    """Adds one batch to one table."""
    spark = df.sparkSession
    if not done(spark, root, writer, batch_id):
        commit(spark, root, stage(df, root, table, key, *order, by=by, options=options), (), writer, batch_id)


def folder(root: str, entry: Entry, key: str) -> str:
    return f"{root}/{entry.table}/part={entry.part}/{key}={entry.key}"


def read_entries(
    spark: SparkSession, root: str, entries: list[Entry], schema: T.StructType, key: T.StructField, *by: T.StructField
) -> DataFrame:
    """The rows of some parts of one table: the columns of ``schema``, then ``key`` and ``by``."""
    whole = T.StructType([*schema.fields, T.StructField("part", T.StringType()), key, *by])
    if not entries:
        # Known to be empty when planned, so that a join with it costs nothing.
        none = spark.range(1).where(F.lit(False))
        return none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in whole.fields]).drop("part")
    paths = [folder(root, e, key.name) for e in entries]
    stored = spark.read.schema(whole).option("basePath", f"{root}/{entries[0].table}").parquet(*paths)
    return stored.drop("part")


def _between(day: str, first: Date | None, last: Date | None) -> Column:
    kept = F.lit(True)
    if first is not None:
        kept = kept & (F.col(day) >= F.lit(first))
    if last is not None:
        kept = kept & (F.col(day) <= F.lit(last))
    return kept


def days(snapshot: Snapshot, table: str, first: Date | None = None, last: Date | None = None) -> list[Entry]:
    """Parts of a table that is kept by day, from ``first`` to ``last`` (both included, open ends allowed)."""
    low, high = str(first or ""), str(last or "~")
    return [e for e in snapshot.of(table) if low <= e.key <= high]


def read(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    day: str,
    first: Date | None = None,
    last: Date | None = None,
    snapshot: Snapshot | None = None,
    by: tuple[T.StructField, ...] = (),
) -> DataFrame:
    """All rows of the days ``first`` to ``last`` in one snapshot; only their folders are listed and opened."""
    chosen = days(snapshot or load(spark, root), table, first, last)
    key = T.StructField(day, T.DateType())
    return read_entries(spark, root, chosen, schema, key, *by).where(_between(day, first, last))


def compact(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    day: str,
    of: Date,
    reduce: Callable[[DataFrame], DataFrame] | None = None,
    order: tuple[str, ...] = (),
    by: tuple[T.StructField, ...] = (),
    options: dict[str, str] | None = None,
    also: Callable[[DataFrame, str], list[Entry]] | None = None,
    index: str | None = None,
) -> bool:
    """Replaces the parts of one day by one part with few files; ``reduce`` may drop rows that no reader needs.

    The rows and the list of what they replace come from one snapshot, so a part that lands at any
    moment stays beside the run. ``also`` may stage more entries from the run under its part name
    (table ``index``), which live and go with it. False if another compaction of the day came first; then
    the files of this one wait for ``clean``.
    """
    snapshot = load(spark, root)
    old = days(snapshot, table, of, of)
    runs = {e.part for e in old}
    indexes = [e for e in snapshot.entries if index is not None and e.table == index and e.part in runs]
    if not old or (len(old) == 1 and (index is None or indexes)):
        return False
    key = T.StructField(day, T.DateType())
    rows = read_entries(spark, root, old, schema, key, *by)
    reduced = rows if reduce is None else reduce(rows.select(*schema.names)).withColumn(day, F.lit(of))
    part = new_part()
    new = stage(reduced, root, table, day, *(order or schema.names[:1]), by=tuple(f.name for f in by), part=part, options=options)
    if also is not None:
        new = [*new, *also(read_entries(spark, root, new, schema, key, *by), part)]
    return commit(spark, root, new, [*old, *indexes])


def drop(spark: SparkSession, root: str, entries: Iterable[Entry]) -> bool:
    """Takes parts out of the table; their files go with the next ``clean``."""
    return commit(spark, root, (), entries)


def clean(spark: SparkSession, root: str, key_of: dict[str, str], grace_ms: int = GRACE_MS) -> int:
    """Deletes snapshots and parts that have been out of use for ``grace_ms``; returns the number of parts.

    ``key_of``: the key column of each table to be cleaned. A part stays while the newest snapshot or any
    other one that was still the newest less than the grace ago names it, and while it is young itself,
    as it may be waiting for its commit. Only names pass through the driver.
    """
    files = _Files(spark, root)
    versions = sorted(_versions(files).items(), key=lambda v: _version(v[0]))
    # A snapshot was in use until the next one came.
    limit = int(time.time() * 1000) - grace_ms
    ended = [*(t for _, t in versions[1:]), limit + 1][: len(versions)]
    named: set[Entry] = set()
    for (name, _), end in zip(versions, ended, strict=True):
        if end > limit:
            named |= {Entry(*e) for e in json.loads(files.text(f"_snapshots/{name}"))["entries"]}
        else:
            files.delete(f"_snapshots/{name}")
    removed = 0
    for table, key in key_of.items():
        for part, changed in files.names(table).items():
            if not part.startswith("part=") or changed > limit:
                continue
            own = [n for n in files.names(f"{table}/{part}") if n.startswith(f"{key}=")]
            stale = [n for n in own if Entry(table, part.split("=", 1)[1], n.split("=", 1)[1]) not in named]
            if len(stale) == len(own):
                files.delete(f"{table}/{part}")
            else:
                for name in stale:
                    files.delete(f"{table}/{part}/{name}")
            removed += len(stale)
    return removed
