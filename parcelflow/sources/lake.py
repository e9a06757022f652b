"""The scan lake: a table of parts by event date, with a folder per hour and an index of packages.

Batch and stream writers add parts of sorted files; a finished day is compacted in place into few large
ones, and the compacted part gets an index from packages to days, so that the history of one package
opens files in proportion to the days on which it was seen.
"""

from __future__ import annotations

from datetime import date as Date
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow import domain
from parcelflow.functions import scalars as S
from parcelflow.sources import parts

EVENTS, INDEX = "scan_events", "package_days"
_DATE, _HOUR = T.StructField("date", T.DateType()), T.StructField("hour", T.IntegerType())
PARTITIONED = T.StructType([*domain.LAKE_ROW.fields, _DATE, _HOUR])
# Readers of one package skip row groups by their bloom filters without opening the data.
PACKAGE_BLOOM = {
    "parquet.bloom.filter.enabled#package_id": "true",
    "parquet.bloom.filter.adaptive.enabled#package_id": "true",
}
_WITH_HOUR = [f.name for f in domain.LAKE_ROW.fields] + ["hour"]
_ORDER = ("package_id", "scanned_at")
#: Folders of the package index.
BUCKETS = 64
_INDEX_ROW = T.StructType([T.StructField("package_id", T.StringType()), T.StructField("day", T.StringType())])
_BUCKET = T.StructField("bucket", T.IntegerType())


def read_stored(spark: SparkSession, schema: T.StructType, path: str, **options: str) -> DataFrame | None:
    """Parquet files in a declared schema, None when the path does not exist."""
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def lake_rows(scans: DataFrame) -> DataFrame:
    """Lake columns plus the partition strings of the *event* time; late rows go to their own hour."""
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in domain.LAKE_ROW.fields]
    return scans.select(
        *typed,
        S.partition_date("scanned_at").alias("date"),
        S.partition_hour("scanned_at").alias("hour"),
    )


def write_lake(scans: DataFrame, root: str, writer: str | None = None, batch_id: int | None = None) -> None:
    """Adds scans as one part, seen as a whole; a batch that a streaming ``writer`` repeats is not added again.

    Small hours share a task, a very large hour is split over several. Rows are sorted by package inside
    a file, which makes row groups skippable for one-package reads.
    """
    parts.append(
        lake_rows(scans), root, EVENTS, "date", *_ORDER, writer=writer, batch_id=batch_id, by=("hour",), options=PACKAGE_BLOOM
    )


def _read(spark: SparkSession, root: str, first: Date | None, last: Date | None, snapshot=None) -> DataFrame:
    return parts.read(spark, root, EVENTS, domain.LAKE_ROW, "date", first, last, snapshot, by=(_HOUR,))


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """The whole lake, empty when nothing was written yet."""
    return _read(spark, root, None, None)


def read_lake_range(spark: SparkSession, root: str, first: str | Date, last: str | Date) -> DataFrame:
    """Event dates ``first`` to ``last``, both included; only their folders are listed. No lake at all is an error."""
    if not parts.exists(spark, root):
        raise FileNotFoundError(f"no lake at {root}")
    low, high = (Date.fromisoformat(str(d)) for d in (first, last))
    return _read(spark, root, low, high).select(*_WITH_HOUR)


def read_lake_day(spark: SparkSession, root: str, day: str | Date) -> DataFrame:
    """One event date. No data for it gives 0 rows in the same schema; no lake is an error."""
    return read_lake_range(spark, root, day, day)


def read_lake_between(spark: SparkSession, root: str, floor: datetime, ceiling: datetime) -> DataFrame:
    """Scans of a closed time range. Spark does not derive the date partitions from a filter on
    ``scanned_at``, so both filters are given."""
    at = F.col("scanned_at")
    days = read_lake_range(spark, root, floor.date(), ceiling.date())
    return days.where(at.between(S.ts(floor), S.ts(ceiling)))


def _bucket(package, buckets: int):
    return F.pmod(F.xxhash64(package), F.lit(buckets)).cast("int")


def package_entries(spark: SparkSession, root: str, package_id: str, buckets: int = BUCKETS) -> list[parts.Entry]:
    """The parts that can hold scans of a package: those that the index names, and all that have no index."""
    snapshot = parts.load(spark, root)
    events, index = snapshot.of(EVENTS), snapshot.of(INDEX)
    if not index:
        return events
    indexed = {e.part for e in index}
    own = int(spark.range(1).select(_bucket(F.lit(package_id), buckets)).first()[0])
    whole = T.StructType([*_INDEX_ROW.fields, T.StructField("part", T.StringType()), _BUCKET])
    folders = [parts.folder(root, e, "bucket") for e in index if e.key == str(own)]
    found = set()
    if folders:
        rows = spark.read.schema(whole).option("basePath", f"{root}/{INDEX}").parquet(*folders)
        # One short row per day on which the package was seen.
        found = {(r.part, r.day) for r in rows.where(F.col("package_id") == package_id).select("part", "day").collect()}
    return [e for e in events if e.part not in indexed or (e.part, e.key) in found]


def read_package_scans(spark: SparkSession, root: str, package_id: str, buckets: int = BUCKETS) -> DataFrame:
    """All scans of one package in time order, over every date."""
    entries = package_entries(spark, root, package_id, buckets)
    return (
        parts.read_entries(spark, root, entries, domain.LAKE_ROW, _DATE, _HOUR)
        .where(F.col("package_id") == package_id)
        .select(*domain.LAKE_ROW.names)
        .orderBy("scanned_at", "event_id")
    )


def compact_day(spark: SparkSession, root: str, day: str | Date, buckets: int = BUCKETS) -> bool:
    """Rewrites one date with few large files and indexes its packages; readers take it up at once.

    Rows that land meanwhile, or later, stay beside the compacted part, and the next run merges them.
    The number of index folders must stay the same for a lake.
    """

    def index(run: DataFrame, part: str) -> list[parts.Entry]:
        seen = run.select("package_id").distinct().withColumn("day", F.lit(str(day)))
        return parts.stage(
            seen.withColumn("bucket", _bucket("package_id", buckets)), root, INDEX, "bucket", "package_id", part=part
        )

    return parts.compact(
        spark,
        root,
        EVENTS,
        domain.LAKE_ROW,
        "date",
        Date.fromisoformat(str(day)),
        order=_ORDER,
        by=(_HOUR,),
        options=PACKAGE_BLOOM,
        also=index,
        index=INDEX,
    )


def compact_crowded_days(spark: SparkSession, root: str, parts_from: int = 8, buckets: int = BUCKETS) -> int:
    """Compacts every date that is spread over many parts; returns how many."""
    crowded = parts.load(spark, root).crowded(EVENTS, parts_from)
    return sum(compact_day(spark, root, day, buckets) for day in crowded)


def clean_lake(spark: SparkSession, root: str, grace_ms: int = parts.GRACE_MS) -> int:
    """Deletes replaced files that no reader can be using any more."""
    return parts.clean(spark, root, {EVENTS: "date", INDEX: "bucket"}, grace_ms)


def replay(spark: SparkSession, root: str, first: Date | None = None, last: Date | None = None, **options: str) -> DataFrame:
    """Stored scans as a stream: the parts of the snapshot at the start, and no others."""
    entries = parts.days(parts.load(spark, root), EVENTS, first, last)
    if not entries:
        raise FileNotFoundError(f"no scans to replay at {root}")
    names = ",".join(parts.folder("", e, "date").removeprefix(f"/{EVENTS}/") for e in entries)
    reader = spark.readStream.schema(PARTITIONED).option("basePath", f"{root}/{EVENTS}").options(**options)
    return reader.parquet(f"{root}/{EVENTS}/{{{names}}}").select(*domain.LAKE_ROW.names)
