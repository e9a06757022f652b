"""Deep pages of the parcel grid through an order index.

The grid is stored once in its order, cut into ranges of the sort value, with the number of rows of each
range and status beside it. A page adds up the counts and opens only the ranges that its rows lie in,
however large its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.plans.api import SORT_COLUMNS, ParcelPage

_P = domain.DEFAULTS
#: Rows that a range has on average; a page reads one range, or two where it lies across a border.
ROWS_PER_RANGE = 100_000
_COUNTS = "range_no int, status string, n long"
#: ``monotonically_increasing_id`` has the task's number above these bits and the row's place in it below.
_PLACE_BITS = 33


def write_order(
    summaries: DataFrame, folder: str, sort_field: str = "", sort_desc: bool = False, rows_per_range: int = ROWS_PER_RANGE
) -> None:
    """Stores ``summaries`` (of ``api.parcel_summaries``) in order under ``folder``, a new one for each refresh.

    Ties in the sort are broken by package id, so rows with one sort value lie in many ranges as well. The
    counts are written last: a folder without them is not complete.
    """
    field = sort_field or "dwell_time"
    if field not in domain.PARCEL_SORT_FIELDS:
        raise ValueError(f"sort_field must be one of {sorted(domain.PARCEL_SORT_FIELDS)}")
    spark = summaries.sparkSession
    # Written first: range bounds are taken from a sample, and a task that runs again must see the same rows.
    summaries.write.parquet(f"{folder}/unordered")
    rows = spark.read.schema(summaries.schema).parquet(f"{folder}/unordered")
    column = F.col(SORT_COLUMNS[field])
    order = [column.desc() if sort_desc else column.asc(), F.col("package_id").asc()]
    ranges = max(1, -(-rows.count() // rows_per_range))
    placed = (
        rows.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("range_no", F.shiftright("place", _PLACE_BITS).cast("int"))
    )
    placed.write.partitionBy("range_no").parquet(f"{folder}/rows")
    stored = spark.read.schema(placed.schema).parquet(f"{folder}/rows")
    stored.groupBy("range_no", "status").agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(f"{folder}/counts")


def read_page(
    summaries: DataFrame,
    folder: str,
    status_filter: tuple[str, ...] = (),
    limit: int = 0,
    offset: int = 0,
    p: domain.Params = _P,
) -> ParcelPage:
    """The page that ``api.list_parcels`` gives for the stored order; ``summaries`` names the columns only.

    Every range that is opened gives the page a row at least, so there are never more of them than rows in a page.
    """
    spark: SparkSession = summaries.sparkSession
    size = min(limit, p.list_parcels_max) if limit else p.list_parcels_max
    counts = spark.read.schema(_COUNTS).parquet(f"{folder}/counts")
    schema = summaries.withColumn("place", F.lit(0).cast("long")).withColumn("range_no", F.lit(0)).schema
    rows = spark.read.schema(schema).parquet(f"{folder}/rows")
    if status_filter:
        counts, rows = (df.where(F.col("status").isin(*status_filter)) for df in (counts, rows))
    # One row a range: small enough to be added up in one place.
    per_range = counts.groupBy("range_no").agg(F.sum("n").alias("n"))
    ends = per_range.withColumn("end", F.sum("n").over(Window.orderBy("range_no")))
    hit = (
        ends.where((F.col("end") > offset) & (F.col("end") - F.col("n") < offset + size))
        .select("range_no", (F.col("end") - F.col("n")).alias("before"))
        .orderBy("range_no")
        .collect()
    )
    opened = rows.where(F.col("range_no").isin([r["range_no"] for r in hit]))
    skipped = offset - hit[0]["before"] if hit else 0
    page = opened.orderBy("place").offset(skipped).limit(size).drop("dwell_ms", "place", "range_no")
    total = F.coalesce(F.sum("n"), F.lit(0))
    summary = counts.agg(total.alias("total_count"), (F.lit(offset + size) < total).alias("has_more"))
    return ParcelPage(page, summary)
