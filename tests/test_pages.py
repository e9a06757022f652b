"""Pages through the order index against sorting all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelflow import domain
from parcelflow.plans import pages

COLUMNS = "package_id string, last_scan_at timestamp, dwell_ms long, status string"


def grid(spark, n):
    """A third of all rows share one sort value."""
    dwell = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") * 7919) % 1000)
    return spark.range(n).select(
        F.concat(F.lit("P"), F.lpad(((F.col("id") * 31) % max(n, 1)).cast("string"), 6, "0")).alias("package_id"),
        F.timestamp_seconds("id").alias("last_scan_at"),
        dwell.cast("long").alias("dwell_ms"),
        F.when(F.col("id") % 50 == 0, "rare").otherwise("usual").alias("status"),
    )


@pytest.mark.parametrize("desc", [False, True])
def test_pages_equal_sorted_rows_and_open_few_ranges(spark, tmp_path, desc):
    rows, folder = grid(spark, 4000), str(tmp_path / "order")
    pages.write_order(rows, folder, "dwell_time", desc, rows_per_range=100)
    every = sorted(rows.collect(), key=lambda r: (-r.dwell_ms if desc else r.dwell_ms, r.package_id))
    ranges = len(list((tmp_path / "order" / "rows").glob("range_no=*")))
    assert ranges > 25
    for status in ((), ("rare",), ("rare", "usual"), ("none",)):
        want = [r.package_id for r in every if not status or r.status in status]
        for offset in (0, 79, 1950, 3990, 4000, 10_000):
            found = pages.read_page(rows, folder, status, limit=30, offset=offset)
            assert [r.package_id for r in found.page.collect()] == want[offset : offset + 30]
            assert tuple(found.summary.first()) == (len(want), offset + 30 < len(want))
    deep = pages.read_page(rows, folder, limit=30, offset=3000).page
    assert deep.columns == ["package_id", "last_scan_at", "status"]
    opened = deep._jdf.queryExecution().executedPlan().toString()
    numbers = opened.split("PartitionFilters: [")[1].split("]")[0]
    assert "range_no" in numbers and numbers.count("#") <= 3  # one or two ranges, pruned before the scan


def test_no_rows_limits_and_wrong_fields(spark, tmp_path):
    none, folder = grid(spark, 0), str(tmp_path / "none")
    pages.write_order(none, folder)
    found = pages.read_page(none, folder, offset=5)
    assert found.page.collect() == [] and tuple(found.summary.first()) == (0, False)
    rows, folder = grid(spark, 500), str(tmp_path / "some")
    pages.write_order(rows, folder, "package_id")
    assert pages.read_page(rows, folder, limit=10_000).page.count() == domain.DEFAULTS.list_parcels_max
    with pytest.raises(ValueError):
        pages.write_order(rows, str(tmp_path / "x"), "colour")
