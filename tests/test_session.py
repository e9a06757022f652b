"""Session settings, and the scans that the registered queries share."""

from __future__ import annotations

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks.testbed import Testbed
from parcelflow.session import START_PARTITIONS, apply_settings
from parcelflow.sources import tables

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_batch_shuffles_start_with_many_partitions(spark):
    apply_settings(spark)
    plan = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()._jdf.queryExecution().executedPlan().toString()
    assert f", {START_PARTITIONS}), ENSURE_REQUIREMENTS" in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_scans_are_numbered_once(spark):
    scans = Testbed(spark, SF).scans
    assert "Window" not in scans._jdf.queryExecution().executedPlan().toString()
    derived = tables.scans(spark, SF)
    assert scans.schema.simpleString() == derived.schema.simpleString()
    assert scans.exceptAll(derived).isEmpty() and scans.count() == derived.count()


def test_stored_tables_are_small(spark, tmp_path):
    # With the default codec the wire of alerts alone took more than twice the disk.
    apply_settings(spark)
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "t"))
    (file,) = (tmp_path / "t").glob("*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
