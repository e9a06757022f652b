"""The derived tables the registered queries read."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions import scalars as S
from parcelflow.operators import alerts as A
from parcelflow.operators import dwell, floor, journeys
from parcelflow.plans import api
from parcelflow.session import apply_settings
from parcelflow.sources import lake, tables, warehouse
from parcelflow.sources.shared import shared_dir


class Testbed:
    """Views over the given tables, and stored tables that are written once when first needed."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_settings(spark)
        self.sf_dir = sf_dir
        self._root: str | None = None

    @property
    def root(self) -> str:
        """A new folder under the shared one."""
        if self._root is None:
            self._root = f"{shared_dir(self.spark)}/parcelflow-{uuid.uuid4().hex}"
        return self._root

    def folder(self, name: str) -> str:
        """A folder of its own for one run of a query that writes."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """A table that one run of a query reads several times, computed once."""
        path = self.folder(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def _scans(self) -> str:
        """The numbered scans: a shuffle and a sort of all of lineitem, done once and not by every reader."""
        path = f"{self.root}/scan_table"
        tables.scans(self.spark, self.sf_dir).write.parquet(path)
        return path

    @property
    def scans(self) -> DataFrame:
        schema = tables.scans(self.spark, self.sf_dir).schema
        return self.spark.read.schema(schema).parquet(self._scans)

    @property
    def items(self) -> DataFrame:
        return tables.items(self.spark, self.sf_dir)

    @property
    def scans_events(self) -> DataFrame:
        return tables.scans_events(self.spark, self.sf_dir)

    @cached_property
    def as_of(self) -> datetime:
        """Time of the newest scan."""
        newest = self.scans.agg(F.max(S.millis("scanned_at"))).first()[0]
        return datetime.fromtimestamp(newest / 1000, tz=timezone.utc)

    def detected(self) -> DataFrame:
        """Nested alerts of all detectors, straight from the scans."""
        scans = self.scans
        return A.union_alerts(
            dwell.stuck_alerts(scans),
            journeys.misrouting_alerts(journeys.sessions(scans)),
            dwell.damage_alerts(scans),
        )

    @cached_property
    def _lake(self) -> str:
        root = f"{self.root}/lake"
        lake.write_lake(self.scans, root)
        return root

    @property
    def lake_root(self) -> str:
        return self._lake

    @cached_property
    def _alerts(self) -> str:
        root = f"{self.root}/warehouse"
        warehouse.append_alerts(self.detected(), root, inserted_at=self.as_of)
        return root

    @property
    def warehouse_root(self) -> str:
        return self._alerts

    @property
    def alerts(self) -> DataFrame:
        return warehouse.read_alerts(self.spark, self._alerts)

    @property
    def rollup(self) -> DataFrame:
        return warehouse.read_rollup(self.spark, self._alerts)

    @cached_property
    def _reports(self) -> str:
        root = f"{self.root}/reports"
        for name, report in api.daily_reports(self.scans, self.items, self.alerts).items():
            warehouse.overwrite_report(report, warehouse.report_path(root, name), self.as_of)
        return root

    @property
    def reports_root(self) -> str:
        return self._reports

    def report(self, name: str) -> DataFrame:
        return warehouse.read_report(self.spark, warehouse.report_path(self._reports, name))

    @property
    def throughput(self) -> DataFrame:
        return self.report("daily_station_throughput")

    @property
    def by_category(self) -> DataFrame:
        return self.report("daily_damage_rate_by_category")

    @property
    def positions(self) -> DataFrame:
        return floor.current_positions(self.scans, self.items)


_open: dict[tuple[str, str], Testbed] = {}


def testbed(spark: SparkSession, sf_dir: str) -> Testbed:
    """One testbed per application and data folder."""
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    if key not in _open:
        _open[key] = Testbed(spark, key[1])
    apply_settings(spark)
    return _open[key]
