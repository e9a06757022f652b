"""The item dimension."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from parcelflow import domain
from parcelflow.sources.lake import read_stored

log = logging.getLogger(__name__)


def read_items(spark: SparkSession, path: str, live: bool = False) -> DataFrame:
    """Item catalog from Parquet.

    A missing catalog fails a batch job. The live path goes on without item names: it warns and
    gets an empty catalog.
    """
    stored = read_stored(spark, domain.ITEM, path)
    if stored is not None:
        return stored
    if not live:
        raise FileNotFoundError(f"no item catalog at {path}")
    log.warning("no item catalog at %s, positions will show no item", path)
    return spark.createDataFrame([], domain.ITEM)


def read_items_jdbc(spark: SparkSession, url: str, table: str = "items", **options: str) -> DataFrame:
    """The same catalog from any JDBC database."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def item_categories(items: DataFrame) -> DataFrame:
    return items.select("item_id", "category")


def item_names(items: DataFrame) -> DataFrame:
    return items.select("item_id", "name")
