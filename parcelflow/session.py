"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Day and hour boundaries are UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The per-slot aggregates run on input that a window has already sorted by their keys.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # Keyed stream state on local disk with changelog checkpoints, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Stored tables and the change logs of state take a third to a half less disk than with the defaults.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # A busy package's scans are merged into sessions before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

#: Partitions that a batch shuffle starts with, however few ``spark.sql.shuffle.partitions`` says: AQE merges
#: small ones, but does not cut the large ones of an aggregate or a window, whose sorts would spill.
START_PARTITIONS = 240


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    start = max(START_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("parcelflow")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
