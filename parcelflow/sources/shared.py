"""The shared folder for checkpoints and derived tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session that does not set it gets a temporary folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="parcelflow-")
        spark.sparkContext.setCheckpointDir(_local[app])
    return _local[app]
