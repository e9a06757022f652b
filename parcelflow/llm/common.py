"""What the corpus operators share: tables, intermediate results in the shared folder, batch sizes."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.sources.shared import shared_dir

#: Rows in one Arrow batch. Long texts make rows of 100 kB and more, so batches stay small.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}/{label}"


def store(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    Cuts the lineage and evaluates expensive steps once; a lost executor costs its running tasks only.
    """
    path = folder(df.sparkSession, label)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession):
    """Collects frames stored through the yielded function and removes the previous one of a label on each store."""
    kept: dict[str, str] = {}

    def put(df: DataFrame, label: str) -> DataFrame:
        path = folder(spark, label)
        df.write.option("compression", "zstd").parquet(path)
        old = kept.get(label)
        kept[label] = path
        if old:
            discard(spark, old)
        return spark.read.schema(df.schema).parquet(path)

    yield put


def discard(spark: SparkSession, path: str) -> None:
    """Removes a stored intermediate result through Spark's file system layer."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def utf8(column: str | Column) -> Column:
    """The UTF-8 bytes of a text; null stays null."""
    return (F.col(column) if isinstance(column, str) else column).cast("binary")


def held_out(doc_id: str | Column) -> Column:
    """True where crc32 of the id's decimal text leaves 1 modulo 3: rows no label is learnt from. A null id is not held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def map_texts(documents: DataFrame, added: dict[str, str], make, keep: list[str] | None = None) -> DataFrame:
    """``documents`` (or its columns ``keep``) with columns computed from each whole ``text``, batch by batch.

    ``added``: name to type. ``make()`` runs once in a task and returns a function from a batch's UTF-8
    texts (None for null) to one Arrow array for each added column. An added name replaces a clashing column.
    """
    names = [c for c in (documents.columns if keep is None else keep) if c not in added]
    schema = [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in names]
    schema += [f"`{c}` {kind}" for c, kind in added.items()]
    out = [*names, *added]

    def run(batches):
        of = make()
        for batch in batches:
            arrays = of(batch.column(len(names)).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), *arrays], out)

    source = documents.select(*[F.col(f"`{c}`") for c in names], utf8("text").alias("__utf8"))
    return source.mapInArrow(run, ", ".join(schema))
