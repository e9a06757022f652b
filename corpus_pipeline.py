"""From raw documents to packed training sequences, stage by stage.

Every stage works on the whole output of the one before, which is written as Parquet to the shared
folder and read again, so a lost executor costs tasks of one stage only. All stages but the last return
the columns of ``documents``; rows pass unchanged or go.

Defined cases: a null or empty text is scored by the classifiers like any other, has the fingerprint zero
(so one such document stays), no benchmark words, and one token. Texts are read whole whatever their
length. Repeated rows are copies: one stays. A null id is the last choice of its class. Extra columns pass
through all stages but the last; one named like a column that a stage computes (``contaminated``, a text
statistic) comes out with the stage's value. An empty ``documents`` gives no rows; without labels no
document is rejected by a classifier, without a benchmark none is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import decontaminate, packing, quality, simhash, toxicity
from parcelflow.llm.common import small_batches, store, table
from parcelflow.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier rejects go."""
    small_batches(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts to be of low quality go."""
    small_batches(spark)
    return quality.without_poor(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link (three-word shingles, two bits), the one with the smallest id stays."""
    small_batches(spark)
    return simhash.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    small_batches(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the remaining documents, each with its sequence and offset."""
    small_batches(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_poor),
    ("near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

#: SQL can express neither the classifiers nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
