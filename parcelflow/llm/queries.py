"""The registered queries of the corpus operators, over their whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import (
    cover_tree,
    decontaminate,
    hard_negatives,
    licences,
    packing,
    quality,
    sharding,
    simhash,
    site_tree,
    spelling,
    top_scores,
    toxicity,
    urls,
)
from parcelflow.llm.common import small_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: SQL that gives the same rows; only where SQL can express the operator on whole tables.
ORACLE: dict[str, str] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


@query("op1_sharding")
def op1(spark, sf_dir):
    return sharding.document_shards(table(spark, sf_dir, "documents"), shards=8)


@query("op4_decontamination")
def op4(spark, sf_dir):
    return decontaminate.document_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_packing")
def op7(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op8_toxicity")
def op8(spark, sf_dir):
    return toxicity.document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_quality")
def op5(spark, sf_dir):
    return quality.document_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_simhash")
def op2(spark, sf_dir):
    return simhash.document_classes(table(spark, sf_dir, "documents"))


@query("op10_embeddings")
def op10(spark, sf_dir):
    return cover_tree.vector_classes(table(spark, sf_dir, "embeddings"))


@query("op6_url_filter", urls.verdict_sql())
def op6(spark, sf_dir):
    return urls.page_verdicts(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query("op9_html_extraction")
def op9(spark, sf_dir):
    return site_tree.page_texts(table(spark, sf_dir, "pages"))


@query("op3_licences", licences.licences_sql())
def op3(spark, sf_dir):
    return licences.document_licences(table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", hard_negatives.negatives_sql())
def op11(spark, sf_dir):
    return hard_negatives.embedding_negatives(table(spark, sf_dir, "embeddings"))


@query("op13_top_scores", top_scores.top_sql())
def op13(spark, sf_dir):
    return top_scores.embedding_top(table(spark, sf_dir, "embeddings"))


@query("op12_spelling_variants")
def op12(spark, sf_dir):
    return spelling.document_variants(table(spark, sf_dir, "documents"))
