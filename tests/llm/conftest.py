from __future__ import annotations

import pytest

from parcelflow.llm.common import small_batches

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def batches(spark):
    small_batches(spark)


@pytest.fixture
def documents(spark):
    """Makes a documents table from (doc_id, text) pairs."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCUMENTS)

    return make
