"""Bounded samples of labelled documents, and a small logistic fit, for the classifiers trained here."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import held_out

#: Buckets of the hash by which sample rows are chosen.
_BUCKETS = 1 << 20


def label_sample(labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, float]]:
    """About ``per_class`` ids of each class (all where there are fewer), and how many rows a sampled one stands for.

    Held-out ids and null labels are left out. An id labelled more than once has its highest label.
    The rows are chosen by a hash of the id, so the choice can be repeated.
    """
    usable = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    share = {k: min(1.0, per_class / n) for k, n in counts.items()}
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(_BUCKETS))
    chosen = F.lit(False)
    for k, s in share.items():
        chosen = chosen | ((F.col("label") == k) & (bucket < F.lit(int(s * _BUCKETS))))
    return usable.where(chosen), {k: 1 / s for k, s in share.items()}


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (the constant first) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (weight * (p - y)) + penalty * w)
        size = np.abs(step).max()
        w -= step * min(1.0, 4.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return w
