"""Quality by a sparse rule ensemble over text statistics.

Each text becomes a short row of statistics. On a bounded sample of labelled texts small trees are
grown on random parts of rows and statistics; every path from a root to a node is a rule, a conjunction
of bounds. A lasso logistic regression over the rules keeps the few that matter. The kept rules are
compiled into one Spark column expression over the statistics, so scoring is generated code.

Defined cases: a null or empty text has the statistics of no words (all zero) and is scored like any
other; without labels of both classes every score is the share of good labels (0.5 if there is none);
repeated and conflicting labels count once, as good.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import held_out, map_texts
from parcelflow.llm.labelled import label_sample

#: Labelled documents of each class to learn from, about.
SAMPLE_PER_CLASS = 5_000
TREES, DEPTH, LEAST_ROWS, CUTS = 40, 3, 10, 24
#: Share of the sample that chooses the strength of the lasso.
CHECK_SHARE = 0.25
SEED = 20

STATISTICS = (
    "words", "letters_per_word", "distinct_words", "same_as_previous", "commonest_word", "capitals", "digits",
    "marks", "marks_per_word", "symbols_per_word", "exclamations_per_word", "bars_per_word", "stops_per_word",
    "words_per_line", "repeated_lines", "long_words", "short_words", "other_scripts",
)

_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_MARKS = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
_HIGH = bytes(range(128, 256))
_SYMBOLS = b"*#$%&^~=_<>{}[]\\"
_LINES = re.compile(rb"\n+")


def statistics(text: bytes | None) -> list[float]:
    words = text.split() if text else []
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    count = lambda which: size - len(text.translate(None, which))
    low = text.lower().split()
    counts = Counter(low)
    lengths = [len(w) for w in words]
    lines = [x for x in _LINES.split(text) if x.strip()]
    marks = count(_MARKS)
    return [
        float(np.log1p(n)),
        sum(lengths) / n,
        len(counts) / n,
        sum(map(bytes.__eq__, low, low[1:])) / n,
        max(counts.values()) / n,
        count(_CAPITALS) / size,
        count(_DIGITS) / size,
        marks / size,
        marks / n,
        count(_SYMBOLS) / n,
        text.count(b"!") / n,
        text.count(b"|") / n,
        text.count(b".") / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(x > 20 for x in lengths) / n,
        sum(x < 3 for x in lengths) / n,
        count(_HIGH) / size,
    ]


def with_statistics(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``documents`` (or its columns ``keep``) with ``__statistics``, an array in the order of ``STATISTICS``."""

    def make():
        return lambda texts: [pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))]

    return map_texts(documents, {"__statistics": "array<double>"}, make, keep)


#: A bound: (statistic, above, cut). A rule is a tuple of bounds that must all hold.
Rule = tuple[tuple[int, bool, float], ...]


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for i, above, cut in rule:
        out &= (x[:, i] > cut) == above
    return out


def _grow(x, y, w, rng, path: Rule, found: set[Rule]) -> None:
    """Adds the rules of a tree's nodes below ``path``."""
    if len(path) == DEPTH or len(y) < 2 * LEAST_ROWS or y.min() == y.max():
        return
    best = (1e-9, None)
    total, good = w.sum(), (w * y).sum()
    for i in rng.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False):
        cuts = np.unique(np.quantile(x[:, i], np.linspace(0, 1, CUTS + 2)[1:-1]))
        left = x[:, i][:, None] <= cuts
        n = left.sum(0)
        wl, gl = w @ left, (w * y) @ left
        ok = (n >= LEAST_ROWS) & (len(y) - n >= LEAST_ROWS)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl**2 / wl + (good - gl) ** 2 / (total - wl) - good**2 / total
        gain = np.where(ok, gain, 0)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (gain[k], (int(i), float(cuts[k])))
    if best[1] is None:
        return
    i, cut = best[1]
    for above in (False, True):
        on = (x[:, i] > cut) == above
        deeper = (*path, (i, above, cut))
        found.add(tuple(sorted(deeper)))
        _grow(x[on], y[on], w[on], rng, deeper, found)


def tree_rules(x: np.ndarray, y: np.ndarray, w: np.ndarray, seed: int = SEED) -> list[Rule]:
    """The distinct root-to-node paths of small trees, each on half of the rows and of the statistics at each split."""
    rng, found = np.random.default_rng(seed), set()
    for _ in range(TREES):
        rows = rng.choice(len(y), max(1, len(y) // 2), replace=False)
        _grow(x[rows], y[rows], w[rows], rng, (), found)
    return sorted(found)


def lasso_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, strength: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Constant and weights of an L1-penalised logistic regression, by accelerated proximal gradient steps."""
    w = w / w.sum()
    share = np.clip((w * y).sum(), 1e-6, 1 - 1e-6)
    b, v = float(np.log(share / (1 - share))), np.zeros(x.shape[1])
    rate = 4.0 / (1 + (w @ (x**2)).sum())
    b0, v0, t = b, v, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(b0 + x @ v0, -30, 30)))
        r = w * (p - y)
        b1 = b0 - rate * r.sum()
        v1 = v0 - rate * (x.T @ r)
        v1 = np.sign(v1) * np.maximum(np.abs(v1) - rate * strength, 0)
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        b0, v0 = b1 + (t - 1) / t1 * (b1 - b), v1 + (t - 1) / t1 * (v1 - v)
        b, v, t = b1, v1, t1
    return b, v


@dataclass
class RuleEnsemble:
    constant: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self, statistics: str = "__statistics") -> Column:
        """The score as a Spark expression over the array of statistics."""
        total = F.lit(self.constant)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for i, above, cut in rule:
                value = F.col(statistics)[i]
                holds = holds & (value > F.lit(cut) if above else value <= F.lit(cut))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def text(self) -> list[str]:
        """The rules as readable lines, the heaviest first."""
        bound = lambda b: f"{STATISTICS[b[0]]} {'>' if b[1] else '<='} {b[2]:.4g}"
        return [f"{v:+.3f} if {' and '.join(map(bound, r))}" for r, v in sorted(self.rules, key=lambda x: -abs(x[1]))]


def train(x: np.ndarray, y: np.ndarray, stands_for: dict[int, float]) -> RuleEnsemble:
    """A rule ensemble from statistics and labels; ``stands_for``: how many rows a row of each class stands for."""
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-9, 1 - 1e-9))
        return RuleEnsemble(float(np.log(share / (1 - share))))
    w = np.array([stands_for[int(k)] for k in y])
    rules = tree_rules(x, y, w)
    if not rules:
        share = float(np.average(y, weights=w))
        return RuleEnsemble(float(np.log(share / (1 - share))))
    z = np.column_stack([_holds(r, x) for r in rules]).astype(float)
    check = np.random.default_rng(SEED).random(len(y)) < CHECK_SHARE

    def loss(strength):
        b, v = lasso_logistic(z[~check], y[~check], w[~check], strength)
        p = np.clip(1 / (1 + np.exp(-(b + z[check] @ v))), 1e-9, 1 - 1e-9)
        return -(w[check] * (y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p))).sum()

    strengths = (0.02, 0.01, 0.005, 0.002, 0.001, 0.0005)
    strength = min(strengths, key=loss) if check.any() and 0 < y[~check].mean() < 1 else 0.002
    b, v = lasso_logistic(z, y, w, strength, 1000)
    return RuleEnsemble(float(b), [(r, float(k)) for r, k in zip(rules, v, strict=True) if abs(k) > 1e-6])


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality") -> RuleEnsemble:
    """Trains on about ``SAMPLE_PER_CLASS`` documents a class; only their statistics come to the driver."""
    sample, stands_for = label_sample(labels, label, SAMPLE_PER_CLASS)
    labelled = (
        documents.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")  # 2 * SAMPLE_PER_CLASS short rows or so
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
    rows = with_statistics(labelled, ["doc_id", "label"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([r["__statistics"] for r in rows], float).reshape(-1, len(STATISTICS))
    return train(x, np.array([r["label"] for r in rows], float), stands_for)


def document_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of every document."""
    score = fit(documents, labels).column()
    out = with_statistics(documents, ["doc_id"]).withColumn("score", score)
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_poor(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted good, with their columns as they were."""
    score = fit(documents, labels).column()
    return with_statistics(documents).where(score >= 0.5).select(*[f"`{c}`" for c in documents.columns])
