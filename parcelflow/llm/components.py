"""Connected components of a link table, without gathering a component anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import temporary


def merge_links(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Joins the trees of ``parent`` (each node to a smaller one or itself) along links; the roots stay the smallest."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return parent
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (above := parent[parent]) is not None and (above != parent).any():
            parent = above


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest node that can be reached.

    Each node keeps its smaller neighbours. A round keeps the smallest one and passes the others on to
    it, until every node has one parent; then parents are replaced by theirs until they are roots. A
    round is two shuffles of the link table on its node, stored in the shared folder; hub nodes meet
    in joins that adaptive execution can split, never in one group.
    """
    spark = links.sparkSession
    with temporary(spark) as put:
        pairs = put(
            links.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("p"))
            .distinct(),
            "pairs",
        )
        while True:
            least = put(pairs.groupBy("v").agg(F.min("p").alias("m"), F.count("*").alias("n")), "least")
            if (least.agg(F.max("n")).first()[0] or 1) == 1:
                break
            found = pairs.join(least.select("v", "m"), "v")
            pairs = put(
                found.select(F.when(F.col("p") == F.col("m"), F.col("v")).otherwise(F.col("p")).alias("v"), F.col("m").alias("p"))
                .union(least.where("n > 1").select("v", F.col("m").alias("p")))
                .distinct(),
                "pairs",
            )
        while True:
            above = pairs.select(F.col("v").alias("p"), F.col("p").alias("q"))
            lifted = put(
                pairs.join(above, "p", "left").select(
                    "v", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")
                ),
                "lifted",
            )
            if lifted.where("moved").isEmpty():
                break
            pairs = put(lifted.select("v", "p"), "pairs")
    roots = pairs.select(F.col("p").alias("v")).distinct().select("v", F.col("v").alias("p"))
    return pairs.union(roots).select(F.col("v").alias("node"), F.col("p").alias("root"))
