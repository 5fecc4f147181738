"""Classes of equal texts, and connected groups of linked ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import bounded, digest, stored, text_of


def classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (`id`, `text`, `digest`), the digests that occur again (`digest`, `first`: the smallest id, `n`), and one
    row per class of equal texts (`id`, `text`, `digest`, `n`). Copies are combined within a task before they move."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("digest", digest(F.col("text")))
    again = stored(rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1"), "again")
    few = bounded(again)
    alone = rows.join(few, "digest", "left_anti").select("id", "text", "digest", F.lit(1).cast("long").alias("n"))
    shared = rows.join(few.select("digest"), "digest").groupBy("digest").agg(F.min("id").alias("id"), F.first("text").alias("text"), F.count("*").alias("n"))
    return rows, again, alone.unionByName(shared)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """`node` and `group` (its smallest node) for every node of `a`-`b` edges.

    Each round every node takes the smallest label among its own, its neighbours' and its label's label, so labels
    jump along the way they came; rounds grow with the logarithm of a group's width, not with its size.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label")
    labels = stored(labels, "labels")
    for _ in range(most_rounds):
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("heard"))
        near = labels.join(heard, F.col("node") == F.col("a"), "left").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = stored(near.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label")), "labels")
        labels = moved.select("node", "label")
        if not moved.where("old != label").limit(1).count():
            break
    else:
        raise RuntimeError("groups did not settle")
    return labels.withColumnRenamed("label", "group")
