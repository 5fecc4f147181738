"""Exact duplicates: 128-bit groups whose bytes are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import bounded, digest, stored, text_of


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = False,
                 hashed: Callable[[Column], Column] = digest) -> DataFrame:
    """One row per document: id, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Documents are grouped by a 128-bit hash of the text. Only texts whose hash occurs again are
    shuffled: grouping them by hash and text compares their bytes, and copies within a task are
    combined first, so a group that holds a third of all rows moves as one row per task. Texts that
    share a hash without being equal form groups of their own. The smallest id of a group stays
    (the largest with `largest`).

    Null texts count as empty. Null ids never stay where another id is there; a group of null ids
    alone has a null `keep_id` and all its rows are kept. Rows that repeat both id and text are all
    reported, all kept or all dropped. An empty table gives an empty result; further columns are ignored.
    """
    best = F.max if largest else F.min
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("hash", hashed(F.col("text")))
    again = stored(rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "again")
    classes = (rows.join(bounded(again), "hash").groupBy("hash", "text")
               .agg(F.count("*").alias("n"), best("id").alias("keep")))
    groups = stored(classes.groupBy("hash").agg(F.count("*").alias("classes"), F.max("n").alias("n"), best("keep").alias("keep")), "groups")
    narrow = rows.select("id", "hash", F.sha2("text", 256).alias("sha"))
    found = narrow.join(groups, "hash", "left")
    whole = found.where("coalesce(classes, 1) = 1")
    if groups.where("classes > 1").limit(1).count():
        collided = groups.where("classes > 1").select("hash")
        told = rows.join(collided, "hash").join(classes.select("hash", "text", "n", "keep"), ["hash", "text"])
        whole = (whole.select("id", "sha", "n", "keep")
                 .unionByName(told.select("id", F.sha2("text", 256).alias("sha"), "n", "keep")))
    alone = F.col("n").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep"))
    return whole.select(F.col("id").alias(id_col), keep.alias("keep_id"),
                        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                        F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = False) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    key, sha = "__id", "__sha"
    gone = stored(exact_groups(docs, id_col, text_col, largest).where("not kept")
                  .select(F.col(id_col).alias(key), F.col("text_sha256").alias(sha)).distinct(), "gone")
    return docs.join(bounded(gone), F.col(id_col).eqNullSafe(F.col(key)) & (F.sha2(text_of(text_col), 256) == F.col(sha)), "left_anti")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of those that repeat both id and text (null as empty), with all columns; which of them is open. Only rows
    that repeat are shuffled."""
    key, sha = "__id", "__sha"
    found = F.sha2(text_of(text_col), 256)
    twice = stored(docs.groupBy(F.col(id_col).alias(key), found.alias(sha)).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "twice")
    same = F.col(id_col).eqNullSafe(F.col(key)) & (found == F.col(sha))
    one = docs.join(bounded(twice), same, "left_semi").withColumn(sha, found).dropDuplicates([id_col, sha]).drop(sha)
    return docs.join(bounded(twice), same, "left_anti").unionByName(one)
