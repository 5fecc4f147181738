"""Comparing text before and after correction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.text import pieces, sentences, tidy_sentence


def sentence_edits(df: DataFrame, text: str = "text") -> DataFrame:
    """Each sentence, its correction, and how far apart they are."""
    keys = [c for c in df.columns if c != text]
    rows = df.select(*keys, F.posexplode(sentences(F.col(text))).alias("pos", "original"))
    rows = rows.withColumn("corrected", tidy_sentence(F.col("original")))
    before, after = pieces(F.col("original")), pieces(F.col("corrected"))
    return rows.withColumns({
        "changed": F.col("original") != F.col("corrected"),
        # Equal texts, the usual case, skip the quadratic comparison.
        "distance": F.when(F.col("original") == F.col("corrected"), 0).otherwise(F.levenshtein("original", "corrected")),
        "words_removed": F.size(F.array_except(before, after)),
        "words_added": F.size(F.array_except(after, before))})


def edit_audit(df: DataFrame, call: str = "call_id", text: str = "text") -> DataFrame:
    """Edits rolled up per call."""
    return sentence_edits(df.select(call, text), text).groupBy(call).agg(
        F.count(F.lit(1)).alias("sentences"), F.sum(F.col("changed").cast("int")).alias("changed"),
        F.sum("distance").alias("distance"), F.sum("words_removed").alias("words_removed"),
        F.sum("words_added").alias("words_added"))
