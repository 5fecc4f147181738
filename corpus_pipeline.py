"""From raw documents to packed sequences: each stage applies one operator to all that the stage before kept.

All stages treat null texts as empty and null ids as one id, return an empty table for an empty one, and pass on the
columns of `docs` whatever their names. Rows that repeat id and text leave the exact stage once. The packing stage
returns pieces instead.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import exact, jaccard, language, packing, suffixes
from parley.llm.common import held_out
from parley.llm.queries import vocabulary_path
from parley.session import shared_dir


def under_own_names(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply an operator that adds columns to `docs` under names that none of its columns can clash with."""
    plain = {name: f"own_{i}" for i, name in enumerate(docs.columns) if name not in ("doc_id", "text", "lang")}
    return operator(docs.withColumnsRenamed(plain)).withColumnsRenamed({v: k for k, v in plain.items()})


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without text or without a letter go."""
    samples = language.sample(docs.where(~held_out("doc_id", 4)))

    def known(rows: DataFrame) -> DataFrame:
        return language.identify(rows, samples).where(F.col("lang_pred") != language.UNDETERMINED).select(*rows.columns)

    return under_own_names(docs, known)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays, once if its row repeats."""
    return exact.drop_repeats(exact.drop_copies(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle Jaccard of at least 0.8 the one with the smallest id stays."""
    return jaccard.one_of_each_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that also start earlier are cut out of the texts; no document goes, and `n_chars` counts
    what is left, where there is such a column."""
    cut = under_own_names(docs, lambda rows: suffixes.remove_repeats(rows, keep_columns=True))
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 ids."""
    return packing.pack(docs, vocabulary_path())


STAGES = [("language ID", known_language), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies),
          ("suffix-array dedup", repeated_passages), ("packing", packed)]

#: No SQL expresses language models, sampled joins or tokenizers; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/stage-{name.replace(' ', '-')}-{uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
