"""Matching sentence vectors with topics, and ranking what matched."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from parley.operators.lookup import same_keys
from parley.session import cut

THRESHOLD = 0.35
TOP = 10
# Topic vectors are sent to every task only if proven to stay within these bounds.
MAX_TOPICS = 4096
MAX_MATRIX_BYTES = 64 << 20
BLOCK_TOPICS = 2048
GROUP_SENTENCES = 20_000
# One aggregate per dimension stays within generated code up to about this width.
MAX_WIDE_DIM = 128


def topic_centroids(phrases: DataFrame, topic: str = "topic", vector: str = "vector", dim: int | None = None) -> DataFrame:
    """Mean of all phrase vectors of a topic, combined before the shuffle.

    With `dim` given, only vectors of that length count; every dimension is an aggregate of its own and no vector is
    taken apart. Null vectors count for nothing.
    """
    phrases = phrases.filter(F.col(vector).isNotNull())
    if dim is not None:
        phrases = phrases.filter(F.size(vector) == dim)
    if dim is not None and dim <= MAX_WIDE_DIM:
        means = phrases.groupBy(topic).agg(*[F.avg(F.get(vector, F.lit(i))).alias(f"_{i}") for i in range(dim)])
        return means.select(topic, F.array(*[f"_{i}" for i in range(dim)]).alias(vector))
    parts = phrases.select(topic, F.posexplode(vector).alias("_pos", "_x"))
    means = parts.groupBy(topic, "_pos").agg(F.avg("_x").alias("_x"))
    ranked = means.groupBy(topic).agg(F.array_sort(F.collect_list(F.struct("_pos", "_x"))).alias("_v"))
    return ranked.select(topic, F.transform("_v", lambda p: p["_x"]).alias(vector))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors as rows of length one; a zero vector becomes a row of NaN and matches nothing."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), -1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _small_matrix(topics: DataFrame) -> tuple[list, np.ndarray] | None:
    """Names and unit vectors if they fit the bound, else None. At most the bound is fetched."""
    table = topics.select("topic", "vector").limit(MAX_TOPICS + 1).toArrow()
    if table.num_rows > MAX_TOPICS or table.nbytes > MAX_MATRIX_BYTES or not table.num_rows:
        return None
    table = table.sort_by("topic")
    return table.column("topic").to_pylist(), _matrix(table.column("vector"))


def _score_batches(sentences: DataFrame, names: list, unit: np.ndarray, topic: T.DataType, threshold: float | None) -> DataFrame:
    """One matrix product per batch; emits hits only, or the best topic if `threshold` is None."""
    shared = sentences.sparkSession.sparkContext.broadcast((np.array(names, dtype=object), unit))
    keys = [f for f in sentences.schema.fields if f.name != "vector"]
    schema = T.StructType([*keys, T.StructField("topic", topic), T.StructField("cosine", T.DoubleType())])
    arrow_type = to_arrow_type(topic)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_, unit_ = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            cosines = _matrix(batch.column("vector")) @ unit_.T
            if threshold is None:
                known = ~np.isnan(cosines).all(axis=1)
                rows = np.flatnonzero(known)
                # argmax takes the first of equals, and the names are sorted.
                cols = np.nanargmax(cosines[rows], axis=1) if len(rows) else rows
            else:
                rows, cols = np.nonzero(cosines > threshold)
            out = [batch.column(f.name).take(pa.array(rows)) for f in keys]
            out.append(pa.array(names_[cols].tolist(), arrow_type))
            out.append(pa.array(cosines[rows, cols], pa.float64()))
            yield pa.RecordBatch.from_arrays(out, [f.name for f in keys] + ["topic", "cosine"])

    return sentences.mapInArrow(score, schema)


def _score_blocks(sentences: DataFrame, topics: DataFrame, threshold: float | None) -> DataFrame:
    """The same hits for topics of any number; without a threshold, the best topic of each block.

    Topics are dealt into blocks and sentences into groups, both of bounded size; each pair of
    a block and a group meets in one task, which holds only those two.
    """
    n_blocks = max(1, -(-topics.count() // BLOCK_TOPICS))
    n_groups = max(1, -(-sentences.count() // GROUP_SENTENCES))
    keys = [f for f in sentences.schema.fields if f.name != "vector"]
    left = sentences.withColumns({
        "_group": F.pmod(F.xxhash64(*[f.name for f in keys]), F.lit(n_groups)),
        "_block": F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))})
    right = topics.select("topic", "vector").withColumns({
        "_block": F.pmod(F.xxhash64("topic"), F.lit(n_blocks)).cast("int"),
        "_group": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long")))})
    topic_type = topics.schema["topic"].dataType.simpleString()
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in keys] + [f"topic {topic_type}", "cosine double"])
    names = [f.name for f in keys]

    def unit(vectors: pd.Series) -> np.ndarray:
        rows = np.stack(vectors.to_numpy()).astype("float64")
        with np.errstate(invalid="ignore", divide="ignore"):
            return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    def meet(group: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if group.empty or block.empty:
            return pd.DataFrame(columns=[*names, "topic", "cosine"])
        block = block.sort_values("topic")
        cosines = unit(group["vector"]) @ unit(block["vector"]).T
        if threshold is None:
            rows = np.flatnonzero(~np.isnan(cosines).all(axis=1))
            cols = np.nanargmax(cosines[rows], axis=1) if len(rows) else rows
        else:
            rows, cols = np.nonzero(cosines > threshold)
        out = group[names].iloc[rows].reset_index(drop=True)
        return out.assign(topic=block["topic"].to_numpy()[cols], cosine=cosines[rows, cols])

    return left.groupBy("_block", "_group").cogroup(right.groupBy("_block", "_group")).applyInPandas(meet, schema)


def _known(sentences: DataFrame, topics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vectors of the length that most topics have; others have no cosine with them and match nothing."""
    size = F.size("vector")
    dim = topics.filter(F.col("vector").isNotNull()).agg(F.mode(size, True)).first()[0]
    fits = F.lit(False) if dim is None else F.coalesce(size == dim, F.lit(False))
    return sentences.filter(fits), topics.filter(fits)


def match_topics(sentences: DataFrame, topics: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every sentence and topic whose cosine is above `threshold`, as `(keys, topic, cosine)`.

    Sentences have any key columns and `vector`; topics have `topic` and `vector`. Sentences
    stay where they are while the topics fit in `MAX_MATRIX_BYTES`.
    """
    sentences, topics = _known(sentences, topics)
    small = _small_matrix(topics)
    if small is None:
        return _score_blocks(sentences, topics, threshold)
    return _score_batches(sentences, *small, topics.schema["topic"].dataType, threshold)


def centroid_assign(sentences: DataFrame, topics: DataFrame) -> DataFrame:
    """The nearest topic of each sentence; ties go to the first topic."""
    sentences, topics = _known(sentences, topics)
    small = _small_matrix(topics)
    if small is not None:
        return _score_batches(sentences, *small, topics.schema["topic"].dataType, None)
    keys = [c for c in sentences.columns if c != "vector"]
    winner = F.struct(-F.col("cosine"), F.col("topic"))
    # Equal keys are rows of their own; the stored numbers stay the same when a task is run again.
    numbered = cut(sentences.withColumn("_row", F.monotonically_increasing_id()))
    winners = _score_blocks(numbered, topics, None)
    found = winners.groupBy("_row", *keys).agg(F.min_by("topic", winner).alias("topic"), F.max("cosine").alias("cosine"))
    return found.drop("_row")


def top_topics(hits: DataFrame, call: str = "call_id", position: str = "pos", n: int = TOP) -> DataFrame:
    """The best `n` hits of a call; a topic may repeat. Map tasks pass on `n` rows per call at most."""
    order = Window.partitionBy(call).orderBy(F.desc("cosine"), position, "topic")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def topic_list(hits: DataFrame, call: str = "call_id", position: str = "pos", n: int = TOP) -> DataFrame:
    """The best `n` hits of a call as an ordered list of topics."""
    ranked = top_topics(hits, call, position, n)
    return ranked.groupBy(call).agg(F.array_sort(F.collect_list(F.struct("rank", "topic"))).alias("_t")).select(
        call, F.transform("_t", lambda t: t["topic"]).alias("topics"))


def primary_secondary(scores: DataFrame, call: str = "call_id", score: str = "score", distinct: bool = True) -> DataFrame:
    """First and second topic by score, with the texts used where there is none."""
    if distinct:
        scores = scores.groupBy(call, "topic").agg(F.max(score).alias(score))
    order = Window.partitionBy(call).orderBy(F.desc(score), "topic")
    ranked = scores.withColumn("_rank", F.row_number().over(order)).filter("_rank <= 2")

    def at(rank: int, default: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("_rank") == rank, F.col("topic").cast("string"))), F.lit(default))

    return ranked.groupBy(call).agg(at(1, "Unidentified").alias("primary_topic"), at(2, "None").alias("secondary_topic"))


def softmax_scores(scores: DataFrame, call: str = "call_id", score: str = "score") -> DataFrame:
    """Scores of a call's topics as probabilities that add up to one; rows without a call belong together.

    Scores of a call are summed by their whole part, each as a power above it; such sums merge within map tasks, so a
    call of any size is no single task. The largest whole part is then taken off, so no exponential overflows.
    A null score has no probability and counts for nothing.
    """
    whole = F.floor(score).cast("double")
    parts = scores.filter(F.col(score).isNotNull()).groupBy(call, whole.alias("_whole")).agg(F.sum(F.exp(F.col(score) - whole)).alias("_sum"))
    tops = parts.groupBy(call).agg(F.max("_whole").alias("_top"), F.collect_list(F.struct("_whole", "_sum")).alias("_parts"))
    total = F.aggregate("_parts", F.lit(0.0), lambda a, p: a + p["_sum"] * F.exp(p["_whole"] - F.col("_top")))
    tops = tops.select(call, "_top", total.alias("_total"))
    return same_keys(scores, tops, [call], "left").withColumn("probability", F.exp(F.col(score) - F.col("_top")) / F.col("_total")).drop("_top", "_total")


def detect_language(scores: DataFrame, call: str = "call_id") -> DataFrame:
    """The likeliest language; ties go to the first code."""
    return scores.groupBy(call).agg(
        F.min_by("language", F.struct(-F.col("probability"), F.col("language"))).alias("language"),
        F.max("probability").alias("probability"))
