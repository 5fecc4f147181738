"""Assembling the call table and its report from the stages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.filters import NO_SENTIMENT, NO_SUMMARY, NO_TOPIC
from parley.operators.lookup import same_keys
from parley.operators.names import redact_names
from parley.operators.segments import concat_segments, nested_segments
from parley.operators.sentiment import LEXICON, segment_sentiment_mode
from parley.operators.summary import summarised
from parley.operators.topics import match_topics, primary_secondary, softmax_scores, topic_list
from parley.plans.stages import StageStore, content_digests, table_digest
from parley.session import cut, spread

TEXT_DEFAULTS = {"summary": NO_SUMMARY, "primary_topic": "Unidentified", "secondary_topic": "None",
                 "sentiment": NO_SENTIMENT}


def join_stages(calls: DataFrame, *stages: DataFrame, call: str = "call_id") -> DataFrame:
    """One row per call with the columns of every stage; texts no stage gave get their default.

    All tables have one row per call, so they share one partitioning and no key is hot.
    """
    for stage in stages:
        calls = calls.join(stage, call, "left")
    return calls.fillna({c: d for c, d in TEXT_DEFAULTS.items() if c in calls.columns})


def call_sentiment(segments: DataFrame, call: str = "call_id", number: str = "segment_no") -> DataFrame:
    """Most frequent segment sentiment of a call; of equals the one that came first."""
    labels = segments.groupBy(call, "sentiment").agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("first"))
    return labels.groupBy(call).agg(
        F.min_by("sentiment", F.struct(-F.col("n"), F.col("first"))).alias("sentiment"))


def call_report(calls: DataFrame) -> DataFrame:
    """Calls per primary topic and sentiment, with all subtotals; `level` tells which columns are totalled."""
    return calls.cube("primary_topic", "sentiment").agg(
        F.count(F.lit(1)).alias("n_calls"), F.grouping_id().cast("int").alias("level"))


def topic_chances(hits: DataFrame, call: str = "call_id") -> DataFrame:
    """Topics of a call with their probabilities, likeliest first; a topic counts with its best hit."""
    best = hits.groupBy(call, "topic").agg(F.max("cosine").alias("score"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("probability")).alias("rank"), F.col("topic").cast("string").alias("topic"))))
    rows = softmax_scores(best, call).groupBy(call).agg(ranked.alias("_ranked"))  # as long as there are topics
    return rows.select(call, F.transform("_ranked", lambda t: F.struct(t["topic"].alias("topic"), (-t["rank"]).alias("probability"))).alias("topic_with_probabilities"))


def process_calls(segments: DataFrame, vectors: DataFrame, topics: DataFrame, names: DataFrame, folder: str,
                  threshold: float = 0.35, lexicon: Mapping[str, float] = LEXICON) -> DataFrame:
    """The call table from raw segments: `call_id`, `transcription`, `summary`, `segments`, `sentiment`, `primary_topic`,
    `secondary_topic`, `topics`, `topic_with_probabilities`.

    `segments` are `(call_id, segment_no, text)`, `vectors` the sentences' `(call_id, pos, vector)`, `topics` `(topic,
    vector)` and `names` `(name, entity)`. Segments are redacted before anything else is made of them or written, and
    transcript, summary and sentiment come from the redacted text alone. Each stage is stored in `folder` per call under
    a digest of its input: a rerun reads what is there and works on new and changed calls only; other names, topics or
    settings make other stages.

    Rows without a call are one call. A call without text, hits or sentiment has the default texts, and no topic's
    probability. Empty segments give an empty table; vectors of calls without segments are left out.
    """
    call = ["call_id"]
    store = StageStore(segments.sparkSession, folder)
    talk = cut(content_digests(segments, "call_id", ["segment_no", "text"]))
    said = cut(same_keys(content_digests(vectors, "call_id", ["pos", "vector"]), talk, call, "left_semi"))
    listed, known = table_digest(names, ["name", "entity"]), table_digest(topics, ["topic", "vector"])

    def redacted(some: DataFrame) -> DataFrame:
        rows = spread(same_keys(segments.select("call_id", "segment_no", "text"), some, call, "left_semi"))
        return redact_names(rows, names).select("call_id", "segment_no", F.col("redacted").alias("text"))

    clean = store.run("redacted", talk, redacted, listed)

    def transcripts(some: DataFrame) -> DataFrame:
        whole = concat_segments(same_keys(clean, some, call, "left_semi"))
        return whole.withColumn("summary", summarised(F.col("transcription")))

    def sentiments(some: DataFrame) -> DataFrame:
        labelled = segment_sentiment_mode(same_keys(clean, some, call, "left_semi"), lexicon=lexicon)
        return same_keys(nested_segments(labelled, ["text", "sentiment"]), call_sentiment(labelled), call)

    def found(some: DataFrame) -> DataFrame:
        hits = cut(match_topics(same_keys(vectors, some, call, "left_semi"), topics, threshold))
        rows = primary_secondary(hits.withColumnRenamed("cosine", "score"))
        return same_keys(same_keys(rows, topic_list(hits), call), topic_chances(hits), call)

    calls = talk.select("call_id")
    for stage in (store.run("transcripts", talk, transcripts, listed),
                  store.run("sentiments", talk, sentiments, listed, sorted(lexicon.items())),
                  store.run("topics", said, found, known, threshold)):
        calls = same_keys(calls, stage, call, "left")
    none = calls.schema["topic_with_probabilities"].dataType.simpleString()
    return calls.fillna(TEXT_DEFAULTS).withColumns({
        "topics": F.coalesce(F.transform("topics", lambda t: t.cast("string")), F.array(F.lit(NO_TOPIC))),
        "topic_with_probabilities": F.coalesce("topic_with_probabilities", F.array().cast(none))})
