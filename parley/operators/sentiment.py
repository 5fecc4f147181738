"""Lexicon sentiment of sentences, segments and calls."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.arrays import bind
from parley.functions.text import sentences, words
from parley.operators.lookup import lookup
from parley.operators.segments import nested_segments

LABELS = ("positive", "negative", "neutral")
POSITIVE_FROM, NEGATIVE_FROM = 0.05, -0.05

# A small general lexicon; pass another as a mapping or, for any size, as a table.
LEXICON = {
    "good": 1.0, "great": 1.0, "excellent": 1.0, "happy": 1.0, "helpful": 1.0, "thanks": 0.5, "thank": 0.5,
    "pleased": 1.0, "resolved": 0.5, "perfect": 1.0, "bad": -1.0, "terrible": -1.0, "angry": -1.0,
    "unhappy": -1.0, "problem": -0.5, "issue": -0.5, "wrong": -0.5, "frustrated": -1.0, "late": -0.5, "broken": -1.0,
}


def label(total: Column, count: Column) -> Column:
    """Label of the mean weight of matched words; a sentence without one is neutral."""
    polarity = F.when(count > 0, total / count).otherwise(0.0)
    return (F.when(polarity >= POSITIVE_FROM, LABELS[0])
            .when(polarity <= NEGATIVE_FROM, LABELS[1]).otherwise(LABELS[2]))


def sentence_label(sentence: Column, lexicon: Mapping[str, float] = LEXICON) -> Column:
    """Label of one sentence, computed in its own row.

    Words of equal weight are tested as one set, which Spark looks up by hash.
    """
    by_weight = defaultdict(list)
    for word, weight in lexicon.items():
        by_weight[float(weight)].append(word)
    state = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n"))

    def add(acc: Column, word: Column) -> Column:
        weight = F.lit(None).cast("double")
        for value, members in by_weight.items():
            weight = F.when(word.isin(members), F.lit(value)).otherwise(weight)
        return F.struct((acc["total"] + F.coalesce(weight, F.lit(0.0))).alias("total"),
                        (acc["n"] + weight.isNotNull().cast("int")).alias("n"))

    return F.aggregate(words(sentence), state, add, lambda acc: label(acc["total"], acc["n"]))


def most_frequent_label(labels: Column) -> Column:
    """Most frequent label of an array; of equals the one seen first."""
    def rank(name: str) -> Column:
        count = F.size(F.filter(labels, lambda x: x == name))
        return F.struct((-count).alias("n"), F.array_position(labels, name).alias("first"), F.lit(name).alias("name"))

    # A label that does not occur has count 0 and never precedes one that does.
    return F.array_min(F.array(*[rank(name) for name in LABELS]))["name"]


def sentence_sentiment(df: DataFrame, text: str = "text", lexicon: Mapping[str, float] = LEXICON) -> DataFrame:
    """One row per sentence with its label; no shuffle."""
    keys = [c for c in df.columns if c != text]
    rows = df.select(*keys, F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))
    return rows.withColumn("label", sentence_label(F.col("sentence"), lexicon))


def segment_sentiment_mode(df: DataFrame, text: str = "text", lexicon: Mapping[str, float] = LEXICON) -> DataFrame:
    """Most frequent sentence label of each segment; no shuffle, as a segment is one row."""
    labels = F.transform(sentences(F.col(text)), lambda s: sentence_label(s, lexicon))
    return df.withColumn("sentiment", bind(labels, most_frequent_label))


def score_lexicon(tokens: DataFrame, lexicon: DataFrame, keys: list[str], word: str = "word") -> DataFrame:
    """Sum and count of matched weights per key, for a lexicon table of any size."""
    tokens = tokens.groupBy(*keys, word).agg(F.count(F.lit(1)).alias("_n"))
    scored = lookup(tokens, lexicon, word, F.struct(*keys))
    weight = F.col("weight")
    return scored.groupBy(*keys).agg(
        F.coalesce(F.sum(weight * F.col("_n")), F.lit(0.0)).alias("total"),
        F.coalesce(F.sum(F.when(weight.isNotNull(), F.col("_n"))), F.lit(0)).alias("matched"),
        F.sum("_n").alias("n_words"))


def call_sentiment_array(df: DataFrame, call: str = "call_id", number: str = "segment_no", text: str = "text",
                         lexicon: Mapping[str, float] = LEXICON) -> DataFrame:
    """Segments of a call in order, each with its sentiment."""
    return nested_segments(segment_sentiment_mode(df, text, lexicon), [text, "sentiment"], call, number)
