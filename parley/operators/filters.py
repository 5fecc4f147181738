"""Row filters, projections and set operations on calls and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.text import strip

# Accepted language codes.
LANGUAGE_CODES = (
    "af", "am", "ar", "as", "az", "ba", "be", "bg", "bn", "bo", "br", "bs", "ca", "cs", "cy", "da", "de", "el",
    "en", "es", "et", "eu", "fa", "fi", "fo", "fr", "gl", "gu", "ha", "haw", "he", "hi", "hr", "ht", "hu", "hy",
    "id", "is", "it", "ja", "jw", "ka", "kk", "km", "kn", "ko", "la", "lb", "ln", "lo", "lt", "lv", "mg", "mi",
    "mk", "ml", "mn", "mr", "ms", "mt", "my", "ne", "nl", "nn", "no", "oc", "pa", "pl", "ps", "pt", "ro", "ru",
    "sa", "sd", "si", "sk", "sl", "sn", "so", "sq", "sr", "su", "sv", "sw", "ta", "te", "tg", "th", "tk", "tl",
    "tr", "tt", "uk", "ur", "uz", "vi", "yi", "yo", "zh", "yue",
)

NO_SENTIMENT = "No Sentiment Identified"
NO_TOPIC = "UNIDENTIFIED"
NO_SUMMARY = "Summary not generated for this transcription"


def filter_min_duration(df: DataFrame, seconds: int = 60, duration: str = "duration") -> DataFrame:
    """Keep recordings longer than `seconds`; a duration that is no number does not count."""
    return df.filter(F.col(duration).try_cast("int") > seconds)


def filter_date_range(df: DataFrame, after: str, before: str, created: str = "date_created") -> DataFrame:
    """Keep rows from UTC midnight of `after` to UTC midnight of `before`, both included."""
    low, high = (F.to_timestamp(F.lit(day[:10]), "yyyy-MM-dd") for day in (after, before))
    return df.filter(F.col(created).between(low, high))


def project_segment(df: DataFrame) -> DataFrame:
    """Reduce wide segments to time, text and no-speech probability."""
    key = [c for c in df.columns if c in ("call_id", "segment_no")]
    return df.select(*key, "start", "end", "text", F.col("no_speech_prob").alias("no_speech_probability"))


def drop_empty_segments(df: DataFrame) -> DataFrame:
    return df.filter((F.col("start") != F.col("end")) & (strip(F.col("text")) != ""))


def is_silence(no_speech: float | None = 0.6, logprob: float | None = -1.0) -> Column:
    """A silent segment, unless its text is likely enough. A threshold of None turns its half off."""
    if no_speech is None:
        return F.lit(False)
    silent = F.col("no_speech_prob") > no_speech
    return silent if logprob is None else silent & ~(F.col("avg_logprob") > logprob)


def drop_silence(df: DataFrame, no_speech: float | None = 0.6, logprob: float | None = -1.0) -> DataFrame:
    return df.filter(~is_silence(no_speech, logprob))


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def effective_language(language: Column, multilingual: bool = True) -> Column:
    """A model for English only answers in English whatever is asked."""
    return language if multilingual else F.lit("en")


def validate_language(df: DataFrame, language: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Rows with a known language code, and the rest."""
    known = F.coalesce(F.col(language).isin(*LANGUAGE_CODES), F.lit(False))
    return df.filter(known), df.filter(~known)


def status_default(value: Column, default: str) -> Column:
    """`default` where a text or list is missing or empty."""
    return F.when(F.length(strip(value.cast("string"))) > 0, value.cast("string")).otherwise(default)


def dedupe_keep_first(df: DataFrame, column: str, *order: str) -> DataFrame:
    """One row per value, the first in `order`; nulls are one value.

    Rows are grouped by digest, so long values are not compared while sorting, and each map
    task passes on one row per value only, however many copies it holds.
    """
    digest = F.sha2(F.col(column).cast("string"), 256)
    return (df.withColumn("_digest", digest)
            .withColumn("_rank", F.row_number().over(Window.partitionBy("_digest").orderBy(*order)))
            .filter("_rank = 1").drop("_digest", "_rank"))


def append_calls(calls: DataFrame, more: DataFrame) -> DataFrame:
    return calls.unionByName(more, allowMissingColumns=True)


def taxonomy_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Topics of `a` that `b` lacks."""
    return a.select("topic").distinct().join(b.select("topic").distinct(), "topic", "left_anti")
