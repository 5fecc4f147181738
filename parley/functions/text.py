"""Scalar text and time functions on columns."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.arrays import bind

SENTENCE_BREAK = "[.!?] "
BLANKS = r"(?U)\s+"
# Letters, digits, underscore, white space and full stop survive a clean-up.
NOT_SUMMARY_TEXT = r"(?U)[^\p{L}\p{N}_\s.]"
WORD = r"[\p{L}\p{N}_]+"


def to_text(col: Column) -> Column:
    return col.cast("string")


def strip(col: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def pieces(col: Column) -> Column:
    """Non-empty white-space separated pieces."""
    return F.filter(F.split(col, BLANKS), lambda p: p != "")


def words(col: Column) -> Column:
    """Lower-case words without punctuation."""
    return F.regexp_extract_all(F.lower(col), F.lit(WORD), F.lit(0))


def sentences(col: Column) -> Column:
    """Split after a sentence mark and a blank; a trailing empty piece is kept."""
    return F.split(col, SENTENCE_BREAK)


def period_chunks(col: Column, min_words: int = 0) -> Column:
    """Pieces between full stops with at least `min_words` words."""
    chunks = F.split(col, r"\.")
    return F.filter(chunks, lambda c: has_words(c, min_words)) if min_words else chunks


def has_words(col: Column, n: int) -> Column:
    return F.size(pieces(col)) >= n


def clean_summary(col: Column) -> Column:
    return F.regexp_replace(col, NOT_SUMMARY_TEXT, "")


def map_sentences(col: Column, fn: Callable[[Column], Column]) -> Column:
    """Apply `fn` to each sentence and put a blank after every one."""
    return F.concat(F.array_join(F.transform(sentences(col), fn), " "), F.lit(" "))


def tidy_sentence(col: Column) -> Column:
    """Rule baseline for grammar correction: drop doubled words, fix spacing around marks."""
    def undouble(parts: Column) -> Column:
        return F.filter(parts, lambda word, i: (i == 0) | (F.lower(word) != F.lower(F.get(parts, i - 1))))

    return F.regexp_replace(F.array_join(bind(pieces(col), undouble), " "), r" +([,;:])", "$1")


def rewrite_matches(col: Column, pattern: str, fn: Callable[[Column], Column]) -> Column:
    """Replace each match of `pattern` by `fn(match)`."""
    def rewrite(found: Column) -> Column:
        return F.array_join(
            F.zip_with(F.split(col, pattern, -1), F.transform(found, fn),
                       lambda gap, match: F.concat(gap, F.coalesce(match, F.lit("")))), "")

    return bind(F.regexp_extract_all(col, F.lit(pattern), F.lit(0)),
                lambda found: F.when(F.size(found) == 0, col).otherwise(rewrite(found)))


def format_timestamp(seconds: Column, always_hours: bool = False, marker: str = ".") -> Column:
    """`[HH:]MM:SS.mmm`; milliseconds round half to even; negative input is an error."""
    ms = F.bround(seconds * 1000.0).cast("long")
    hours = F.floor(ms / 3_600_000)
    head = F.format_string("%02d:", hours)
    tail = F.format_string(
        "%02d:%02d" + marker.replace("%", "%%") + "%03d",
        F.floor((ms % 3_600_000) / 60_000), F.floor((ms % 60_000) / 1000), ms % 1000)
    text = F.concat(head, tail) if always_hours else F.concat(F.when(hours > 0, head).otherwise(""), tail)
    return F.when(seconds < 0, F.raise_error("non-negative time expected").cast("string")).otherwise(text)


def samples_to_seconds(samples: Column, rate: int = 16_000) -> Column:
    return samples / F.lit(float(rate))


def seconds_to_samples(seconds: Column, rate: int = 16_000) -> Column:
    """Whole samples, cut towards zero."""
    return (seconds * F.lit(rate)).cast("long")


def round2(col: Column) -> Column:
    """Nearest hundredth of the exact binary value; only a true tie goes to the even one.

    `bround` rounds the printed decimals, so it sees ties (1.005) where the value is off one.
    """
    low = F.floor(col * 100)
    middle = (low * 2 + 1) / F.lit(200.0)
    # Which side of the true middle its nearest double lies on, from an exact split product.
    spread = middle * F.lit(134217729.0)
    high = spread - (spread - middle)
    side = (high * 200 - (low * 2 + 1)) + (middle - high) * 200
    up = F.when(col != middle, col > middle).when(side != 0, side > 0).otherwise(low % 2 != 0)
    return F.when(up, low + 1).otherwise(low) / F.lit(100.0)


@F.pandas_udf(T.DoubleType())
def compression_ratio(text: pd.Series) -> pd.Series:
    """Bytes over zlib-compressed bytes; Spark has no built-in compressor."""
    def ratio(value):
        if value is None:
            return None
        data = value.encode("utf-8")
        return len(data) / len(zlib.compress(data))

    return text.map(ratio)


def is_repetitive(col: Column, threshold: float = 2.4) -> Column:
    return compression_ratio(col) > threshold
