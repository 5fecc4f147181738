"""Names of people, places and organisations from a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.arrays import bind
from parley.functions.pii import match_ends
from parley.functions.text import WORD
from parley.operators.lookup import lookup


def located_words(text: Column) -> Column:
    """Lower-case words of a text with their offsets, as `array<struct<word,start,end>>`."""
    return bind(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda found: F.zip_with(
        match_ends(F.split(text, WORD, -1), found), found, lambda end, word: F.struct(
            F.lower(word).alias("word"), (end - F.length(word)).alias("start"), end.alias("end"))))


def tag_gazetteer(df: DataFrame, names: DataFrame, text: str = "text") -> DataFrame:
    """Spans `(keys, entity, start, end)` of words listed in `names (word, entity)`, any number of them."""
    keys = [c for c in df.columns if c != text]
    tokens = df.select(*keys, F.explode(located_words(F.col(text))).alias("_w")).select(*keys, "_w.*")
    return lookup(tokens, names, "word", F.struct(*keys, "start"), how="inner").select(*keys, "entity", "word", "start", "end")
