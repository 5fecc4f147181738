"""Extractive summaries ranked by term frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.arrays import bind, running_sums
from parley.functions.text import BLANKS, SENTENCE_BREAK, sentences
from parley.operators.filters import NO_SUMMARY, status_default
from parley.operators.segments import token_chunks

MAX_TOKENS = 150
WHOLE_TOKENS = 30


def _has_at_most(text: Column, n: int) -> Column:
    """Whether the sentences of a text have at most `n` tokens together.

    A sentence break parts tokens as a blank does. Splitting stops once the answer is known:
    of `n` + 3 parts only the first and the last can be empty.
    """
    parts = F.split(F.regexp_replace(text, SENTENCE_BREAK, " "), BLANKS, n + 3)
    return F.size(F.filter(parts, lambda p: p != "")) <= n


def _scores(tokens: Column) -> Column:
    """For each sentence of `array<array<string>>` the mean frequency of its tokens in the whole text, and their number."""
    placed = F.flatten(F.transform(tokens, lambda own, pos: F.transform(own, lambda t: F.struct(t.alias("token"), pos.alias("pos")))))

    def counted(line: Column) -> Column:
        """Equal tokens stand together: each occurrence takes the length of its run along to its sentence."""
        heads = F.filter(F.sequence(F.lit(0), F.size(line) - 1), lambda i: (i == 0) | (F.get(line, i)["token"] != F.get(line, i - 1)["token"]))
        return bind(heads, lambda h: F.flatten(F.transform(h, lambda at, nth: bind(
            F.coalesce(F.get(h, nth + 1), F.size(line)) - at,
            lambda tf: F.transform(F.slice(line, at + 1, tf), lambda x: F.struct(x["pos"].alias("pos"), tf.alias("tf")))))))

    def scored(counts: Column) -> Column:
        return bind(running_sums(F.transform(tokens, F.size)), lambda upto: F.transform(tokens, lambda own, pos: F.struct(
            (F.aggregate(F.slice(counts, F.get(upto, pos) - F.size(own) + 1, F.size(own)), F.lit(0).cast("long"), lambda a, x: a + x["tf"])
             / F.greatest(F.size(own), F.lit(1))).alias("score"), F.size(own).alias("n"))))

    return bind(bind(bind(placed, lambda p: F.array_sort(p)), counted), lambda counts: bind(F.array_sort(counts), scored))


def _picked(parts: Column, scores: Column, max_tokens: int) -> Column:
    """Best sentences that fit together into `max_tokens`, the very best one in any case, in their order."""
    ranked = F.array_sort(F.filter(F.transform(scores, lambda x, pos: F.struct((-x["score"]).alias("rank"), pos.alias("pos"), x["n"].alias("n"))), lambda x: x["n"] > 0))

    def fitting(top: Column) -> Column:
        return bind(running_sums(F.transform(top, lambda x: x["n"])), lambda used: F.filter(
            top, lambda x, i: (i == 0) | (F.get(used, i) <= max_tokens)))

    chosen = F.array_sort(F.transform(bind(F.slice(ranked, 1, max_tokens), fitting), lambda x: x["pos"]))
    return F.array_join(F.transform(chosen, lambda pos: F.get(parts, pos)), " ")


def summarised(text: Column, max_tokens: int = MAX_TOKENS, whole_tokens: int = WHOLE_TOKENS) -> Column:
    """Summary of one text: short ones whole, a missing or empty one by the default, long ones by their best sentences."""
    def best(parts: Column) -> Column:
        tokens = F.transform(parts, lambda s: F.filter(F.split(F.lower(s), BLANKS), lambda t: t != ""))
        return bind(tokens, lambda own: bind(_scores(own), lambda scores: _picked(parts, scores, max_tokens)))

    short = F.coalesce(_has_at_most(text, whole_tokens), F.lit(True))  # a null text takes the default
    return F.when(short, status_default(text, NO_SUMMARY)).otherwise(bind(sentences(text), best))


def extractive_summary(df: DataFrame, keys: list[str], text: str = "text", max_tokens: int = MAX_TOKENS,
                       whole_tokens: int = WHOLE_TOKENS) -> DataFrame:
    """Best sentences of each text within a token budget, in their order.

    A sentence scores the mean frequency of its tokens in the text. Texts of few tokens are kept whole. All is done in
    the row: one scan, no shuffle; every row has its summary, whatever its keys, which may be null or repeat.
    """
    return df.select(*keys, summarised(F.col(text), max_tokens, whole_tokens).alias("summary"))


def summary_by_chunk(df: DataFrame, key: str, text: str = "text", chunk_tokens: int = 1000,
                     max_tokens: int = MAX_TOKENS, whole_tokens: int = WHOLE_TOKENS) -> DataFrame:
    """Summaries of fixed chunks of a text, joined in order; a text without tokens takes the default. One scan, no shuffle."""
    parts = F.transform(token_chunks(F.col(text), chunk_tokens), lambda c: summarised(c, max_tokens, whole_tokens))
    without = F.coalesce(_has_at_most(F.col(text), 0), F.lit(True))
    return df.select(key, F.when(without, F.lit(NO_SUMMARY)).otherwise(F.array_join(parts, " ")).alias("summary"))
