"""Finding and masking personal data with regular expressions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.arrays import bind, running_max, running_sums
from parley.functions.text import rewrite_matches


class Pattern(NamedTuple):
    """A recogniser. Texts without the literal `needs`, part of every match, are not searched."""

    entity: str
    regex: str
    score: float
    needs: str = ""

    def only_where_possible(self, text: Column, search: Column, otherwise: Column) -> Column:
        return F.when(F.contains(text, F.lit(self.needs)), search).otherwise(otherwise) if self.needs else search


# Entity, expression and score of each recogniser. The order is the order in
# which the replacement chain applies them, most specific first.
PATTERNS = (
    Pattern("CONFIRMATION_NUMBER", r"confirmation\snumber\s(?:is\s)?((?:\d+|\w+)(?:,\s?(?:\d+|\w+))*)", 0.9),
    Pattern("BILL_AMOUNT", r"\b(?:payment|bill|amount)\s?of\s?\$\s?\d+(?:,\d{3})*(?:\.\d{2})?", 0.6, "$"),
    Pattern("ADDRESS", r"\b\d{1,5}\s([a-zA-Z\s]{1,})\b,?\s([a-zA-Z\s]{1,}),?\s([A-Z]{2}),?\s\d{5}\b", 0.85),
    Pattern("EMAIL_ADDRESS", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", 0.5, "@"),
    Pattern("URL", r"\bhttps?://[^\s<>\"]+", 0.6, "://"),
    Pattern("US_SSN", r"\b\d{3}-\d{2}-\d{4}\b", 0.85),
    Pattern("PHONE_NUMBER", r"\(?\b\d{3}\)?[-.]?\s?\d{3}[-.]?\s?\d{4}\b", 0.5),
    Pattern("DATE", r"\b(?:\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{2,4}[-/]\d{1,2}[-/]\d{1,2}"
                    r"|\b(?:January|February|March|April|May|June|July|August|September|October|November|December)"
                    r"\b\s\d{1,2},?\s\d{4})\b", 0.5),
    Pattern("ACCOUNT_NUMBER", r"\b\d{8,12}\b", 0.5),
    Pattern("DOLLAR_AMOUNT", r"\$\s?\d+(?:,\d{3})*(?:\.\d{2})?", 0.6, "$"),
    Pattern("US_SSN", r"\b\d{4}\b", 0.85),
    Pattern("TITLE", r"\b(?:Mr\.|Mrs\.|Miss\b)", 1.0),
)

# Ignore case, let `.` and `^` see lines, and use Unicode classes and boundaries.
FLAGS = "(?ismU)"

SPAN = "struct<entity:string,start:int,end:int,score:double>"


def match_ends(gaps: Column, found: Column) -> Column:
    """End offsets of the matches `found`, from their lengths and those of the text before each."""
    return running_sums(F.zip_with(F.slice(gaps, 1, F.size(found)), found,
                                   lambda gap, match: F.length(gap) + F.length(match)))


def pii_spans(df: DataFrame, text: str = "text", out: str = "spans",
              patterns: Sequence[Pattern] = PATTERNS) -> DataFrame:
    """Add every match of every pattern as `array<struct<entity,start,end,score>>`.

    Offsets count code points. The matches are their own projection, so each expression runs
    once per row, and texts without a match are not split. One expression places the matches
    of all patterns, which keeps the plan small.
    """
    none = F.when(F.col(text).isNotNull(), F.array().cast("array<string>"))
    found = {f"_found_{i}": p.only_where_possible(
        F.col(text), F.regexp_extract_all(text, F.lit(FLAGS + p.regex), F.lit(0)), none) for i, p in enumerate(patterns)}
    searched = F.array(*[
        F.struct(F.lit(p.entity).alias("entity"), F.lit(p.score).alias("score"), F.col(name).alias("found"),
                 F.when(F.size(name) > 0, F.split(text, FLAGS + p.regex, -1)).alias("gaps"))
        for name, p in zip(found, patterns)])
    hits = F.filter(searched, lambda p: F.size(p["found"]) > 0)
    spans = F.transform(hits, lambda p: F.zip_with(match_ends(p["gaps"], p["found"]), p["found"], lambda end, match: F.struct(
        p["entity"].alias("entity"), (end - F.length(match)).alias("start"), end.alias("end"), p["score"].alias("score"))))
    spans = F.when(F.col(text).isNotNull(), F.flatten(spans).cast(f"array<{SPAN}>"))
    return df.withColumns(found).withColumn(out, spans).drop(*found)


def resolve_spans(spans: Column) -> Column:
    """Make spans disjoint, ordered by start.

    A span inside another goes (of equal spans the higher score, then the entity name, stays);
    overlapping spans of one entity merge; of different entities the earlier one is clipped.
    """
    ranked = F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("back"), (-s["score"]).alias("rank"), s["entity"].alias("entity")))),
        lambda s: F.struct(s["entity"].alias("entity"), s["start"].alias("start"), (-s["back"]).alias("end"),
                           (-s["rank"]).alias("score")))

    def outer(spans: Column) -> Column:
        """Spans that reach further than every one before them."""
        return bind(running_max(F.transform(spans, lambda s: s["end"])), lambda reach: F.filter(
            spans, lambda s, i: (i == 0) | (s["end"] > F.get(reach, i - 1))))

    def merge(spans: Column) -> Column:
        """Runs of overlapping spans of one entity, as one span each."""
        def starts_run(s: Column, i: Column) -> Column:
            before = F.get(spans, i - 1)
            return (i == 0) | (s["entity"] != before["entity"]) | (s["start"] >= before["end"])

        heads = F.filter(F.transform(spans, lambda s, i: F.when(starts_run(s, i), i)), lambda i: i.isNotNull())
        return bind(heads, lambda h: F.transform(h, lambda i, nth: bind(
            F.slice(spans, i + 1, F.coalesce(F.get(h, nth + 1), F.size(spans)) - i),
            lambda run: F.struct(
                run[0]["entity"].alias("entity"), run[0]["start"].alias("start"), F.element_at(run, -1)["end"].alias("end"),
                F.array_max(F.transform(run, lambda s: s["score"])).alias("score")))))

    def clip(spans: Column) -> Column:
        return F.transform(spans, lambda s, i: F.struct(
            s["entity"].alias("entity"), s["start"].alias("start"),
            F.least(s["end"], F.get(spans, i + 1)["start"]).alias("end"), s["score"].alias("score")))

    return F.when(F.size(spans) <= 1, spans).otherwise(bind(bind(bind(ranked, outer), merge), clip))


def replace_spans(text: Column, spans: Column) -> Column:
    """Write `<ENTITY>` over each of the disjoint, ordered `spans`."""
    before = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    kept = F.zip_with(before, spans, lambda end, s: F.concat(
        F.when(s.isNull(), F.substring(text, end + 1, F.length(text)))
        .otherwise(F.concat(F.substring(text, end + 1, s["start"] - end), F.lit("<"), s["entity"], F.lit(">")))))
    return F.when(F.size(spans) == 0, text).otherwise(F.array_join(kept, ""))


def redact_spans(df: DataFrame, text: str = "text", out: str = "redacted",
                 patterns: Sequence[Pattern] = PATTERNS) -> DataFrame:
    """Exact redaction: all spans, overlaps resolved, one tag per span left."""
    found = pii_spans(df, text, "_spans", patterns).withColumn("_spans", resolve_spans(F.col("_spans")))
    return found.withColumn(out, replace_spans(F.col(text), F.col("_spans"))).drop("_spans")


def redact_entities(text: Column, patterns: Sequence[Pattern] = PATTERNS) -> Column:
    """Fast redaction: replace pattern after pattern. May differ where entities overlap in part."""
    for p in patterns:
        text = F.regexp_replace(text, FLAGS + p.regex, f"<{p.entity}>")
    return text


# Joined sequences, digit runs, and grouped digits before four more digits.
JOINED_SEQUENCE = r"(?U)\b\w+([.*\-_]+\w+)+\b"
DIGIT_RUN = r"(?U)\b\d+\b"
GROUPED_DIGITS = r"(?U)\b(?:\d{4}[-\s]?){2,}(?=\d{4})"


def redact_sequences(text: Column) -> Column:
    """Mask joined sequences and digit runs; of grouped digits the last four characters stay."""
    text = F.regexp_replace(text, JOINED_SEQUENCE, "***")
    text = F.regexp_replace(text, DIGIT_RUN, "[REDACTED]")
    text = F.regexp_replace(text, JOINED_SEQUENCE, "[REDACTED]")
    masked = F.when(text.rlike(GROUPED_DIGITS), rewrite_matches(
        text, GROUPED_DIGITS,
        lambda m: F.concat(F.regexp_replace(F.substring(m, F.lit(1), F.length(m) - 4), r"(?U)\d", "X"), F.right(m, F.lit(4)))))
    return F.coalesce(masked, text)


def mask_terms(text: Column, terms: Column) -> Column:
    """Replace each listed term, as a whole word, by stars of its length."""
    def mask(masked: Column, term: Column) -> Column:
        literal = F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
        pattern = F.concat(F.lit("(?U)\\b\\Q"), literal, F.lit("\\E\\b"))
        return F.regexp_replace(masked, pattern, F.repeat(F.lit("*"), F.length(term)))

    return F.aggregate(terms, text, mask)


def pii_report(df: DataFrame, text: str = "text") -> DataFrame:
    """Spans left after overlap resolution, counted by entity."""
    spans = pii_spans(df.select(text), text).select(F.explode(resolve_spans(F.col("spans"))).alias("s"))
    return spans.groupBy(F.col("s.entity").alias("entity")).agg(F.count(F.lit(1)).alias("n_spans"))
