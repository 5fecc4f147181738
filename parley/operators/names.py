"""Names of several words in texts, and their redaction together with other personal data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.arrays import SCAN_BLOCK, bind, running_sums
from parley.functions.pii import PATTERNS, SPAN, Pattern, pii_spans, replace_spans, resolve_spans
from parley.functions.text import WORD
from parley.operators.lookup import is_small, lookup
from parley.session import cut

#: How sure a listed name is; personal data found by expression in the same place ranks beside it.
NAME_SCORE = 0.85
_KEPT = f"array<{SPAN}>"


def name_words(name: Column) -> Column:
    return F.transform(F.regexp_extract_all(name, F.lit(WORD), F.lit(0)), F.lower)


#: Words of a text that are looked at together.
WORD_BLOCK = 8


def word_blocks(text: Column, most: int) -> Column:
    """The words of a text in blocks: `array<struct<words,gaps,before>>`.

    A block holds `WORD_BLOCK` words and the first `most` - 1 of the next one, the gap before each, and how many letters
    of the text come before it.
    """
    def cut_up(found: Column, gaps: Column) -> Column:
        starts = F.when(F.size(found) > 0, F.sequence(F.lit(1), F.size(found), F.lit(WORD_BLOCK)))
        ends = running_sums(F.transform(starts, lambda at: _letters(F.slice(found, at, WORD_BLOCK), F.slice(
            gaps, at, F.least(F.lit(WORD_BLOCK), F.size(found) - at + 1)))))
        return bind(ends, lambda e: F.transform(starts, lambda at, nth: F.struct(
            F.slice(found, at, WORD_BLOCK + most - 1).alias("words"), F.slice(gaps, at, WORD_BLOCK + most - 1).alias("gaps"),
            F.when(nth == 0, 0).otherwise(F.get(e, nth - 1)).alias("before"))))

    return bind(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda found: bind(F.split(text, WORD, -1), lambda gaps: cut_up(found, gaps)))


def _letters(*parts: Column) -> Column:
    """Length of all texts of some arrays."""
    return F.length(F.concat(*(F.array_join(p, "") for p in parts)))


def leftmost(spans: Column) -> Column:
    """Of spans sorted by start, at most one for each start, those that a reader picks who goes on after each pick.

    The picks are gathered in short blocks, and blocks in a list, so a long array is not copied at every pick.
    """
    kind = f"struct<upto:int,kept:{_KEPT}>"

    def pick(state: Column, span: Column) -> Column:
        return F.when(span["start"] >= state["upto"], F.struct(
            span["end"].alias("upto"), F.concat(state["kept"], F.array(span)).alias("kept")).cast(kind)).otherwise(state)

    def over(a: Column) -> Column:
        def block(state: Column, at: Column) -> Column:
            begin = F.struct(state["upto"].alias("upto"), F.array().cast(_KEPT).alias("kept")).cast(kind)
            return bind(F.aggregate(F.slice(a, at, SCAN_BLOCK), begin, pick), lambda done: F.struct(
                done["upto"].alias("upto"), F.concat(state["kept"], F.array(done["kept"])).alias("kept")).cast(f"struct<upto:int,kept:array<{_KEPT}>>"))

        start = F.struct(F.lit(0).alias("upto"), F.array().cast(f"array<{_KEPT}>").alias("kept")).cast(f"struct<upto:int,kept:array<{_KEPT}>>")
        return F.aggregate(F.sequence(F.lit(1), F.size(a), F.lit(SCAN_BLOCK)), start, block, lambda s: F.flatten(s["kept"]))

    return F.when(F.size(spans) > 1, bind(spans, over)).otherwise(spans)


def name_spans(texts: DataFrame, names: DataFrame, text: str = "text", name: str = "name", entity: str = "entity") -> DataFrame:
    """`digest` (SHA-256 of the text) and `spans` of the listed names in each text that holds one.

    Words of the texts first meet the first words of the names by hash; where one begins, the words that follow are joined
    for each length that names with this first word have, and meet the whole names by hash. A place has so at most one
    row for each length, however many names begin alike. Of the names that begin at a word the longest counts, of
    overlapping ones the leftmost (then the first entity by name). Words compare in lower case and may be parted by
    blanks only. A small list is broadcast and texts stay where they are; of a larger one the words are joined by shuffle,
    frequent words salted. Equal texts have one row.

    Null texts, null names and names without a word give nothing; a name listed twice counts once.
    """
    listed = names.select(name_words(F.col(name)).alias("_words"), F.col(entity).cast("string").alias("_entity")).where(F.size("_words") > 0)
    listed = cut(listed.groupBy("_words").agg(F.min("_entity").alias("_entity")))
    firsts = listed.groupBy(F.get("_words", F.lit(0)).alias("word")).agg(F.collect_set(F.size("_words")).alias("_lengths"))
    whole = listed.select(F.array_join("_words", " ").alias("_name"), "_entity")
    most = listed.agg(F.max(F.size("_words"))).first()[0] or 1
    rows = texts.select(F.sha2(text, 256).alias("digest"), F.col(text).alias("_text")).where("_text is not null")
    blocks = rows.select("digest", F.explode(word_blocks(F.col("_text"), most)).alias("_b")).select("digest", "_b.*")
    starts = blocks.select("*", F.posexplode(F.slice("words", 1, WORD_BLOCK)).alias("_at", "_word")).withColumn("word", F.lower("_word")).drop("_word")
    begun = lookup(starts, firsts, "word", F.struct("digest", "before", "_at"), how="inner")
    n, after = F.col("_n"), F.col("_at") + 1
    begun = begun.select("digest", "before", "words", "gaps", "_at", F.explode("_lengths").alias("_n")).where(F.size("words") >= F.col("_at") + n)
    run, between = F.slice("words", after, n), F.slice("gaps", after + 1, n - 1)
    start = F.col("before") + _letters(F.slice("words", F.lit(1), F.col("_at")), F.slice("gaps", F.lit(1), after))
    begun = begun.where((n == 1) | F.array_join(between, "").rlike(r"(?U)^\s*$")).select(
        "digest", F.lower(F.array_join(run, " ")).alias("_name"), start.alias("start"), (start + _letters(run, between)).alias("end"))
    found = lookup(begun, whole, "_name", F.struct("digest", "start"), how="inner").select("digest", F.struct("start", "end", F.col("_entity").alias("entity")).alias("s"))
    longest = found.groupBy("digest", F.col("s.start").alias("start")).agg(F.max(F.col("s.end")).alias("end"), F.max_by("s.entity", "s.end").alias("entity"))
    span = F.struct("start", "end", "entity")
    placed = longest.groupBy("digest").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return placed.select("digest", leftmost(F.transform("spans", lambda s: F.struct(
        s["entity"].alias("entity"), s["start"].alias("start"), s["end"].alias("end"), F.lit(NAME_SCORE).alias("score"))).cast(_KEPT)).alias("spans"))


def redact_names(df: DataFrame, names: DataFrame, text: str = "text", out: str = "redacted",
                 patterns: Sequence[Pattern] = PATTERNS) -> DataFrame:
    """Exact redaction of listed names along with all patterns; overlaps are resolved among all of them.

    The found spans, few beside the texts, go back to their texts by digest.
    """
    found = cut(name_spans(df, names, text).withColumnsRenamed({"digest": "_digest", "spans": "_names"}))  # searched once
    found = F.broadcast(found) if is_small(found) else found
    rows = df.join(found, F.sha2(df[text], 256) == F.col("_digest"), "left")
    rows = pii_spans(rows, text, "_spans", patterns)
    spans = F.concat("_spans", F.coalesce("_names", F.array().cast(_KEPT)))
    rows = rows.withColumn("_spans", resolve_spans(spans))
    return rows.withColumn(out, replace_spans(F.col(text), F.col("_spans"))).drop("_spans", "_names", "_digest")
