"""Segments, turns, chunks and frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.audio import frame_at, frame_starts, reflect_edges
from parley.functions.arrays import SCAN_BLOCK, bind
from parley.functions.text import pieces, sentences, strip
from parley.operators.ordered import ordered, position_block

# Rows first joined to one text or list per block, so that a long call is assembled by many tasks.
BLOCK_ROWS = 4096


def split_sentences(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence with its position."""
    return df.select(*[c for c in df.columns if c != text], F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))


def alternate_speakers(df: DataFrame, call: str = "call_id", number: str = "segment_no", hot: bool | None = None) -> DataFrame:
    """Speaker 1 and 2 in turn, by position in the call."""
    rows = ordered(df, [call], [number], position_block(number, BLOCK_ROWS), hot).number("_nth").rows()
    return rows.withColumn("speaker", (2 - F.col("_nth") % 2).cast("int")).drop("_nth")


def concat_texts(df: DataFrame, call: str, number: str, text: Column, separator: str = "") -> DataFrame:
    """Texts of a call in order, as one row; blocks of a long call are joined first."""
    parts = df.select(call, number, position_block(number, BLOCK_ROWS).alias("_block"), text.alias("_text"))
    within = F.expr(f"listagg(_text, '{separator}') WITHIN GROUP (ORDER BY {number})")
    blocks = parts.groupBy(call, "_block").agg(within.alias("_text"))
    across = F.expr(f"listagg(_text, '{separator}') WITHIN GROUP (ORDER BY _block)")
    return blocks.groupBy(call).agg(across.alias("transcription"))


def concat_segments(df: DataFrame, call: str = "call_id", number: str = "segment_no", text: str = "text") -> DataFrame:
    """The transcript: segment texts in order without a separator."""
    return concat_texts(df, call, number, F.col(text))


def render_turns(df: DataFrame, call: str = "call_id", number: str = "segment_no", text: str = "text",
                 hot: bool | None = None) -> DataFrame:
    """The transcript as `Speaker k: "text"` lines."""
    rows = alternate_speakers(df, call, number, hot)
    line = F.concat(F.lit("Speaker "), F.col("speaker").cast("string"), F.lit(': "'), strip(F.col(text)), F.lit('"\n'))
    return concat_texts(rows, call, number, line)


def nested_segments(df: DataFrame, fields: list[str], call: str = "call_id", number: str = "segment_no",
                    out: str = "segments") -> DataFrame:
    """One row per call with its segments as an ordered array of structs."""
    parts = df.select(call, position_block(number, BLOCK_ROWS).alias("_block"), F.struct(number, *fields).alias("_segment"))
    blocks = parts.groupBy(call, "_block").agg(F.array_sort(F.collect_list("_segment")).alias("_segments"))
    calls = blocks.groupBy(call).agg(F.array_sort(F.collect_list(F.struct("_block", "_segments"))).alias("_blocks"))
    return calls.select(call, F.flatten(F.transform("_blocks", lambda b: b["_segments"])).alias(out))


def token_chunks(text: Column, size: int = 1000) -> Column:
    """Chunks of `size` white-space tokens, joined by blanks."""
    def cut(tokens: Column) -> Column:
        starts = F.when(F.size(tokens) > 0, F.sequence(F.lit(1), F.size(tokens), F.lit(size)))
        return F.transform(starts, lambda s: F.array_join(F.slice(tokens, s, size), " "))

    return bind(pieces(text), cut)  # split once, not for every chunk


def fixed_token_chunks(df: DataFrame, size: int = 1000, text: str = "text") -> DataFrame:
    """One row per chunk. A text is one row already, so nothing is shuffled."""
    keys = [c for c in df.columns if c != text]
    return df.select(*keys, F.posexplode(token_chunks(F.col(text), size)).alias("chunk_no", "chunk"))


def packed_sentences(text: Column, limit: int = 1000) -> Column:
    """Greedy chunks: a sentence joins the chunk while the token count stays below `limit`.

    Only the numbers of the sentences that begin a chunk are gathered, in short blocks and a list of blocks, so the work
    stays linear in the text; the chunks are then cut out.
    """
    kind, outer = "struct<n:int,starts:array<int>>", "struct<n:int,starts:array<array<int>>>"

    def add(state: Column, x: Column) -> Column:
        fits = (x["i"] > 0) & (state["n"] + x["n"] < limit)
        return F.when(fits, F.struct((state["n"] + x["n"]).alias("n"), state["starts"].alias("starts"))).otherwise(
            F.struct(x["n"].alias("n"), F.concat(state["starts"], F.array(x["i"])).alias("starts"))).cast(kind)

    def starts(sized: Column) -> Column:
        def block(state: Column, at: Column) -> Column:
            begin = F.struct(state["n"].alias("n"), F.array().cast("array<int>").alias("starts")).cast(kind)
            return bind(F.aggregate(F.slice(sized, at, SCAN_BLOCK), begin, add), lambda done: F.struct(
                done["n"].alias("n"), F.concat(state["starts"], F.array(done["starts"])).alias("starts")).cast(outer))

        begin = F.struct(F.lit(0).alias("n"), F.array().cast("array<array<int>>").alias("starts")).cast(outer)
        return F.aggregate(F.sequence(F.lit(1), F.size(sized), F.lit(SCAN_BLOCK)), begin, block, lambda s: F.flatten(s["starts"]))

    def cut(parts: Column) -> Column:
        sized = F.transform(parts, lambda s, i: F.struct(i.alias("i"), F.size(pieces(s)).alias("n")))
        return bind(bind(sized, starts), lambda at: F.transform(at, lambda s, nth: F.array_join(
            F.slice(parts, s + 1, F.coalesce(F.get(at, nth + 1), F.size(parts)) - s), "\n")))

    return F.when(text.isNotNull(), bind(sentences(text), cut))


def pack_sentences(df: DataFrame, limit: int = 1000, text: str = "text") -> DataFrame:
    keys = [c for c in df.columns if c != text]
    return df.select(*keys, F.posexplode(packed_sentences(F.col(text), limit)).alias("chunk_no", "chunk"))


def frame_signal(df: DataFrame, size: int, hop: int | None = None, reflect: bool = False,
                 samples: str = "samples") -> DataFrame:
    """Windows of `size` samples every `hop`.

    Plain framing fills the last window with zeros; `reflect` mirrors half a window at both
    ends instead and keeps full windows only.
    """
    hop = hop or size
    keys = [c for c in df.columns if c != samples]
    if reflect:
        df = df.withColumn(samples, reflect_edges(F.col(samples), size // 2))
    frames = df.select(*keys, samples, F.posexplode(frame_starts(F.col(samples), hop)).alias("frame_no", "_start"))
    if reflect:
        frames = frames.filter(F.col("_start") + size <= F.size(samples))
    return frames.select(*keys, "frame_no", frame_at(F.col(samples), F.col("_start"), size).alias("frame"))
