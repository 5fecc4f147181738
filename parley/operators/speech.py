"""Speech chunks from frame probabilities, and times on the silence-removed audio."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import round2, seconds_to_samples
from parley.operators.lookup import same_keys
from parley.operators.ordered import is_hot, ordered, position_block

CALL = "call_id"
# Stretch of audio whose chunks and times one task may hold.
BLOCK_SECONDS = 3600


@dataclass(frozen=True)
class SpeechOptions:
    """Fixed default values of the speech filter."""

    threshold: float = 0.5
    min_speech_ms: int = 250
    max_speech_s: float | None = None
    min_silence_ms: int = 2000
    window: int = 1024
    pad_ms: int = 400
    rate: int = 16_000

    @property
    def low(self) -> float:
        return self.threshold - 0.15

    def samples(self, ms: int) -> int:
        return self.rate * ms // 1000

    @property
    def max_speech_samples(self) -> float:
        return self.rate * self.max_speech_s - self.window - 2 * self.samples(self.pad_ms)


def audio_lengths(frames: DataFrame, options: SpeechOptions = SpeechOptions()) -> DataFrame:
    """Samples per call, from the highest frame number."""
    return frames.groupBy(CALL).agg(((F.max("frame_idx") + 1) * options.window).cast("long").alias("samples"))


def _marks(frames: DataFrame, options: SpeechOptions) -> DataFrame:
    """Frames that are clearly speech (`hi`) or clearly not; the band between says nothing."""
    hi, lo = F.col("prob") >= options.threshold, F.col("prob") < options.low
    return frames.filter(hi | lo).select(CALL, F.col("frame_idx").cast("long").alias("at"), hi.alias("hi"))


def _events(frames: DataFrame, options: SpeechOptions, pause: int, hot: bool):
    """Openings of speech and, per call, its last mark; `pause_from` is where the pause before began.

    Only changes between speech and silence matter, so frames inside a run are dropped after
    one look at their neighbours, and all later steps see far fewer rows.
    """
    marks = ordered(_marks(frames, options), [CALL], ["at"], position_block("at"), hot)
    marks = marks.previous(was=F.col("hi"), was_at=F.col("at")).following(next_at=F.col("at"))
    marks = marks.filter(F.col("was").isNull() | (F.col("was") != F.col("hi")) | F.col("next_at").isNull())
    fell = F.when(~F.col("hi") & F.col("was"), F.col("at"))
    turns = marks.previous(fell_before=fell)
    # A last row inside a silent run carries the end of that run, not its start.
    turns = turns.filter(F.col("hi") | F.col("next_at").isNull())
    pause_from = F.coalesce(fell, F.col("fell_before"))
    pause_to = F.when(F.col("hi"), F.col("was_at")).otherwise(F.col("at"))
    long_pause = (pause_to - pause_from) * options.window >= pause
    first = F.col("hi") & (F.col("was").isNull() | (~F.col("was") & F.col("fell_before").isNull()))
    opens = F.col("hi") & ~F.coalesce(F.col("was"), F.lit(False)) & (first | F.coalesce(long_pause, F.lit(False)))
    rows = turns.df.withColumns({
        "opens": opens,
        "pause_from": F.when(F.coalesce(long_pause, F.lit(False)), pause_from)})
    return ordered(rows.filter("opens or next_at is null").drop("_block"),
                   [CALL], ["at"], position_block("at"), hot)


def speech_chunks(frames: DataFrame, options: SpeechOptions = SpeechOptions(), lengths: DataFrame | None = None,
                  hot: bool | None = None) -> DataFrame:
    """Speech chunks `(call_id, chunk_no, start, end)` in samples, before padding.

    `frames` are `(call_id, frame_idx, prob)`. `lengths` are `(call_id, samples)` if the audio
    does not end with its last frame.
    """
    hot = is_hot(frames, [CALL]) if hot is None else hot
    if options.max_speech_s is not None:
        return _limited_chunks(frames, options, lengths, hot)
    lengths = audio_lengths(frames, options) if lengths is None else lengths
    events = _events(frames, options, options.samples(options.min_silence_ms), hot)
    events = events.following(next_pause=F.col("pause_from")).filter(F.col("opens"))
    chunks = same_keys(events.rows(), lengths, [CALL]).select(
        CALL, (F.col("at") * options.window).alias("start"),
        F.coalesce(F.col("next_pause") * options.window, "samples").alias("end"))
    chunks = chunks.filter(F.col("end") - F.col("start") > options.samples(options.min_speech_ms))
    return _numbered(chunks, options, hot)


def _sample_block(options: SpeechOptions, column: str = "start") -> Column:
    return F.floor(F.col(column) / (options.rate * BLOCK_SECONDS)).cast("long")


def _numbered(chunks: DataFrame, options: SpeechOptions, hot: bool) -> DataFrame:
    rows = ordered(chunks, [CALL], ["start"], _sample_block(options), hot).number("_nth").rows()
    return rows.select(CALL, (F.col("_nth") - 1).alias("chunk_no"), "start", "end")


def _first(values: np.ndarray, at: float, side: str = "left") -> int | None:
    """The first of sorted values from `at` on, or behind it with side "right"."""
    i = int(np.searchsorted(values, at, side))
    return int(values[i]) if i < len(values) else None


def _before(value: int | None, limit: int | None) -> bool:
    return value is not None and (limit is None or value < limit)


def _limited(at: np.ndarray, prob: np.ndarray, options: SpeechOptions) -> list[tuple[int, int | None]]:
    """Chunks of one stretch from its runs of speech and pauses; the last end is None if speech goes on.

    A chunk runs from a first speech frame up to a pause that lasts the minimum silence, or until it is too long.
    Then it ends where its last pause of over 98 ms began, and the next one begins with the speech after that pause;
    without such a pause it ends where it is found too long. Pauses before that point don't count for the next one.
    """
    split, silence = 98 * options.rate // 1000, options.samples(options.min_silence_ms)
    talk, still = at[prob >= options.threshold], at[prob < options.low]
    chunks: list[tuple[int, int | None]] = []
    begin = _first(talk, -np.inf)
    look = None  # pauses count from here on; by default, from behind the chunk's first frame
    while begin is not None:
        over = _first(at, begin + options.max_speech_samples, "right")
        pause = _first(still, begin, "right") if look is None else _first(still, look)
        cut = closed = None
        while closed is None and _before(pause, over):
            back = _first(talk, pause)  # speech that ends the pause
            stop = back if _before(back, over) else over
            lasting = _first(still, pause + silence)
            if _before(lasting, stop):
                closed = lasting
            else:
                cut = pause if _before(_first(still, pause + split, "right"), stop) else cut
                pause = None if back is None else _first(still, back)
        look = None
        if closed is not None:
            if pause - begin > options.samples(options.min_speech_ms):
                chunks.append((begin, pause))
            begin = _first(talk, closed, "right")
        elif over is None:
            chunks.append((begin, None))
            begin = None
        else:
            chunks.append((begin, over if cut is None else cut))
            back = None if cut is None else _first(talk, cut)
            if back is not None and back <= over:
                begin, look = back, over
            else:
                begin = _first(talk, over, "right")
    return chunks


def _walker(options: SpeechOptions) -> Callable[[tuple, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Chunks of one stretch, of whose frames time and probability are held: some 16 bytes each."""
    def walk(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [(batch["at"].to_numpy(np.int64) * options.window, batch["prob"].to_numpy(float)) for batch in batches]
        at, prob = (np.concatenate(x) for x in zip(*held))
        found = _limited(at, prob, options)
        if found:
            yield pd.DataFrame([(key[0], key[1], start, end) for start, end in found], columns=[CALL, "stretch", "start", "end"])

    return walk


def _limited_chunks(frames: DataFrame, options: SpeechOptions, lengths: DataFrame | None, hot: bool) -> DataFrame:
    """Chunks under a maximum length, from runs of speech and pauses.

    After a pause of the minimum silence plus the 98 ms at which a cut may restart the count,
    the decision holds no memory. Such pauses split a call into stretches, and each stretch is
    cut on its own.
    """
    lengths = audio_lengths(frames, options) if lengths is None else lengths
    split = 98 * options.rate // 1000
    reset = options.samples(options.min_silence_ms) + split + options.window
    starts = _events(frames, options, reset, hot).filter(F.col("opens")).df.select(CALL, "at", F.lit(1).alias("_first"))
    rows = frames.select(CALL, F.col("frame_idx").cast("long").alias("at"), F.col("prob").cast("double").alias("prob"))
    rows = same_keys(rows, starts, [CALL, "at"], "left")
    rows = ordered(rows, [CALL], ["at"], position_block("at"), hot).running_sum(
        stretch=F.coalesce(F.col("_first"), F.lit(0))).rows().filter("stretch > 0")
    sorted_rows = rows.select(CALL, "stretch", "at", "prob").repartition(CALL, "stretch").sortWithinPartitions(
        CALL, "stretch", "at")
    call_type = frames.schema[CALL].dataType.simpleString()
    walked = sorted_rows.groupBy(CALL, "stretch").applyInPandas(
        _walker(options), f"{CALL} {call_type}, stretch long, start long, end long")
    # A chunk left open runs to the end of the audio; only the last stretch can leave one.
    chunks = same_keys(walked, lengths, [CALL]).withColumn("_open", F.col("end").isNull())
    chunks = chunks.select(CALL, "start", F.coalesce("end", "samples").alias("end"), "_open")
    shortest = options.samples(options.min_speech_ms)
    chunks = chunks.filter(~F.col("_open") | (F.col("end") - F.col("start") > shortest))
    return _numbered(chunks.drop("_open"), options, hot)


def pad_chunks(chunks: DataFrame, lengths: DataFrame, options: SpeechOptions = SpeechOptions(),
               hot: bool | None = None) -> DataFrame:
    """Widen chunks; neighbours closer than two pads share the gap between them."""
    pad = options.samples(options.pad_ms)
    rows = ordered(chunks, [CALL], ["start"], _sample_block(options), hot)
    rows = same_keys(rows.previous(_before=F.col("end")).following(_after=F.col("start")).rows(), lengths, [CALL])
    gap_before, gap_after = F.col("start") - F.col("_before"), F.col("_after") - F.col("end")

    def share(gap: Column) -> Column:
        return F.when(gap < 2 * pad, F.floor(gap / 2)).otherwise(pad)

    start = F.greatest(F.col("start") - F.coalesce(share(gap_before), F.lit(pad)), F.lit(0))
    end = F.col("end") + F.coalesce(share(gap_after), F.lit(pad))
    end = F.when(gap_after < 2 * pad, end).otherwise(F.least(end, "samples"))
    return rows.select(CALL, "chunk_no", start.cast("long").alias("start"), end.cast("long").alias("end"))


def cumulative_silence(chunks: DataFrame, options: SpeechOptions = SpeechOptions(), hot: bool | None = None) -> DataFrame:
    """Silence removed before each chunk, and where the chunk lies on the shortened audio."""
    rows = ordered(chunks, [CALL], ["start"], _sample_block(options), hot)
    rows = rows.previous(_before=F.col("end"))
    rows = rows.running_sum(silence=F.col("start") - F.coalesce("_before", F.lit(0))).rows()
    return rows.drop("_before").withColumns({
        "compressed_start": F.col("start") - F.col("silence"),
        "compressed_end": F.col("end") - F.col("silence"),
        "before": F.col("silence") / F.lit(float(options.rate))})


def speech_stats(chunks: DataFrame, lengths: DataFrame, options: SpeechOptions = SpeechOptions()) -> DataFrame:
    """Seconds of audio, of speech kept, and of silence removed, per call."""
    kept = chunks.groupBy(CALL).agg(F.sum(F.col("end") - F.col("start")).alias("_kept"))
    rate, kept_samples = F.lit(float(options.rate)), F.coalesce("_kept", F.lit(0))
    return same_keys(lengths, kept, [CALL], "left").select(
        CALL, (F.col("samples") / rate).alias("duration"), (kept_samples / rate).alias("duration_after"),
        ((F.col("samples") - kept_samples) / rate).alias("removed"))


def _silence_before(points: DataFrame, chunks: DataFrame, options: SpeechOptions, hot: bool | None) -> DataFrame:
    """Add `before`, the seconds removed ahead of the chunk that holds sample `sample`.

    Points and chunk starts are laid on one time line and each point takes the last start it
    passed: linear in both, where a range join would pair all chunks of a call with all points.
    """
    hot = is_hot(points, [CALL]) if hot is None else hot
    marks = cumulative_silence(chunks, options, hot).select(
        CALL, F.col("compressed_start").alias("sample"), F.lit(0).alias("_kind"), "before")
    points = points.withColumns({"sample": F.greatest("sample", F.lit(0)), "_kind": F.lit(1),
                                 "before": F.lit(None).cast("double")})
    line = points.unionByName(marks, allowMissingColumns=True)
    line = ordered(line, [CALL], ["sample", "_kind"], _sample_block(options, "sample"), hot)
    return line.last_seen(before=F.col("before")).filter(F.col("_kind") == 1).rows().drop("_kind")


def restore_times(segments: DataFrame, chunks: DataFrame, options: SpeechOptions = SpeechOptions(),
                  hot: bool | None = None) -> DataFrame:
    """Put segment times `(call_id, segment_no, start, end)` back on the original audio.

    Start and end are looked up on their own.
    """
    points = segments.select(
        CALL, "segment_no", F.explode(F.map_from_arrays(
            F.array(F.lit("start"), F.lit("end")), F.array(F.col("start"), F.col("end")))).alias("_which", "_time"))
    points = points.withColumn("sample", seconds_to_samples(F.col("_time"), options.rate))
    found = _silence_before(points, chunks, options, hot)
    time = round2(F.col("before") + F.col("_time"))
    return found.groupBy(CALL, "segment_no").agg(
        F.max(F.when(F.col("_which") == "start", time)).alias("start"),
        F.max(F.when(F.col("_which") == "end", time)).alias("end"))


def restore_word_times(words: DataFrame, chunks: DataFrame, options: SpeechOptions = SpeechOptions(),
                       hot: bool | None = None) -> DataFrame:
    """Put word times back; both ends of a word use the chunk of its middle."""
    points = words.withColumn("sample", seconds_to_samples((F.col("start") + F.col("end")) / 2, options.rate))
    found = _silence_before(points, chunks, options, hot)
    return found.withColumns({c: round2(F.col("before") + F.col(c)) for c in ("start", "end")}).drop("before", "sample")


def segments_from_words(words: DataFrame) -> DataFrame:
    """A segment runs from its first word's start to its last word's end."""
    return words.groupBy(CALL, "segment_no").agg(
        F.min_by("start", "word_no").alias("start"), F.max_by("end", "word_no").alias("end"))
