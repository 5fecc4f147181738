"""Word timing: durations, punctuation, segment boundaries, speakers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.arrays import bind
from parley.functions.text import strip
from parley.operators.lookup import is_small, same_keys
from parley.operators.ordered import is_hot, ordered, position_block
from parley.session import cut

# Marks that end a sentence, and marks that belong to the next or previous word.
SENTENCE_MARKS = ".。!！?？"
PREPENDED = "\"'“¿([{-"
APPENDED = "\"'.。,，!！?？:：”)]}、"

#: Words of one key that a task may hold in one row; some 200 bytes each.
MAX_FOLDED_ROWS = 500_000

#: Levels of dyadic time cells above the smallest, for turns and for words, and the farthest time that is told apart.
TURN_LEVELS, WORD_LEVELS = 40, 8
FARTHEST_S = 1e15

PAUSE_MEDIANS = 4
TOLERANCE = 0.5


def _in(marks: str, word: Column) -> Column:
    """The word is a part of `marks`; so is the empty word."""
    return F.contains(F.lit(marks), word)


def median_word_duration(words: DataFrame, keys: list[str]) -> DataFrame:
    """Exact median of the non-zero word durations; 0.0 if there is none.

    Equal durations are counted first, so the median sees each distinct duration once.
    """
    durations = words.groupBy(*keys, (F.col("end") - F.col("start")).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    median = F.percentile(F.when(F.col("_d") != 0, F.col("_d")), 0.5, F.col("_n"))
    return durations.groupBy(*keys).agg(F.coalesce(median, F.lit(0.0)).alias("median"))


def mean_token_probability(tokens: DataFrame, keys: list[str]) -> DataFrame:
    return tokens.groupBy(*keys).agg(F.avg("probability").alias("probability"))


def trim_long_words(words: DataFrame, keys: list[str], number: str = "word_no", hot: bool | None = None) -> DataFrame:
    """Shorten words at sentence marks to twice the median duration of their window."""
    line = ordered(words, keys, [number], position_block(number), hot).previous(_before=F.col("word"))
    if line.hot:
        rows = same_keys(line.rows(), median_word_duration(words, keys), keys)
    else:
        # The window's rows are in one place already; a second pass over the words would cost more.
        duration = F.col("end") - F.col("start")
        median = F.median(F.when(duration != 0, duration)).over(Window.partitionBy(*keys))
        rows = line.df.withColumn("median", F.coalesce(median, F.lit(0.0)))
    limit = F.col("median") * 2
    long = (F.col("end") - F.col("start") > limit) & F.col("_before").isNotNull() & (F.col("median") > 0)
    is_mark = _in(SENTENCE_MARKS, F.col("word"))
    return rows.withColumns({
        "end": F.when(long & is_mark, F.col("start") + limit).otherwise(F.col("end")),
        "start": F.when(long & ~is_mark & _in(SENTENCE_MARKS, F.col("_before")), F.col("end") - limit)
        .otherwise(F.col("start")),
    }).drop("_before", "median")


def merge_punctuation(words: DataFrame, keys: list[str], number: str = "word_no", prepended: str = PREPENDED,
                      appended: str = APPENDED, hot: bool | None = None) -> DataFrame:
    """Join opening marks to the next word and closing marks to the previous one.

    A word keeps its own time. A run is opening marks, a word and closing marks; one window tells where runs start, and
    the words of a key are folded in one row. If a key is too long for that, its runs are numbered and folded by an
    aggregate. Marks hold no blanks. Null words are left out first, empty ones that stand alone at last.
    """
    words = words.filter(F.col("word").isNotNull())
    hot = is_hot(words, keys, MAX_FOLDED_ROWS) if hot is None else hot

    def opens(word: Column) -> Column:
        # Few words have a mark or white space in second place; only those are stripped.
        letter = F.substring(word, 2, 1)
        return word.startswith(" ") & (_in(prepended, letter) | (letter < "!") | (letter > "~")) & _in(prepended, strip(word))

    word, before, second = F.col("word"), F.col("_before"), F.col("_second_before")
    line = ordered(words, keys, [number], position_block(number), hot)
    line = line.following(_after=word).previous(_before=word).second_previous(_second_before=word)
    line = line if hot else line.number("_n")
    # An empty word ends as the opening mark before it does.
    blank_before = before.endswith(" ") | ((before == "") & F.coalesce(opens(second) & second.endswith(" "), F.lit(False)))
    opening = opens(word) & F.col("_after").isNotNull()
    closing = ~F.col("_opening") & _in(appended, word) & before.isNotNull() & ~blank_before
    starts = ~F.coalesce(opens(before), F.lit(False)) & ~F.coalesce(closing, F.lit(False))
    line = line.with_columns(_opening=opening).with_columns(_starts=starts)
    rest = [c for c in words.columns if c not in (*keys, "word")]
    own = F.struct(*(F.col(f"`{c}`") for c in rest))
    if hot:
        # Stored first, so that the sort of an aggregate does not take the memory that the windows before it need.
        rows = cut(line.running_sum(_run=F.col("_starts").cast("int")).rows())
        place = F.struct(F.col(number))  # not null, so a row without a number counts
        runs = rows.groupBy(*keys, "_run").agg(
            F.min_by(own, F.when(~F.col("_opening"), place)).alias("_own"),
            F.sort_array(F.collect_list(F.struct(number, "word"))).alias("_words"))
        runs = runs.withColumn("word", F.array_join(F.col("_words.word"), ""))
    else:
        # Rows lie in this order already, and an aggregate of sorted rows holds one key at a time.
        place = F.struct("_n", "word", "_opening", "_starts", own.alias("_own"))
        lines = line.rows().groupBy(*keys).agg(F.collect_list(place).alias("_line"))
        runs = lines.select(*keys, F.explode(_runs(F.col("_line"))).alias("_r")).select(*keys, "_r.*")
    return runs.filter(F.col("word") != "").select(
        *(F.col(f"_own.`{c}`").alias(c) if c in rest else F.col(c) for c in words.columns))


def _runs(line: Column) -> Column:
    """The runs `(word, _own)` of the words of one key; `_own` is that of the first word that does not open."""
    def fold(a: Column) -> Column:
        def run(start: Column, n: Column) -> Column:
            first = F.get(a, start)
            return F.when(n == 1, F.struct(first["word"].alias("word"), first["_own"].alias("_own"))).otherwise(bind(
                F.slice(a, start + 1, n), lambda part: F.struct(
                    F.array_join(F.transform(part, lambda w: w["word"]), "").alias("word"),
                    F.get(F.filter(part, lambda w: ~w["_opening"]), F.lit(0))["_own"].alias("_own"))))

        starts = F.filter(F.transform(a, lambda w, i: F.when(w["_starts"], i)), lambda i: i.isNotNull())
        return bind(starts, lambda s: F.transform(s, lambda at, i: run(at, F.coalesce(F.get(s, i + 1), F.size(a)) - at)))

    return bind(F.array_sort(line, lambda x, y: (x["_n"] - y["_n"]).cast("int")), fold)


def segment_edges(words: DataFrame, keys: list[str]) -> DataFrame:
    """First, second and last word time of each segment; `word_no` counts from 0 in the segment."""
    time = F.struct("start", "end")
    return words.groupBy(*keys).agg(
        F.min_by(time, "word_no").alias("w0"),
        F.max(F.when(F.col("word_no") == 1, time)).alias("w1"),
        F.max_by(time, "word_no").alias("wl"),
        F.count(F.lit(1)).alias("n_words"))


def _fitted(paused: Column) -> dict[str, Column]:
    """Segment and edge word times if the segment does (or does not) follow a pause."""
    median = F.col("median")
    limit, one, two = median * 2, F.col("n_words") == 1, F.col("n_words") == 2
    second_long = ~one & (F.col("w1.end") - F.col("w1.start") > limit)
    edge = F.greatest(F.col("w1.end") / 2, F.col("w1.end") - limit)
    w0_end = F.when(paused & second_long, edge).otherwise(F.col("w0.end"))
    w1_start = F.when(paused & second_long, edge).otherwise(F.col("w1.start"))
    w0_start = F.when(paused, F.greatest(F.lit(0.0), w0_end - limit)).otherwise(F.col("w0.start"))
    late = (F.col("start") < w0_end) & (F.col("start") - TOLERANCE > w0_start)
    start = F.when(late, F.col("start")).otherwise(w0_start)
    w0_start = F.when(late, F.greatest(F.lit(0.0), F.least(w0_end - median, F.col("start")))).otherwise(w0_start)
    last_start = F.when(one, w0_start).when(two, w1_start).otherwise(F.col("wl.start"))
    last_end = F.when(one, w0_end).otherwise(F.col("wl.end"))
    early = (F.col("end") > last_start) & (F.col("end") + TOLERANCE < last_end)
    end = F.when(early, F.col("end")).otherwise(last_end)
    last_end = F.when(early, F.greatest(last_start + median, F.col("end"))).otherwise(last_end)
    return {"start": start, "end": end, "w0_start": w0_start, "w0_end": F.when(one, last_end).otherwise(w0_end),
            "w1_start": w1_start, "last_end": last_end}


def fix_segment_boundaries(segments: DataFrame, words: DataFrame, hot: bool | None = None) -> DataFrame:
    """Reconcile segment bounds with first and last word, and shorten words after a pause.

    `segments` are `(call_id, window_no, segment_no, start, end, median)`. Whether a segment
    follows a pause depends on the end of the one before, which depends on whether that one
    did: a chain of yes/no decisions. Both ends of each segment are computed, which makes a
    segment either settle its successor's answer, pass its own on, or pass on the opposite.
    The answer is then the last settled one, flipped once per opposite since. Segments without
    words keep their bounds and are passed over: a pause counts from the last word spoken.
    """
    keys = ["call_id", "segment_no"]
    hot = is_hot(segments, ["call_id"]) if hot is None else hot
    rows = same_keys(segments, segment_edges(words, keys), keys)
    too_long = (F.col("w0.end") - F.col("w0.start") > F.col("median") * 2) | F.coalesce(
        F.col("w1.end") - F.col("w0.start") > F.col("median") * 4, F.lit(False))
    rows = rows.withColumns({
        "_long": too_long,
        "_no": F.struct(*[c.alias(n) for n, c in _fitted(F.lit(False)).items()]),
        "_yes": F.struct(*[c.alias(n) for n, c in _fitted(F.lit(True)).items()])})
    line = ordered(rows, ["call_id"], ["segment_no"], position_block("segment_no"), hot)
    line = line.previous(_was=F.struct(
        "window_no", F.col("_no.end").alias("no_end"), F.col("_no.last_end").alias("no_word"),
        F.col("_yes.end").alias("yes_end"), F.col("_yes.last_end").alias("yes_word")))

    def after(answer: str) -> Column:
        """Would this segment follow a pause, had the one before given `answer`?"""
        spoken = F.when(F.col("_was.window_no") == F.col("window_no"), F.col(f"_was.{answer}_end")).otherwise(
            F.col(f"_was.{answer}_word"))
        gap = F.col("w0.end") - F.coalesce(spoken, F.lit(0.0))
        return F.col("_long") & (gap > F.col("median") * PAUSE_MEDIANS)

    line = line.with_columns(_if_no=after("no"), _if_yes=after("yes"))
    settled = F.when(F.col("_if_no") == F.col("_if_yes"), F.col("_if_no"))
    flips = F.when(F.col("_if_no") & ~F.col("_if_yes"), 1).otherwise(0)
    line = line.running_sum(_flips=flips)
    line = line.last_seen(_settled=F.when(settled.isNotNull(), F.struct(settled.alias("answer"), F.col("_flips").alias("flips"))))
    odd = (F.col("_flips") - F.col("_settled.flips")) % 2 == 1
    paused = F.col("_settled.answer") != odd
    chosen = F.when(paused, F.col("_yes")).otherwise(F.col("_no"))
    fixed = line.rows().select(*[c for c in segments.columns if c not in ("start", "end")],
                               "n_words", paused.alias("after_pause"), chosen.alias("_c")).select("*", "_c.*").drop("_c")
    wordless = same_keys(segments, words.select(*keys).distinct(), keys, "left_anti").withColumns(
        {"n_words": F.lit(0).cast(fixed.schema["n_words"].dataType), "after_pause": F.lit(False)})
    return fixed.unionByName(wordless, allowMissingColumns=True)


def apply_boundaries(words: DataFrame, fixed: DataFrame) -> DataFrame:
    """Carry the edge word times of `fix_segment_boundaries` into the words."""
    keys = ["call_id", "segment_no"]
    edges = fixed.select(*keys, "n_words", "w0_start", "w0_end", "w1_start", "last_end")
    first, second = F.col("word_no") == 0, F.col("word_no") == 1
    last = F.col("word_no") == F.col("n_words") - 1
    return same_keys(words, edges, keys).withColumns({
        "start": F.when(first, F.col("w0_start")).when(second, F.col("w1_start")).otherwise(F.col("start")),
        "end": F.when(last, F.col("last_end")).when(first, F.col("w0_end")).otherwise(F.col("end")),
    }).drop("n_words", "w0_start", "w0_end", "w1_start", "last_end")


_CELL = "struct<level:int,cell:bigint>"


def _cell(level: Column, cell: Column) -> Column:
    return F.struct(level.alias("level"), cell.alias("cell")).cast(_CELL)


def _above(cell: Column, level: Column) -> Column:
    """The cell of a level that holds a cell of level 0."""
    return F.call_function("shiftright", cell, level)


def _covering(first: Column, last: Column, top: int) -> Column:
    """The fewest dyadic cells that make up the cells `first` to `last`: `array<struct<level,cell>>`.

    A cell of level k is 2**k cells of level 0. At most two of each level are needed, at the top level all that remain.
    """
    def at(k: Column) -> Column:
        lo, hi = -_above(-first, k), _above(last + 1, k)  # whole cells of this level: from lo to before hi
        ends = F.filter(F.array(F.when(F.pmod(lo, F.lit(2)) == 1, lo), F.when(F.pmod(hi, F.lit(2)) == 1, hi - 1)), lambda c: c.isNotNull())
        here = F.when(lo >= hi, F.array().cast("array<bigint>")).when(k == top, F.sequence(lo, hi - 1)).otherwise(ends)
        return F.transform(here, lambda c: _cell(k, c))

    levels = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(top)), at))
    return F.when(first == last, F.array(_cell(F.lit(0), first))).otherwise(levels)


def _around(first: Column, levels: Sequence[int]) -> Column:
    """The cells of some levels that hold a cell of level 0."""
    return F.transform(F.array(*map(F.lit, levels)).cast("array<int>"), lambda k: _cell(k, _above(first, k)))


def _apart(cells: Column) -> Column:
    """The same cells under levels of their own, which never meet the others."""
    return F.transform(cells, lambda c: _cell(-1 - c["level"], c["cell"]))


def turn_cells(turns: DataFrame, bucket_s: float = 10.0) -> DataFrame:
    """Different turns with how often they occur, the cells they cover, and those around their start."""
    held = turns.groupBy("call_id", "speaker", F.col("start").alias("ts"), F.col("end").alias("te")).agg(F.count(F.lit(1)).alias("_times"))
    held = held.filter("te > ts").withColumns({"_t0": _time_cell("ts", bucket_s), "_t1": _time_cell("te", bucket_s)})
    return held.withColumns({"_cover": _covering(F.col("_t0"), F.col("_t1"), TURN_LEVELS),
                             "_start": _apart(_around(F.col("_t0"), range(WORD_LEVELS + 1)))})


def _time_cell(column: str, bucket_s: float) -> Column:
    return F.floor(F.greatest(F.least(F.col(column), F.lit(FARTHEST_S)), F.lit(-FARTHEST_S)) / bucket_s).cast("long")


def assign_speakers(words: DataFrame, turns: DataFrame, bucket_s: float = 10.0) -> DataFrame:
    """Give each word the speaker whose turns overlap it most; ties go to the first name.

    Words and turns meet in dyadic time cells: a turn is stored in the few cells that make it up, a logarithmic number
    for any length, and a word looks into the cells around its start; turns that start later than a word are met the
    other way round, in the cells that make up the word. Of the later of both starts just one cell of each kind
    holds the other, so a pair meets once. Equal turns are counted first and the turns materialised, as words look only
    into levels that occur. Turns proven to be few are broadcast. Words are read once and shuffled with what they found.

    Words without a length, without a time or without an overlap get no speaker; words and turns without a call belong
    together; repeated words are rows of their own.
    """
    held = cut(turn_cells(turns, bucket_s))
    levels = sorted(r[0] for r in held.select(F.explode("_cover.level")).distinct().collect())  # at most TURN_LEVELS + 1
    held = held.select("call_id", "speaker", "ts", "te", "_times", "_t0", F.explode(F.concat("_cover", "_start")).alias("_c")).select(
        "*", "_c.level", "_c.cell").drop("_c").withColumnsRenamed({"level": "_level", "cell": "_cell"})
    held = F.broadcast(held) if is_small(held) else held
    own = words.columns
    lasting = F.col("end") > F.col("start")
    rows = words.withColumn("_row", F.monotonically_increasing_id()).withColumns({
        "_w0": F.when(lasting, _time_cell("start", bucket_s)), "_w1": F.when(lasting, _time_cell("end", bucket_s))})
    cells = F.concat(_around(F.col("_w0"), levels), _apart(_covering(F.col("_w0"), F.col("_w1"), WORD_LEVELS)))
    rows = rows.select("_row", *own, "_w0", F.posexplode_outer(F.when(F.col("_w0").isNotNull(), cells)).alias("_nth", "_c"))
    rows = rows.withColumns({"_level": F.col("_c")["level"], "_cell": F.col("_c")["cell"], "_kept": F.coalesce("_nth", F.lit(0)) == 0}).drop("_c", "_nth")
    met = same_keys(rows, held.withColumnRenamed("speaker", "_speaker"), ["call_id", "_level", "_cell"], "left")
    # Equal first cells belong to the turn's cover.
    counts = (F.col("start") < F.col("te")) & (F.col("end") > F.col("ts")) & ((F.col("_level") >= 0) == (F.col("_t0") <= F.col("_w0")))
    overlap = F.when(counts, (F.least("end", "te") - F.greatest("start", "ts")) * F.col("_times"))
    met = met.select("_row", *own, "_speaker", "_kept", overlap.alias("_overlap")).where("_kept or _overlap is not null")
    spans = met.repartition("_row").groupBy("_row", *own, "_speaker").agg(F.sum("_overlap").alias("_overlap"))
    best = F.min_by("_speaker", F.when(F.col("_overlap").isNotNull(), F.struct(-F.col("_overlap"), F.col("_speaker"))))
    return spans.groupBy("_row", *own).agg(best.alias("speaker")).drop("_row")


def split_on_markers(df: DataFrame, marker_from: int, precision: float = 0.02) -> DataFrame:
    """Cut each window's tokens into segments where two time markers meet.

    `df` has `tokens array<int>`, `time_offset` and `segment_duration`; a marker is a token of
    at least `marker_from`. A lone marker at the end closes the last segment; without any
    meeting pair the window is one segment.
    """
    tokens, n = F.col("tokens"), F.size("tokens")

    def marker(i: Column) -> Column:
        return F.get(F.col("tokens"), i) >= marker_from

    def seconds(token: Column) -> Column:
        return F.col("time_offset") + (token - marker_from) * precision

    pairs = F.when(n > 1, F.filter(F.sequence(F.lit(1), n - 1), lambda i: marker(i) & marker(i - 1))).otherwise(
        F.array().cast("array<int>"))
    lone_end = (n >= 2) & ~marker(n - 2) & marker(n - 1)
    df = df.withColumn("_pairs", pairs)
    cuts = F.concat(F.array(F.lit(0)), F.col("_pairs"), F.when(lone_end, F.array(n)).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("_cuts", cuts)
    parts = F.transform(F.sequence(F.lit(0), F.size("_cuts") - 2), lambda i: F.slice(
        tokens, F.get(F.col("_cuts"), i) + 1, F.get(F.col("_cuts"), i + 1) - F.get(F.col("_cuts"), i)))
    met = F.transform(parts, lambda p: F.struct(
        seconds(F.element_at(p, 1)).alias("start"), seconds(F.element_at(p, -1)).alias("end"), p.alias("tokens")))
    last_marker = F.try_element_at(F.filter(tokens, lambda t: t >= marker_from), F.lit(-1))
    duration = F.when(last_marker > marker_from, (last_marker - marker_from) * precision).otherwise(F.col("segment_duration"))
    whole = F.array(F.struct(F.col("time_offset").alias("start"), (F.col("time_offset") + duration).alias("end"),
                             tokens.alias("tokens")))
    segments = F.when(F.size("_pairs") > 0, met).otherwise(whole)
    keys = [c for c in df.columns if c not in ("tokens", "time_offset", "segment_duration", "_pairs", "_cuts")]
    return df.select(*keys, F.posexplode(segments).alias("part", "_s")).select(*keys, "part", "_s.*")
