"""Queries on speech chunks, word times and transcription candidates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.fixtures import CHUNKS_SQL, OPTIONS, PADDED_SQL, SILENCE_SQL, WORDS_SQL, frames, has_hot_call, words
from catalog.registry import query, table, texts
from parley.operators import hypotheses, speech
from parley.operators import words as timing
from parley.operators.lookup import same_keys
from parley.session import spread_by


def _padded(spark, sf_dir, hot):
    rows = frames(spark, sf_dir, hot)
    return speech.pad_chunks(speech.speech_chunks(rows, OPTIONS, hot=hot), speech.audio_lengths(rows), OPTIONS, hot)


@query("speech_chunks", f'WITH {CHUNKS_SQL} SELECT call_id, chunk_no, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end" FROM chunks')
def _(spark, sf_dir):
    hot = has_hot_call(spark, sf_dir)
    return speech.speech_chunks(frames(spark, sf_dir, hot), OPTIONS, hot=hot)


@query("speech_chunks_limited")
def _(spark, sf_dir):
    limited = speech.SpeechOptions(min_silence_ms=500, max_speech_s=3.0)
    hot = has_hot_call(spark, sf_dir)
    return speech.speech_chunks(frames(spark, sf_dir, hot), limited, hot=hot)


@query("pad_chunks", f"WITH {PADDED_SQL} SELECT * FROM padded")
def _(spark, sf_dir):
    return _padded(spark, sf_dir, has_hot_call(spark, sf_dir))


@query("cumulative_silence", f"""
WITH {SILENCE_SQL} SELECT call_id, chunk_no, silence, start - silence AS compressed_start, "end" - silence AS compressed_end,
  silence / 16000.0::DOUBLE AS before FROM silence""")
def _(spark, sf_dir):
    hot = has_hot_call(spark, sf_dir)
    return speech.cumulative_silence(_padded(spark, sf_dir, hot), OPTIONS, hot).drop("start", "end")


@query("speech_stats", f"""
WITH {PADDED_SQL}, k AS (SELECT call_id, sum("end" - start) AS kept FROM padded GROUP BY 1)
SELECT call_id, samples / 16000.0::DOUBLE AS duration, coalesce(kept, 0) / 16000.0::DOUBLE AS duration_after,
  (samples - coalesce(kept, 0)) / 16000.0::DOUBLE AS removed FROM lengths LEFT JOIN k USING (call_id)""")
def _(spark, sf_dir):
    hot = has_hot_call(spark, sf_dir)
    return speech.speech_stats(_padded(spark, sf_dir, hot), speech.audio_lengths(frames(spark, sf_dir, hot)), OPTIONS)


# A chunk holds the samples up to its end on the shortened audio; the last one holds all that follow.
HOLDERS_SQL = SILENCE_SQL + """,
holders AS (SELECT call_id, silence, coalesce(lag("end" - silence) OVER w, 0) AS low,
  CASE WHEN lead(start) OVER w IS NULL THEN 9e18 ELSE "end" - silence END AS high
  FROM silence WINDOW w AS (PARTITION BY call_id ORDER BY start))"""


@query("restore_times", f"""
WITH {HOLDERS_SQL},
seg AS (SELECT call_id, i AS segment_no, i / 16.0::DOUBLE AS s, (i + 1) / 16.0::DOUBLE AS e FROM f)
SELECT seg.call_id, segment_no, CAST(printf('%.2f', a.silence / 16000.0::DOUBLE + s) AS DOUBLE) AS start,
  CAST(printf('%.2f', z.silence / 16000.0::DOUBLE + e) AS DOUBLE) AS "end"
FROM seg LEFT JOIN holders a ON a.call_id = seg.call_id AND trunc(s * 16000) >= a.low AND trunc(s * 16000) < a.high
LEFT JOIN holders z ON z.call_id = seg.call_id AND trunc(e * 16000) >= z.low AND trunc(e * 16000) < z.high""")
def _(spark, sf_dir):
    hot = has_hot_call(spark, sf_dir)
    segments = frames(spark, sf_dir, hot).select(
        "call_id", F.col("frame_idx").alias("segment_no"), (F.col("frame_idx") / 16.0).alias("start"),
        ((F.col("frame_idx") + 1) / 16.0).alias("end"))
    return speech.restore_times(segments, _padded(spark, sf_dir, hot), OPTIONS, hot)


@query("restore_word_times", f"""
WITH {HOLDERS_SQL},
wd AS (SELECT call_id, i // 8 AS segment_no, i AS word_no, i / 16.0::DOUBLE AS s, (i + 1) / 16.0::DOUBLE AS e FROM f),
r AS (SELECT wd.call_id, segment_no, word_no, CAST(printf('%.2f', silence / 16000.0::DOUBLE + s) AS DOUBLE) AS s,
  CAST(printf('%.2f', silence / 16000.0::DOUBLE + e) AS DOUBLE) AS e
  FROM wd LEFT JOIN holders h ON h.call_id = wd.call_id AND trunc((s + e) / 2 * 16000) >= low AND trunc((s + e) / 2 * 16000) < high)
SELECT call_id, segment_no, min_by(s, word_no) AS start, max_by(e, word_no) AS "end" FROM r GROUP BY 1, 2""")
def _(spark, sf_dir):
    hot = has_hot_call(spark, sf_dir)
    spoken = frames(spark, sf_dir, hot).select(
        "call_id", F.floor(F.col("frame_idx") / 8).alias("segment_no"), F.col("frame_idx").alias("word_no"),
        (F.col("frame_idx") / 16.0).alias("start"), ((F.col("frame_idx") + 1) / 16.0).alias("end"))
    return speech.segments_from_words(speech.restore_word_times(spoken, _padded(spark, sf_dir, hot), OPTIONS, hot))


@query("median_word_duration", f"""
WITH {WORDS_SQL} SELECT call_id, segment_no, round(coalesce(median("end" - start) FILTER ("end" <> start), 0.0), 6) AS median
FROM words GROUP BY 1, 2""")
def _(spark, sf_dir):
    medians = timing.median_word_duration(words(spark, sf_dir), ["call_id", "segment_no"])
    return medians.withColumn("median", F.round("median", 6))


@query("mean_token_probability", """
SELECT user_id, event_type, round(avg(value / 500), 9) AS probability FROM events GROUP BY 1, 2""")
def _(spark, sf_dir):
    tokens = table(spark, sf_dir, "events").select("user_id", "event_type", (F.col("value") / 500).alias("probability"))
    rows = timing.mean_token_probability(tokens, ["user_id", "event_type"])
    return rows.withColumn("probability", F.round("probability", 9))


# Words and marks of a text as pieces of their own; a piece keeps the blank before it.
PIECE = r"\s?(?:[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])"
PIECES_SQL = rf"""
p0 AS (SELECT doc_id, regexp_extract_all(text, '{PIECE}', 0) AS ps FROM documents),
p1 AS (SELECT doc_id, unnest(ps) AS word, unnest(range(len(ps))) AS word_no FROM p0),
p2 AS (SELECT *, CASE WHEN word_no % 11 = 0 THEN 900 ELSE length(word) * 40 END AS ms FROM p1),
p3 AS (SELECT *, sum(ms) OVER (PARTITION BY doc_id ORDER BY word_no) AS e FROM p2),
pieces AS (SELECT doc_id, word_no, word, (e - ms) / 1000.0::DOUBLE AS start, e / 1000.0::DOUBLE AS "end" FROM p3)"""


# Bytes of the texts of one id whose pieces, some five bytes each, a task may hold in one row.
MAX_TEXT_BYTES = 2_000_000


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _pieces(documents, size):
    """Pieces of texts of `size` bytes, which are dealt out by their id first: they are far less than their pieces."""
    from parley.functions.arrays import running_sums

    found = F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))
    rows = spread_by(documents, ["doc_id"], size).select("doc_id", found.alias("_p"))
    rows = rows.withColumn("_ms", F.transform("_p", lambda w, i: F.when(i % 11 == 0, 900).otherwise(F.length(w) * 40)))
    rows = rows.withColumn("_ends", running_sums(F.col("_ms")))
    rows = rows.select("doc_id", F.posexplode(F.arrays_zip("_p", "_ms", "_ends")).alias("word_no", "_w"))
    return rows.select("doc_id", "word_no", F.col("_w._p").alias("word"),
                       ((F.col("_w._ends") - F.col("_w._ms")) / 1000.0).alias("start"),
                       (F.col("_w._ends") / 1000.0).alias("end"))


@query("trim_long_words", f"""
WITH {PIECES_SQL},
m AS (SELECT doc_id, median("end" - start) FILTER ("end" <> start) AS median FROM pieces GROUP BY 1),
l AS (SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY word_no) AS prev FROM pieces JOIN m USING (doc_id))
SELECT doc_id, word_no,
  round(CASE WHEN "end" - start > 2 * median AND prev IS NOT NULL AND NOT contains('.。!！?？', word)
    AND contains('.。!！?？', prev) THEN "end" - 2 * median ELSE start END, 6) AS start,
  round(CASE WHEN "end" - start > 2 * median AND prev IS NOT NULL AND contains('.。!！?？', word)
    THEN start + 2 * median ELSE "end" END, 6) AS "end" FROM l""")
def _(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A text was one row: no key can be too large for a task.
    rows = timing.trim_long_words(_pieces(documents, size), ["doc_id"], hot=False)
    return rows.select("doc_id", "word_no", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


OPENING_SQL = "'\"''“¿([{-'"
CLOSING_SQL = "'\"''.。,，!！?？:：”)]}、'"


@query("merge_punctuation", f"""
WITH {PIECES_SQL},
o AS (SELECT *, starts_with(word, ' ') AND contains({OPENING_SQL}, trim(word))
  AND lead(word) OVER (PARTITION BY doc_id ORDER BY word_no) IS NOT NULL AS opening FROM pieces),
r AS (SELECT *, coalesce(sum(CASE WHEN opening THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY word_no
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM o),
a AS (SELECT doc_id, run, string_agg(word, '' ORDER BY word_no) AS word, max(word_no) AS word_no,
  max_by(start, word_no) AS start, max_by("end", word_no) AS "end" FROM r GROUP BY 1, 2),
b AS (SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY word_no) AS prev FROM a),
c AS (SELECT *, sum(CASE WHEN prev IS NOT NULL AND contains({CLOSING_SQL}, word) AND NOT ends_with(prev, ' ') THEN 0 ELSE 1 END)
  OVER (PARTITION BY doc_id ORDER BY word_no) AS run2 FROM b)
SELECT doc_id, min(word_no) AS word_no, string_agg(word, '' ORDER BY word_no) AS word, min_by(start, word_no) AS start,
  min_by("end", word_no) AS "end" FROM c GROUP BY doc_id, run2""")
def _(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    sizes = documents.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("_bytes"))
    size, most = (n or 0 for n in sizes.agg(F.sum("_bytes"), F.max("_bytes")).first())
    if most <= MAX_TEXT_BYTES:
        return timing.merge_punctuation(_pieces(documents, size), ["doc_id"], hot=False)
    long = sizes.filter(F.col("_bytes") > MAX_TEXT_BYTES).select("doc_id")
    parts = (timing.merge_punctuation(_pieces(same_keys(documents, long, ["doc_id"], how), size), ["doc_id"], hot=hot)
             for how, hot in (("left_anti", False), ("left_semi", True)))
    return reduce(DataFrame.unionByName, parts)


def numbered(part: str, inside):
    """One number for a place in a part; places are below 2 ** 32, so no two share one."""
    return F.shiftleft(F.col(part).cast("long"), 32) + inside


@query("assign_speakers", f"""
WITH {WORDS_SQL},
turns AS (SELECT conv_id AS call_id, role AS speaker, turn * 120.0::DOUBLE + 0.5 AS start, turn * 120.0::DOUBLE + 60.25 AS "end" FROM conversations
  UNION ALL SELECT conv_id, 'other', turn * 120.0::DOUBLE + 20.0, turn * 120.0::DOUBLE + 90.0 FROM conversations),
n AS (SELECT *, segment_no * 4294967296 + word_no AS n FROM words),
o AS (SELECT w.call_id, n, speaker, sum(least(w."end", t."end") - greatest(w.start, t.start)) AS overlap
  FROM n w JOIN turns t ON w.call_id = t.call_id AND w.start < t."end" AND w."end" > t.start AND w."end" > w.start GROUP BY 1, 2, 3),
best AS (SELECT call_id, n, speaker FROM o QUALIFY row_number() OVER (PARTITION BY call_id, n ORDER BY overlap DESC, speaker) = 1)
SELECT call_id, n AS word_no, word, speaker FROM n LEFT JOIN best USING (call_id, n)""")
def _(spark, sf_dir):
    spoken = words(spark, sf_dir).withColumn("word_no", numbered("segment_no", F.col("word_no"))).drop("segment_no")
    base = table(spark, sf_dir, "conversations")
    begin = F.col("turn") * 120.0
    turns = base.select(F.col("conv_id").alias("call_id"), F.col("role").alias("speaker"), (begin + 0.5).alias("start"),
                        (begin + 60.25).alias("end"))
    other = base.select(F.col("conv_id").alias("call_id"), F.lit("other").alias("speaker"), (begin + 20.0).alias("start"),
                        (begin + 90.0).alias("end"))
    return timing.assign_speakers(spoken, turns.unionByName(other)).drop("start", "end")


# Segments of up to three words, so that a chain of pauses runs through many short segments.
SHORT_SQL = WORDS_SQL + """,
sw AS (SELECT call_id, segment_no * 4294967296 + word_no // 3 AS segment_no, word_no % 3 AS word_no,
  start + (word_no // 3) * ((word_no // 3) % 5) * 0.25::DOUBLE AS start, "end" + (word_no // 3) * ((word_no // 3) % 5) * 0.25::DOUBLE AS "end"
  FROM words),
ss AS (SELECT call_id, segment_no, segment_no // 8 AS window_no, min(start) + (segment_no % 4) * 0.5::DOUBLE - 0.5::DOUBLE AS start,
  max("end") - (segment_no % 3) * 0.5::DOUBLE AS "end", 0.125::DOUBLE + (segment_no % 2) * 0.125::DOUBLE AS median,
  count(*) AS n, min(CASE WHEN word_no = 0 THEN start END) AS a0, min(CASE WHEN word_no = 0 THEN "end" END) AS b0,
  min(CASE WHEN word_no = 1 THEN start END) AS a1, min(CASE WHEN word_no = 1 THEN "end" END) AS b1,
  max_by(start, word_no) AS al, max_by("end", word_no) AS bl, row_number() OVER (PARTITION BY call_id ORDER BY segment_no) AS k
  FROM sw GROUP BY 1, 2)"""

# One segment after the other, with the end of speech carried along.
BOUNDARY_SQL = SHORT_SQL + """,
walk AS (
  SELECT call_id, 0::BIGINT AS k, 0::BIGINT AS segment_no, -1::BIGINT AS window_no, 0.0::DOUBLE AS start, 0.0::DOUBLE AS "end",
    0.0::DOUBLE AS word_end, 0.0::DOUBLE AS w0_start, 0.0::DOUBLE AS w0_end, 0.0::DOUBLE AS w1_start, 0::BIGINT AS n_words, false AS after_pause FROM (SELECT DISTINCT call_id FROM ss)
  UNION ALL
  SELECT call_id, k, segment_no, window_no, start3, CASE WHEN early THEN end_in ELSE last_end END,
    CASE WHEN early THEN greatest(last_start + median, end_in) ELSE last_end END, w0s, b, c, n, paused
  FROM (SELECT *, (end_in > last_start AND end_in + 0.5 < last_end) AS early FROM (
    SELECT *, CASE WHEN late THEN start_in ELSE a END AS start3,
      CASE WHEN n = 1 THEN CASE WHEN late THEN greatest(0.0, least(b - median, start_in)) ELSE a END
           WHEN n = 2 THEN c ELSE al END AS last_start,
      CASE WHEN late THEN greatest(0.0, least(b - median, start_in)) ELSE a END AS w0s,
      CASE WHEN n = 1 THEN b ELSE bl END AS last_end
    FROM (SELECT *, (start_in < b AND start_in - 0.5 > a) AS late FROM (
      SELECT *, CASE WHEN paused THEN greatest(0.0, b - 2 * median) ELSE a0 END AS a FROM (
        SELECT *, CASE WHEN paused AND second_long THEN edge ELSE b0 END AS b, CASE WHEN paused AND second_long THEN edge ELSE a1 END AS c
        FROM (SELECT s.call_id, s.k, s.segment_no, s.window_no, s.start AS start_in, s."end" AS end_in, s.median, s.n,
            s.a0, s.b0, s.a1, s.b1, s.al, s.bl,
            coalesce(s.n > 1 AND s.b1 - s.a1 > 2 * s.median, false) AS second_long, greatest(s.b1 / 2, s.b1 - 2 * s.median) AS edge,
            s.b0 - CASE WHEN w.window_no = s.window_no THEN w."end" ELSE w.word_end END > 4 * s.median
              AND (s.b0 - s.a0 > 2 * s.median OR coalesce(s.n > 1 AND s.b1 - s.a0 > 4 * s.median, false)) AS paused
          FROM walk w JOIN ss s ON s.call_id = w.call_id AND s.k = w.k + 1))))))
)"""


@query("fix_segment_boundaries", f"""
WITH RECURSIVE {BOUNDARY_SQL}
SELECT call_id, segment_no, after_pause, round(start, 6) AS start, round("end", 6) AS "end", round(w0_start, 6) AS w0_start,
  round(CASE WHEN n_words = 1 THEN word_end ELSE w0_end END, 6) AS w0_end, round(w1_start, 6) AS w1_start, round(word_end, 6) AS last_end, n_words
FROM walk WHERE k > 0""")
def _(spark, sf_dir):
    spoken, spans = short_segments(spark, sf_dir)
    fixed = timing.fix_segment_boundaries(spans, spoken)
    return fixed.select("call_id", "segment_no", "after_pause", "n_words",
                        *[F.round(c, 6).alias(c) for c in ("start", "end", "w0_start", "w0_end", "w1_start", "last_end")])


def short_segments(spark, sf_dir):
    third = F.floor(F.col("word_no") / 3)
    shift = third * (third % 5) * 0.25
    spoken = words(spark, sf_dir).select(
        "call_id", numbered("segment_no", third).alias("segment_no"), (F.col("word_no") % 3).alias("word_no"),
        (F.col("start") + shift).alias("start"), (F.col("end") + shift).alias("end"))
    n = F.col("segment_no")
    spans = spoken.groupBy("call_id", "segment_no").agg(F.min("start").alias("start"), F.max("end").alias("end")).select(
        "call_id", "segment_no", F.shiftright(n, 3).alias("window_no"), (F.col("start") + (n % 4) * 0.5 - 0.5).alias("start"),
        (F.col("end") - (n % 3) * 0.5).alias("end"), (0.125 + (n % 2) * 0.125).alias("median"))
    return spoken, spans


@query("apply_boundaries", f"""
WITH RECURSIVE {BOUNDARY_SQL}
SELECT sw.call_id, sw.segment_no, word_no,
  round(CASE word_no WHEN 0 THEN w0_start WHEN 1 THEN w1_start ELSE sw.start END, 6) AS start,
  round(CASE word_no WHEN n_words - 1 THEN word_end WHEN 0 THEN w0_end ELSE sw."end" END, 6) AS "end"
FROM sw JOIN walk ON walk.call_id = sw.call_id AND walk.segment_no = sw.segment_no AND k > 0""")
def _(spark, sf_dir):
    spoken, spans = short_segments(spark, sf_dir)
    moved = timing.apply_boundaries(spoken, timing.fix_segment_boundaries(spans, spoken))
    return moved.select("call_id", "segment_no", "word_no", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


# A word that ends in a full stop or comma stands for a time marker, any other for a text token.
TOKENS_SQL = r"""
t0 AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS ws FROM documents),
t AS (SELECT doc_id, list_transform(ws, lambda x, i: CASE WHEN regexp_matches(x, '[.,]$') THEN 50364 + i % 1500 ELSE length(x) END) AS tokens
  FROM t0)"""


@query("split_on_markers", f"""
WITH {TOKENS_SQL},
c AS (SELECT *, list_filter(range(2, len(tokens) + 1), lambda i: tokens[i] >= 50364 AND tokens[i - 1] >= 50364) AS pairs,
  coalesce(len(tokens) >= 2 AND tokens[-2] < 50364 AND tokens[-1] >= 50364, false) AS lone FROM t),
k AS (SELECT *, CASE WHEN len(pairs) = 0 THEN [1, len(tokens) + 1]
  ELSE list_concat([1], list_concat(pairs, CASE WHEN lone THEN [len(tokens) + 1] ELSE [] END)) END AS cuts FROM c),
p AS (SELECT *, unnest(range(len(cuts) - 1)) AS part FROM k),
q AS (SELECT doc_id, part, len(pairs) > 0 AS met, tokens[cuts[part + 1]:cuts[part + 2] - 1] AS piece FROM p),
e AS (SELECT *, list_filter(piece, lambda x: x >= 50364)[-1] AS last_marker FROM q)
SELECT doc_id, part, round(10.0 + CASE WHEN met THEN (piece[1] - 50364) * 0.02 ELSE 0 END, 6)::DOUBLE AS start,
  round(10.0 + CASE WHEN met THEN (piece[-1] - 50364) * 0.02 WHEN last_marker > 50364 THEN (last_marker - 50364) * 0.02 ELSE 30.0 END, 6)::DOUBLE AS "end",
  len(piece) AS n_tokens, array_to_string(piece, ' ') AS tokens FROM e""")
def _(spark, sf_dir):
    from parley.functions.text import pieces

    tokens = F.transform(pieces(F.col("text")), lambda w, i: F.when(w.rlike("[.,]$"), 50364 + (i + 1) % 1500).otherwise(F.length(w)))
    rows = texts(spark, sf_dir).select(
        "doc_id", tokens.alias("tokens"), F.lit(10.0).alias("time_offset"), F.lit(30.0).alias("segment_duration"))
    parts = timing.split_on_markers(rows, 50364)
    return parts.select("doc_id", "part", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"),
                        F.size("tokens").cast("long").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


CANDIDATES_SQL = """
c AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, CAST(event_id // 1000 AS BIGINT) ORDER BY event_id) AS nth,
  CAST(event_id // 1000 AS BIGINT) AS seg, CAST(round(value * 100) AS BIGINT) AS v FROM events),
h AS (SELECT user_id, seg, event_id, nth / 5.0::DOUBLE AS temperature, -(v % 200) / 100.0::DOUBLE AS avg_logprob,
  (v % 37) / 10.0::DOUBLE AS compression_ratio, (v % 10) / 10.0::DOUBLE AS no_speech_prob FROM c)"""


@query("select_hypothesis", f"""
WITH {CANDIDATES_SQL},
j AS (SELECT *, compression_ratio > 2.4 AS rep, avg_logprob < -1.0 AS low FROM h),
a AS (SELECT *, (NOT rep AND NOT low) OR (no_speech_prob > 0.6 AND low) AS accepted FROM j),
g AS (SELECT *, bool_or(accepted) OVER w AS any_ok, bool_or(NOT rep) OVER w AS any_usable, max(temperature) OVER w AS last_t
  FROM a WINDOW w AS (PARTITION BY user_id, seg)),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, seg ORDER BY CASE WHEN any_ok THEN accepted WHEN any_usable THEN NOT rep
  ELSE true END DESC, CASE WHEN any_ok THEN 0 ELSE -avg_logprob END, temperature) AS rn FROM g)
SELECT user_id, seg, event_id, avg_logprob, CASE WHEN any_ok THEN temperature ELSE last_t END AS temperature, any_ok AS accepted
FROM r WHERE rn = 1""")
def _(spark, sf_dir):
    from pyspark.sql import Window

    v = F.round(F.col("value") * 100).cast("long")
    seg = F.floor(F.col("event_id") / 1000)
    # A segment has at most 1000 events here, whatever a user's share.
    nth = F.row_number().over(Window.partitionBy("user_id", "seg").orderBy("event_id"))
    rows = table(spark, sf_dir, "events").withColumn("seg", seg).select(
        "user_id", "seg", "event_id", (nth / 5.0).alias("temperature"), (-(v % 200) / 100.0).alias("avg_logprob"),
        ((v % 37) / 10.0).alias("compression_ratio"), ((v % 10) / 10.0).alias("no_speech_prob"))
    picked = hypotheses.select_hypothesis(rows, ["user_id", "seg"])
    return picked.drop("compression_ratio", "no_speech_prob")
