"""Calls, segments, words and frames derived from the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import table
from parley.functions.arrays import running_sums
from parley.functions.text import pieces
from parley.operators.ordered import MAX_GROUP_ROWS, is_hot, ordered
from parley.operators.speech import SpeechOptions
from parley.session import spread

# Weights of words the invented texts contain.
LEXICON = {"the": 1.0, "is": 0.5, "with": 1.0, "la": 0.5, "of": -1.0, "on": -0.5, "der": -1.0, "was": -0.5}
LEXICON_SQL = "(VALUES " + ", ".join(f"('{w}', {x}::DOUBLE)" for w, x in LEXICON.items()) + ") AS lexicon(word, weight)"

# The frames are short, so pauses of two windows end a chunk.
OPTIONS = SpeechOptions(min_silence_ms=128)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("call_id"), F.col("turn").alias("segment_no"), "text")


CALLS_SQL = "calls AS (SELECT conv_id AS call_id, turn AS segment_no, text FROM conversations)"


def wide_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    return calls(spark, sf_dir).select(
        "call_id", "segment_no", (F.col("segment_no") * 30.0).alias("start"),
        F.when(n % 5 == 0, F.col("segment_no") * 30.0).otherwise(F.col("segment_no") * 30.0 + n / 100.0).alias("end"),
        F.when(n % 7 == 0, F.lit(" \n ")).otherwise(F.col("text")).alias("text"),
        ((n % 100) / 100.0).alias("no_speech_prob"),
        (-((F.col("segment_no") * 37 + n) % 200) / 100.0).alias("avg_logprob"))


WIDE_SQL = CALLS_SQL + """, wide AS (
  SELECT call_id, segment_no, segment_no * 30.0::DOUBLE AS start,
    CASE WHEN length(text) % 5 = 0 THEN segment_no * 30.0::DOUBLE
         ELSE segment_no * 30.0::DOUBLE + length(text) / 100.0::DOUBLE END AS "end",
    CASE WHEN length(text) % 7 = 0 THEN chr(32) || chr(10) || chr(32) ELSE text END AS text,
    (length(text) % 100) / 100.0::DOUBLE AS no_speech_prob,
    -((segment_no * 37 + length(text)) % 200) / 100.0::DOUBLE AS avg_logprob
  FROM calls)"""


def has_hot_call(spark: SparkSession, sf_dir: str) -> bool:
    """Checked once per query on the events: chunks are fewer than frames, and times are two per frame."""
    return is_hot(table(spark, sf_dir, "events"), ["user_id"], MAX_GROUP_ROWS // 3)


def frames(spark: SparkSession, sf_dir: str, hot: bool) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("call_id"), "ts", "event_id", (F.round(F.col("value") * 100).cast("long") % 100).alias("pct"))
    day = F.floor(F.unix_micros("ts") / 86_400_000_000)
    numbered = ordered(events, ["call_id"], ["ts", "event_id"], day, hot).number("n").rows()
    return numbered.select("call_id", (F.col("n") - 1).alias("frame_idx"), (F.col("pct") / 100.0).alias("prob"))


FRAMES_SQL = """f AS (
  SELECT user_id AS call_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i,
    CAST(round(value * 100) AS BIGINT) % 100 AS p FROM events),
lengths AS (SELECT call_id, count(*) * 1024 AS samples FROM f GROUP BY 1)"""

CHUNKS_SQL = FRAMES_SQL + """,
g AS (SELECT *, sum(CASE WHEN p >= 50 THEN 1 ELSE 0 END) OVER (PARTITION BY call_id ORDER BY i) AS g FROM f),
gg AS (SELECT call_id, g, min(i) FILTER (p >= 50) AS hi, min(i) FILTER (p < 35) AS lo1, max(i) FILTER (p < 35) AS lo2
  FROM g WHERE g > 0 GROUP BY 1, 2),
b AS (SELECT *, CASE WHEN (lo2 - lo1) * 1024 >= 2048 THEN 1 ELSE 0 END AS brk FROM gg),
isl AS (SELECT *, coalesce(sum(brk) OVER (PARTITION BY call_id ORDER BY g
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM b),
c AS (SELECT call_id, island, min(hi) * 1024 AS s, max(CASE WHEN brk = 1 THEN lo1 * 1024 END) AS e FROM isl GROUP BY 1, 2),
chunks AS (SELECT call_id, row_number() OVER (PARTITION BY call_id ORDER BY s) - 1 AS chunk_no, s AS start,
  coalesce(e, samples) AS "end" FROM c JOIN lengths USING (call_id) WHERE coalesce(e, samples) - s > 4000)"""

PADDED_SQL = CHUNKS_SQL + """,
near AS (SELECT *, start - lag("end") OVER w AS gap0, lead(start) OVER w - "end" AS gap1, lag("end") OVER w IS NULL AS is_first
  FROM chunks JOIN lengths USING (call_id) WINDOW w AS (PARTITION BY call_id ORDER BY start)),
padded AS (SELECT call_id, chunk_no,
  CAST(greatest(0, start - CASE WHEN gap0 < 12800 THEN gap0 // 2 ELSE 6400 END) AS BIGINT) AS start,
  CAST(CASE WHEN gap1 < 12800 THEN "end" + gap1 // 2 ELSE least(samples, "end" + 6400) END AS BIGINT) AS "end" FROM near)"""

SILENCE_SQL = PADDED_SQL + """,
gaps AS (SELECT *, start - coalesce(lag("end") OVER (PARTITION BY call_id ORDER BY start), 0) AS gap FROM padded),
silence AS (SELECT *, CAST(sum(gap) OVER (PARTITION BY call_id ORDER BY start) AS BIGINT) AS silence FROM gaps)"""


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words `(call_id, segment_no, word_no, word, start, end)` of calls; a segment starts every 120 s."""
    spoken = spread(calls(spark, sf_dir)).withColumn("_words", pieces(F.col("text")))
    ms = F.transform("_words", lambda w: F.when(F.length(w) % 7 == 0, 900).otherwise(F.length(w) * 40 - 40))
    spoken = spoken.withColumn("_ms", ms).withColumn("_ends", running_sums(F.col("_ms")))
    rows = spoken.select("call_id", "segment_no", F.posexplode(F.arrays_zip("_words", "_ms", "_ends")).alias("word_no", "_w"))
    base = F.col("segment_no") * 120_000
    return rows.select(
        "call_id", "segment_no", "word_no", F.col("_w._words").alias("word"),
        ((base + F.col("_w._ends") - F.col("_w._ms")) / 1000.0).alias("start"),
        ((base + F.col("_w._ends")) / 1000.0).alias("end"))


WORDS_SQL = CALLS_SQL + """,
w0 AS (SELECT call_id, segment_no, list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS ws FROM calls),
w1 AS (SELECT call_id, segment_no, unnest(ws) AS word, unnest(range(len(ws))) AS word_no FROM w0),
w2 AS (SELECT *, CASE WHEN length(word) % 7 = 0 THEN 900 ELSE length(word) * 40 - 40 END AS ms FROM w1),
w3 AS (SELECT *, sum(ms) OVER (PARTITION BY call_id, segment_no ORDER BY word_no) + segment_no * 120000 AS e FROM w2),
words AS (SELECT call_id, segment_no, word_no, word, (e - ms) / 1000.0::DOUBLE AS start, e / 1000.0::DOUBLE AS "end" FROM w3)"""
