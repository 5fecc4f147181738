"""The whole way of a call: from raw segments to the call table."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from catalog.fixtures import CALLS_SQL, LEXICON, calls
from catalog.meaning import HITS_SQL, MODES_SQL, _sentences, _summary_sql, _topics
from catalog.privacy import MULTI_SQL, REDACTED_SQL, SAMPLES, _matches_sql, _outer_sql, _quoted
from catalog.registry import query, table
from parley.operators.names import name_words
from parley.plans.calls import process_calls
from parley.session import shared_dir

# Every tenth call tells names of one to four words, the first of each of its turns; every fifth call begins with samples.
CLEAN_SQL = f"""
clean AS (WITH RECURSIVE
  benchmark AS (SELECT conv_id + turn AS item_id, text FROM conversations WHERE conv_id % 10 = 0),
  d AS (SELECT conv_id * 4294967296 + turn AS doc_id, text || CASE WHEN conv_id % 5 = 2 AND turn = 0 THEN {_quoted(SAMPLES)} ELSE '' END AS text FROM conversations),
  {_matches_sql('d', 'pattern_spans')}, {MULTI_SQL}{_outer_sql()}, {REDACTED_SQL})"""
CLEAN_CALLS_SQL = "calls AS (SELECT doc_id // 4294967296 AS call_id, doc_id % 4294967296 AS segment_no, redacted AS text FROM clean)"


@query("call_pipeline", f"""
WITH {CLEAN_SQL}, {MODES_SQL.replace(CALLS_SQL, CLEAN_CALLS_SQL)},
texts AS (SELECT call_id, string_agg(text, '' ORDER BY segment_no) AS text FROM calls GROUP BY 1),
{_summary_sql('texts', 'call_id')},
sums AS (SELECT call_id, sentiment, count(*) AS n, min(segment_no) AS first FROM modes GROUP BY 1, 2),
felt AS (SELECT call_id, sentiment FROM sums QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY n DESC, first) = 1),
arrays AS (SELECT call_id, string_agg(segment_no || ':' || sentiment, ',' ORDER BY segment_no) AS segments FROM modes GROUP BY 1),
found AS (WITH {HITS_SQL}, best AS (SELECT call_id, topic, max(cosine) AS score FROM hits GROUP BY 1, 2),
  shares AS (SELECT *, exp(score) / sum(exp(score)) OVER (PARTITION BY call_id) AS p FROM best),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY cosine DESC, pos, topic) AS nth FROM hits),
  lists AS (SELECT call_id, string_agg(topic, ',' ORDER BY nth) AS topics FROM ranked WHERE nth <= 10 GROUP BY 1)
  SELECT call_id, any_value(topics) AS topics, string_agg(topic || ':' || CAST(round(p * 100000) AS BIGINT), ',' ORDER BY p DESC, topic) AS chances,
    list(topic::VARCHAR ORDER BY score DESC, topic) AS by_score FROM shares JOIN lists USING (call_id) GROUP BY 1)
SELECT call_id, texts.text AS transcription, summary, segments, coalesce(sentiment, 'No Sentiment Identified') AS sentiment,
  coalesce(by_score[1], 'Unidentified') AS primary_topic, coalesce(by_score[2], 'None') AS secondary_topic,
  coalesce(topics, 'UNIDENTIFIED') AS topics, coalesce(chances, '') AS chances
FROM texts LEFT JOIN summaries USING (call_id) LEFT JOIN arrays USING (call_id) LEFT JOIN felt USING (call_id) LEFT JOIN found USING (call_id)""")
def _(spark, sf_dir):
    sample = F.when((F.col("call_id") % 5 == 2) & (F.col("segment_no") == 0), SAMPLES).otherwise("")
    talk = calls(spark, sf_dir).withColumn("text", F.concat("text", sample))
    item = F.col("conv_id") + F.col("turn")
    kind = F.element_at(F.array(F.lit("PERSON"), F.lit("LOCATION"), F.lit("ORGANIZATION")), (item % 3 + 1).cast("int"))
    told = table(spark, sf_dir, "conversations").where("conv_id % 10 = 0")
    names = told.select(F.array_join(F.slice(name_words(F.col("text")), F.lit(1), (1 + item % 4).cast("int")), " ").alias("name"), kind.alias("entity"))
    rows = process_calls(talk, _sentences(spark, sf_dir), _topics(spark, sf_dir), names, f"{shared_dir(spark)}/calls-{uuid4().hex}", 0.15, LEXICON)
    segment = F.transform("segments", lambda s: F.concat(s["segment_no"].cast("string"), F.lit(":"), s["sentiment"]))
    chance = F.transform("topic_with_probabilities", lambda t: F.concat(t["topic"], F.lit(":"), F.round(t["probability"] * 100_000).cast("long").cast("string")))
    return rows.select("call_id", "transcription", "summary", F.array_join(segment, ",").alias("segments"), "sentiment", "primary_topic", "secondary_topic",
                       F.array_join("topics", ",").alias("topics"), F.array_join(chance, ",").alias("chances"))
