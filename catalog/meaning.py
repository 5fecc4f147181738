"""Queries on topics, sentiment, summaries, prompts and the call report."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import CALLS_SQL, LEXICON, LEXICON_SQL, calls
from catalog.registry import query, table, texts
from parley.functions.text import words
from parley.operators import responses, segments, sentiment, summary, topics
from parley.plans import calls as plans


def _topics(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("label").alias("topic"), F.col("embedding").alias("vector"))
    return topics.topic_centroids(vectors)


def _sentences(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % 50).alias("call_id"), F.col("vec_id").alias("pos"), F.col("embedding").alias("vector"))


CENTROIDS_SQL = """
parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
means AS (SELECT label, i, avg(x) AS x FROM parts GROUP BY 1, 2),
topics AS (SELECT label AS topic, list(x ORDER BY i) AS vector FROM means GROUP BY 1)"""
HITS_SQL = CENTROIDS_SQL + """,
scored AS (SELECT vec_id % 50 AS call_id, vec_id AS pos, topic, list_cosine_similarity(embedding::DOUBLE[], vector) AS cosine
  FROM embeddings, topics),
hits AS (SELECT * FROM scored WHERE cosine > 0.15)"""


@query("topic_centroids", f"WITH {CENTROIDS_SQL} SELECT label AS topic, i AS pos, round(x, 6) AS x FROM means")
def _(spark, sf_dir):
    rows = _topics(spark, sf_dir).select("topic", F.posexplode("vector").alias("pos", "x"))
    return rows.withColumn("x", F.round("x", 6))


@query("match_topics", f"WITH {HITS_SQL} SELECT call_id, pos, topic, round(cosine, 6) AS cosine FROM scored WHERE cosine > 0.35")
def _(spark, sf_dir):
    hits = topics.match_topics(_sentences(spark, sf_dir), _topics(spark, sf_dir))
    return hits.withColumn("cosine", F.round("cosine", 6))


@query("top_topics", f"""
WITH {HITS_SQL} SELECT call_id, pos, topic, round(cosine, 6) AS cosine,
  CAST(row_number() OVER (PARTITION BY call_id ORDER BY cosine DESC, pos, topic) AS INTEGER) AS rank FROM hits QUALIFY rank <= 10""")
def _(spark, sf_dir):
    hits = topics.match_topics(_sentences(spark, sf_dir), _topics(spark, sf_dir), 0.15)
    return topics.top_topics(hits).withColumn("cosine", F.round("cosine", 6))


@query("topic_list", f"""
WITH {HITS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY cosine DESC, pos, topic) AS rank FROM hits)
SELECT call_id, string_agg(topic, ',' ORDER BY rank) AS topics FROM r WHERE rank <= 10 GROUP BY 1""")
def _(spark, sf_dir):
    hits = topics.match_topics(_sentences(spark, sf_dir), _topics(spark, sf_dir), 0.15)
    return topics.topic_list(hits).withColumn("topics", F.array_join("topics", ","))


@query("centroid_assign", f"""
WITH {HITS_SQL} SELECT call_id, pos, topic, round(cosine, 6) AS cosine FROM scored
QUALIFY row_number() OVER (PARTITION BY pos ORDER BY cosine DESC, topic) = 1""")
def _(spark, sf_dir):
    nearest = topics.centroid_assign(_sentences(spark, sf_dir), _topics(spark, sf_dir))
    return nearest.withColumn("cosine", F.round("cosine", 6))


@query("primary_secondary", f"""
WITH {HITS_SQL}, best AS (SELECT call_id, topic, max(cosine) AS score FROM hits GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY score DESC, topic) AS rn FROM best)
SELECT call_id, coalesce(max(topic::VARCHAR) FILTER (rn = 1), 'Unidentified') AS primary_topic,
  coalesce(max(topic::VARCHAR) FILTER (rn = 2), 'None') AS secondary_topic FROM r GROUP BY 1""")
def _(spark, sf_dir):
    hits = topics.match_topics(_sentences(spark, sf_dir), _topics(spark, sf_dir), 0.15)
    return topics.primary_secondary(hits.withColumnRenamed("cosine", "score"))


@query("softmax_scores", f"""
WITH {HITS_SQL} SELECT call_id, pos, topic, round(exp(cosine) / sum(exp(cosine)) OVER (PARTITION BY call_id), 6) AS probability FROM hits""")
def _(spark, sf_dir):
    hits = topics.match_topics(_sentences(spark, sf_dir), _topics(spark, sf_dir), 0.15)
    return topics.softmax_scores(hits, score="cosine").drop("cosine").withColumn("probability", F.round("probability", 6))


@query("detect_language", """
WITH s AS (SELECT user_id AS call_id, event_type AS language, value / 500 AS probability FROM events)
SELECT call_id, language, probability FROM s QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY probability DESC, language) = 1""")
def _(spark, sf_dir):
    scores = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("call_id"), F.col("event_type").alias("language"), (F.col("value") / 500).alias("probability"))
    return topics.detect_language(scores)


LABELS_SQL = f"""
{CALLS_SQL},
s AS (SELECT call_id, segment_no, string_split_regex(text, '[.!?] ') AS c FROM calls),
u AS (SELECT call_id, segment_no, unnest(c) AS sentence, unnest(range(len(c))) AS pos FROM s),
w AS (SELECT call_id, segment_no, pos, unnest(regexp_extract_all(lower(sentence), '[\\p{{L}}\\p{{N}}_]+', 0)) AS word FROM u),
m AS (SELECT call_id, segment_no, pos, sum(weight) / count(*) AS polarity FROM w JOIN {LEXICON_SQL} USING (word) GROUP BY 1, 2, 3),
labels AS (SELECT call_id, segment_no, pos, sentence, CASE WHEN coalesce(polarity, 0) >= 0.05 THEN 'positive'
  WHEN polarity <= -0.05 THEN 'negative' ELSE 'neutral' END AS label FROM u LEFT JOIN m USING (call_id, segment_no, pos))"""
MODES_SQL = LABELS_SQL + """,
counts AS (SELECT call_id, segment_no, label, count(*) AS n, min(pos) AS first FROM labels GROUP BY 1, 2, 3),
modes AS (SELECT call_id, segment_no, label AS sentiment FROM counts
  QUALIFY row_number() OVER (PARTITION BY call_id, segment_no ORDER BY n DESC, first) = 1)"""


@query("sentence_sentiment", f"WITH {LABELS_SQL} SELECT call_id, segment_no, pos, sentence, label FROM labels")
def _(spark, sf_dir):
    return sentiment.sentence_sentiment(calls(spark, sf_dir), lexicon=LEXICON)


@query("segment_sentiment_mode", f"WITH {MODES_SQL} SELECT * FROM modes")
def segment_sentiment_mode(spark, sf_dir):
    return sentiment.segment_sentiment_mode(calls(spark, sf_dir), lexicon=LEXICON).drop("text")


@query("call_sentiment_array", f"""
WITH {MODES_SQL} SELECT call_id, string_agg(segment_no || ':' || sentiment, ',' ORDER BY segment_no) AS segments FROM modes GROUP BY 1""")
def _(spark, sf_dir):
    rows = sentiment.call_sentiment_array(calls(spark, sf_dir), lexicon=LEXICON)
    shown = F.transform("segments", lambda s: F.concat(s["segment_no"].cast("string"), F.lit(":"), s["sentiment"]))
    return rows.select("call_id", F.array_join(shown, ",").alias("segments"))


@query("score_lexicon", f"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+', 0)) AS word FROM documents)
SELECT doc_id, coalesce(sum(weight), 0.0)::DOUBLE AS total, count(weight) AS matched, count(*) AS n_words
FROM w LEFT JOIN {LEXICON_SQL} USING (word) GROUP BY 1""")
def _(spark, sf_dir):
    tokens = texts(spark, sf_dir).select("doc_id", F.explode(words(F.col("text"))).alias("word"))
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, weight double")
    return sentiment.score_lexicon(tokens, lexicon, ["doc_id"])


def _summary_sql(source: str, keys: str) -> str:
    """CTE `summaries` of the texts of `source`."""
    blank = r"'\s+'"
    return f"""
ss AS (SELECT {keys}, text, string_split_regex(text, '[.!?] ') AS c FROM {source}),
su AS (SELECT {keys}, unnest(c) AS sentence, unnest(range(len(c))) AS pos FROM ss),
st AS (SELECT {keys}, pos, unnest(list_filter(string_split_regex(lower(sentence), {blank}), lambda x: x <> '')) AS token FROM su),
sf AS (SELECT {keys}, token, count(*) AS tf FROM st GROUP BY ALL),
sn AS (SELECT {keys}, count(*) AS n FROM st GROUP BY ALL),
sc AS (SELECT {keys}, pos, sum(tf)::DOUBLE / count(*) AS score, count(*) AS n FROM st JOIN sf USING ({keys}, token) GROUP BY ALL),
sk AS (SELECT *, row_number() OVER w AS rank, sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
  FROM sc WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC, pos)),
sl AS (SELECT {keys}, string_agg(sentence, ' ' ORDER BY pos) AS picked FROM sk JOIN su USING ({keys}, pos)
  WHERE used <= 150 OR rank = 1 GROUP BY ALL),
summaries AS (SELECT {keys}, CASE WHEN coalesce(n, 0) > 30 THEN picked
  WHEN regexp_replace(text, '\\s', '', 'g') = '' THEN 'Summary not generated for this transcription' ELSE text END AS summary
  FROM ss LEFT JOIN sn USING ({keys}) LEFT JOIN sl USING ({keys}))"""


@query("extractive_summary", f"""
WITH texts AS (SELECT doc_id, text FROM documents), {_summary_sql('texts', 'doc_id')} SELECT doc_id, summary FROM summaries""")
def _(spark, sf_dir):
    return summary.extractive_summary(texts(spark, sf_dir), ["doc_id"])


@query("summary_by_chunk", f"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS ws FROM documents),
tu AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM t),
texts AS (SELECT doc_id, i // 1000 AS chunk_no, string_agg(w, ' ' ORDER BY i) AS text FROM tu GROUP BY 1, 2),
{_summary_sql('texts', 'doc_id, chunk_no')}
SELECT doc_id, string_agg(summary, ' ' ORDER BY chunk_no) AS summary FROM summaries GROUP BY 1""")
def _(spark, sf_dir):
    return summary.summary_by_chunk(texts(spark, sf_dir), "doc_id")


@query("render_prompts", f"""
WITH {CALLS_SQL}
SELECT call_id, segment_no, 'steps' AS template, 'List the steps taken: ' || text || ' [END]' AS prompt FROM calls
UNION ALL SELECT call_id, segment_no, 'score', 'Rate from 1 to 10. ' || text FROM calls""")
def _(spark, sf_dir):
    templates = {"steps": "List the steps taken: {} [END]", "score": "Rate from 1 to 10. {}"}
    return responses.render_prompts(calls(spark, sf_dir), templates)


@query("parse_satisfaction", """
WITH r AS (SELECT event_id, event_id % 4 AS kind, CAST(floor(value) AS BIGINT) % 13 AS score, event_type AS reason FROM events)
SELECT event_id, CASE WHEN kind < 3 THEN CAST(score AS INTEGER) END AS score, CASE WHEN kind < 3 THEN reason END AS reason,
  kind < 3 AND score BETWEEN 1 AND 10 AS valid FROM r""")
def _(spark, sf_dir):
    kind, score = F.col("event_id") % 4, (F.floor("value") % 13).cast("string")
    answer = (F.when(kind == 0, F.format_string('{"Score": %s, "Reason": "%s"}', score, "event_type"))
              .when(kind == 1, F.format_string("Sure! {'Score': %s, 'Reason': '%s'}", score, "event_type"))
              .when(kind == 2, F.format_string('Score: "%s", Reason: "%s" as asked', score, "event_type"))
              .otherwise(F.concat(F.lit("no idea about "), "event_type")))
    rows = table(spark, sf_dir, "events").select("event_id", answer.alias("response"))
    return responses.parse_satisfaction(rows).drop("response")


def _call_table(spark, sf_dir):
    segs = calls(spark, sf_dir)
    scored = sentiment.segment_sentiment_mode(segs, lexicon=LEXICON)
    hits = topics.match_topics(_sentences(spark, sf_dir), _topics(spark, sf_dir), 0.15)
    return plans.join_stages(
        segments.concat_segments(segs).select("call_id", F.length("transcription").cast("long").alias("n_chars")),
        topics.primary_secondary(hits.withColumnRenamed("cosine", "score")),
        plans.call_sentiment(scored))


CALL_TABLE_SQL = f"""
{HITS_SQL}, best AS (SELECT call_id, topic, max(cosine) AS score FROM hits GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY score DESC, topic) AS rn FROM best),
named AS (SELECT call_id, max(topic::VARCHAR) FILTER (rn = 1) AS first, max(topic::VARCHAR) FILTER (rn = 2) AS second FROM r GROUP BY 1),
{MODES_SQL},
sums AS (SELECT call_id, sentiment, count(*) AS n, min(segment_no) AS first FROM modes GROUP BY 1, 2),
felt AS (SELECT call_id, sentiment FROM sums QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY n DESC, first) = 1),
sizes AS (SELECT call_id, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM calls GROUP BY 1),
call_table AS (SELECT call_id, n_chars, coalesce(first, 'Unidentified') AS primary_topic, coalesce(second, 'None') AS secondary_topic,
  coalesce(sentiment, 'No Sentiment Identified') AS sentiment
  FROM sizes LEFT JOIN named USING (call_id) LEFT JOIN felt USING (call_id))"""


@query("join_stages", f"WITH {CALL_TABLE_SQL} SELECT * FROM call_table")
def _(spark, sf_dir):
    return _call_table(spark, sf_dir)


@query("call_report", f"""
WITH {CALL_TABLE_SQL} SELECT primary_topic, sentiment, count(*) AS n_calls,
  CAST(grouping_id(primary_topic, sentiment) AS INTEGER) AS level FROM call_table GROUP BY CUBE (primary_topic, sentiment)""")
def _(spark, sf_dir):
    return plans.call_report(_call_table(spark, sf_dir))
