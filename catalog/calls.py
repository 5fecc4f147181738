"""Queries on sources, filters, calls and segments."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.fixtures import CALLS_SQL, WIDE_SQL, calls, wide_segments
from catalog.registry import query, table, texts
from parley.functions import audio, text, vectors
from parley.operators import edits, filters, scoring, segments
from parley.session import shared_dir, spread
from parley.sources import files, manifests, run_log, tables


def _scratch(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _landed_and_read(spark, sf_dir, format):
    documents = table(spark, sf_dir, "documents")
    path = _scratch(spark, f"documents-{format}")
    tables.write_table(documents, path, format)
    return tables.read_table(spark, path, format, documents.schema if format == "csv" else None)


DOCUMENTS_SQL = "SELECT doc_id, text, lang, source, n_chars FROM documents"


@query("table_feather", DOCUMENTS_SQL)
def _(spark, sf_dir):
    return _landed_and_read(spark, sf_dir, "feather")


@query("table_csv", DOCUMENTS_SQL)
def _(spark, sf_dir):
    return _landed_and_read(spark, sf_dir, "csv")


@query("table_parquet", DOCUMENTS_SQL)
def _(spark, sf_dir):
    return _landed_and_read(spark, sf_dir, "parquet")


@query("read_manifest", """
SELECT 'RE' || event_id AS sid, 'CA' || user_id AS call_sid, CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) AS duration,
  date_trunc('second', ts) AS date_created FROM events""")
def _(spark, sf_dir):
    entry = F.struct(
        F.concat(F.lit("RE"), F.col("event_id").cast("string")).alias("sid"),
        F.concat(F.lit("CA"), F.col("user_id").cast("string")).alias("call_sid"),
        F.floor(F.col("value") * 10).cast("long").cast("string").alias("duration"),
        F.date_trunc("second", "ts").alias("date_created"))
    # Manifest pages hold a bounded number of recordings, as a service would send them.
    pages = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 40).alias("page")).agg(
        F.collect_list(entry).alias("recordings"))
    path = _scratch(spark, "manifest")
    pages.select("recordings").write.json(path)
    landed = manifests.recordings(spark.read.schema(manifests.schemas.MANIFEST).json(path))
    return landed.drop("media_url")


@query("load_taxonomy", """
SELECT p_partkey, p_brand AS topic, unnest([0, 1]) AS phrase_no, unnest([p_type, p_name]) AS phrase FROM part""")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    taxonomy = F.to_json(F.map_from_arrays(F.array("p_brand"), F.array(F.array("p_type", "p_name"))))
    return manifests.load_taxonomy(part.select("p_partkey", taxonomy.alias("taxonomy")))


@query("file_inventory")
def _(spark, sf_dir):
    return files.file_inventory(spark, sf_dir)


@query("score_files")
def _(spark, sf_dir):
    def kilobytes(unit, batch):
        return batch.assign(kb=batch["length"] // unit)[["name", "kb"]]

    return scoring.score_files(files.list_files(spark, sf_dir).select("path", "name", "length"),
                               lambda: 1024, kilobytes, "name string, kb long", 8)


@query("run_log", """
SELECT 'redaction' AS stage, 'INFO' AS level, 'errors=' || count(*) FILTER (length(text) < 200) || ', rows=' || count(*) AS message
FROM documents""")
def _(spark, sf_dir):
    df, observation = run_log.observed(table(spark, sf_dir, "documents"), "redaction", F.length("text") < 200)
    df.write.format("noop").mode("overwrite").save()
    path = _scratch(spark, "run-log")
    run_log.write_run_log(spark, path, "redaction", observation.get)
    return spark.read.parquet(path).drop("logged_at")


@query("legacy_segments", f"""
WITH {CALLS_SQL} SELECT call_id, segment_no, segment_no * 1.5::DOUBLE AS start, text FROM calls WHERE segment_no % 3 <> 2
UNION ALL SELECT call_id, segment_no, NULL, NULL FROM calls WHERE segment_no % 3 = 2""")
def _(spark, sf_dir):
    quoted = F.regexp_replace(F.to_json(F.array("text")), r"^\[|\]$", "")
    stored = F.concat(F.lit("[{'start': "), (F.col("segment_no") * 1.5).cast("string"), F.lit(", 'text': "), quoted,
                      F.when(F.col("segment_no") % 3 == 2, "").otherwise("}]"))
    rows = calls(spark, sf_dir).select("call_id", "segment_no", stored.alias("stored"))
    rows = rows.withColumn("_s", F.explode_outer(manifests.legacy_segments("stored")))
    return rows.select("call_id", "segment_no", "_s.start", "_s.text")


@query("filter_min_duration", """
SELECT event_id, CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) AS duration FROM events WHERE floor(value * 10) > 60""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.floor(F.col("value") * 10).cast("string").alias("duration"))
    return filters.filter_min_duration(rows, 60)


@query("filter_date_range", """
SELECT event_id, ts AS date_created FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12'""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("date_created"))
    return filters.filter_date_range(rows, "2024-01-05T13:00:00", "2024-01-12T01:00:00")


@query("project_segment", f"""
WITH {WIDE_SQL} SELECT call_id, segment_no, start, "end", text, no_speech_prob AS no_speech_probability FROM wide""")
def _(spark, sf_dir):
    return filters.project_segment(wide_segments(spark, sf_dir))


@query("drop_empty_segments", f"""
WITH {WIDE_SQL} SELECT call_id, segment_no, start, "end", text FROM wide
WHERE start <> "end" AND regexp_replace(text, '\\s', '', 'g') <> ''""")
def _(spark, sf_dir):
    return filters.drop_empty_segments(wide_segments(spark, sf_dir)).select("call_id", "segment_no", "start", "end", "text")


@query("drop_silence", f"""
WITH {WIDE_SQL} SELECT call_id, segment_no, no_speech_prob, avg_logprob FROM wide
WHERE NOT (no_speech_prob > 0.6 AND NOT avg_logprob > -1.0)""")
def _(spark, sf_dir):
    return filters.drop_silence(wide_segments(spark, sf_dir)).select("call_id", "segment_no", "no_speech_prob", "avg_logprob")


@query("flag_repetitive")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", text.compression_ratio("text").alias("ratio"))
    return rows.withColumn("repetitive", F.col("ratio") > 2.4)


@query("filter_short_sentences", """
WITH s AS (SELECT doc_id, string_split(text, '.') AS c FROM documents),
k AS (SELECT doc_id, list_filter(c, lambda x: len(list_filter(string_split_regex(x, '\\s+'), lambda w: w <> '')) >= 5) AS c FROM s)
SELECT doc_id, unnest(range(len(c))) AS pos, unnest(c) AS sentence FROM k""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(text.period_chunks(F.col("text"), 5)).alias("pos", "sentence"))


@query("split_periods", """
WITH s AS (SELECT doc_id, string_split(text, '.') AS c FROM documents)
SELECT doc_id, unnest(range(len(c))) AS pos, unnest(c) AS piece FROM s""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(text.period_chunks(F.col("text"))).alias("pos", "piece"))


@query("head", f"WITH {CALLS_SQL} SELECT * FROM calls ORDER BY call_id, segment_no LIMIT 3")
def _(spark, sf_dir):
    return filters.head(calls(spark, sf_dir), 3, "call_id", "segment_no")


@query("to_text", "SELECT event_id, CAST(user_id AS VARCHAR) AS user_text FROM events")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.to_text(F.col("user_id")).alias("user_text"))


@query("validate_language", """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN lang || 'x' WHEN doc_id % 10 <> 1 THEN lang END AS lang FROM documents)
SELECT doc_id, lang, coalesce(lang IN ('en', 'fr', 'de', 'es'), false) AS known FROM d""")
def _(spark, sf_dir):
    n = F.col("doc_id") % 10
    lang = F.when(n == 0, F.concat("lang", F.lit("x"))).when(n != 1, F.col("lang"))
    known, unknown = filters.validate_language(table(spark, sf_dir, "documents").select("doc_id", lang.alias("lang")))
    return known.withColumn("known", F.lit(True)).unionByName(unknown.withColumn("known", F.lit(False)))


@query("status_default", """
SELECT doc_id, CASE WHEN doc_id % 4 < 3 THEN 'No Sentiment Identified' ELSE lang END AS status FROM documents""")
def _(spark, sf_dir):
    n = F.col("doc_id") % 4
    value = F.when(n == 0, "").when(n == 1, " \n").when(n == 3, F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", filters.status_default(value, filters.NO_SENTIMENT).alias("status"))


@query("dedupe_keep_first", """
SELECT doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def _(spark, sf_dir):
    return filters.dedupe_keep_first(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id")


@query("append_calls", """
SELECT conv_id AS call_id, text, CAST(turn AS BIGINT) AS segment_no FROM conversations
UNION ALL SELECT doc_id, text, NULL FROM documents""")
def _(spark, sf_dir):
    more = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("call_id"), "text")
    return filters.append_calls(calls(spark, sf_dir), more)


@query("taxonomy_diff", """
SELECT DISTINCT p_brand || p_size AS topic FROM part WHERE p_partkey % 2 = 0
EXCEPT SELECT p_brand || p_size FROM part WHERE p_partkey % 2 = 1""")
def _(spark, sf_dir):
    topics = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_brand", F.col("p_size").cast("string")).alias("topic"))
    even = F.col("p_partkey") % 2 == 0
    return filters.taxonomy_diff(topics.filter(even), topics.filter(~even))


@query("split_sentences", """
WITH s AS (SELECT doc_id, string_split_regex(text, '[.!?] ') AS c FROM documents)
SELECT doc_id, unnest(range(len(c))) AS pos, unnest(c) AS sentence FROM s""")
def _(spark, sf_dir):
    return segments.split_sentences(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("clean_summary", r"""
SELECT doc_id, regexp_replace(text, '[^\p{L}\p{N}_\s\p{Z}\x{0b}\x{85}.]', '', 'g') AS cleaned FROM documents""")
def _(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", text.clean_summary(F.col("text")).alias("cleaned"))


@query("alternate_speakers", f"""
WITH {CALLS_SQL} SELECT call_id, segment_no,
  CAST(2 - row_number() OVER (PARTITION BY call_id ORDER BY segment_no) % 2 AS INTEGER) AS speaker FROM calls""")
def _(spark, sf_dir):
    return segments.alternate_speakers(calls(spark, sf_dir)).drop("text")


@query("render_turns", f"""
WITH {CALLS_SQL}, t AS (SELECT *, 2 - row_number() OVER (PARTITION BY call_id ORDER BY segment_no) % 2 AS speaker FROM calls)
SELECT call_id, string_agg('Speaker ' || speaker || ': "' || regexp_replace(text, '^\\s+|\\s+$', '', 'g') || '"' || chr(10), ''
  ORDER BY segment_no) AS transcription FROM t GROUP BY 1""")
def _(spark, sf_dir):
    return segments.render_turns(calls(spark, sf_dir))


@query("concat_segments", f"""
WITH {CALLS_SQL} SELECT call_id, string_agg(text, '' ORDER BY segment_no) AS transcription FROM calls GROUP BY 1""")
def _(spark, sf_dir):
    return segments.concat_segments(calls(spark, sf_dir))


@query("fixed_token_chunks", """
WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS ws FROM documents),
u AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM t)
SELECT doc_id, i // 1000 AS chunk_no, string_agg(w, ' ' ORDER BY i) AS chunk FROM u GROUP BY 1, 2""")
def _(spark, sf_dir):
    return segments.fixed_token_chunks(texts(spark, sf_dir))


@query("pack_sentences", """
WITH RECURSIVE s AS (SELECT doc_id, string_split_regex(text, '[.!?] ') AS c FROM documents),
u AS (SELECT doc_id, unnest(c) AS sentence, unnest(range(len(c))) AS pos FROM s),
n AS (SELECT *, len(list_filter(string_split_regex(sentence, '\\s+'), lambda x: x <> '')) AS n FROM u),
r AS (SELECT doc_id, pos, sentence, n AS used, 0 AS chunk_no FROM n WHERE pos = 0
  UNION ALL
  SELECT n.doc_id, n.pos, n.sentence, CASE WHEN r.used + n.n < 200 THEN r.used + n.n ELSE n.n END,
    CASE WHEN r.used + n.n < 200 THEN r.chunk_no ELSE r.chunk_no + 1 END
  FROM r JOIN n ON n.doc_id = r.doc_id AND n.pos = r.pos + 1)
SELECT doc_id, chunk_no, string_agg(sentence, chr(10) ORDER BY pos) AS chunk FROM r GROUP BY 1, 2""")
def _(spark, sf_dir):
    return segments.pack_sentences(texts(spark, sf_dir), 200)


@query("pcm_to_float", """
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(trunc(x::DOUBLE * 32767) AS SMALLINT)) AS s FROM embeddings),
u AS (SELECT vec_id, unnest(s) AS s, unnest(range(len(s))) AS i FROM s)
SELECT vec_id, i % 2 AS channel, i // 2 AS pos, round(s / 32768.0::DOUBLE, 6) AS sample FROM u""")
def _(spark, sf_dir):
    samples = F.transform("embedding", lambda x: (x.cast("double") * 32767).cast("smallint"))
    both = F.transform(F.array(F.lit(0), F.lit(1)), lambda n: audio.channel(audio.pcm_to_float(samples), n))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(both).alias("channel", "_c"))
    rows = rows.select("vec_id", "channel", F.posexplode("_c").alias("pos", "sample"))
    return rows.withColumn("sample", F.round(F.col("sample").cast("double"), 6))


@query("frame_signal", """
WITH f AS (SELECT vec_id, embedding, unnest(range((len(embedding) + 9) // 10)) AS frame_no FROM embeddings),
p AS (SELECT vec_id, embedding, frame_no, unnest(range(10)) AS i FROM f)
SELECT vec_id, frame_no, i, CAST(coalesce(embedding[frame_no * 10 + i + 1], 0) AS DOUBLE) AS sample FROM p""")
def _(spark, sf_dir):
    frames = segments.frame_signal(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("samples")), 10)
    rows = frames.select("vec_id", "frame_no", F.posexplode("frame").alias("i", "sample"))
    return rows.withColumn("sample", F.col("sample").cast("double"))


@query("frame_signal_centred", """
WITH f AS (SELECT vec_id, embedding, unnest(range(len(embedding) // 4 + 1)) AS frame_no FROM embeddings),
p AS (SELECT vec_id, embedding, frame_no, unnest(range(10)) AS i FROM f),
q AS (SELECT vec_id, embedding, frame_no, i, abs(frame_no * 4 + i - 5) AS j, len(embedding) AS n FROM p)
SELECT vec_id, frame_no, i, CAST(embedding[CASE WHEN j < n THEN j ELSE 2 * (n - 1) - j END + 1] AS DOUBLE) AS sample FROM q""")
def _(spark, sf_dir):
    frames = segments.frame_signal(
        table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("samples")), 10, 4, reflect=True)
    rows = frames.select("vec_id", "frame_no", F.posexplode("frame").alias("i", "sample"))
    return rows.withColumn("sample", F.col("sample").cast("double"))


@query("format_timestamp", """
WITH t AS (SELECT event_id, CAST(round_even(event_id * 0.7305::DOUBLE * 1000.0::DOUBLE, 0) AS BIGINT) AS ms FROM events)
SELECT event_id, CASE WHEN ms >= 3600000 THEN lpad(CAST(ms // 3600000 AS VARCHAR), 2, '0') || ':' ELSE '' END
  || lpad(CAST(ms % 3600000 // 60000 AS VARCHAR), 2, '0') || ':' || lpad(CAST(ms % 60000 // 1000 AS VARCHAR), 2, '0')
  || '.' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') AS stamp FROM t""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", text.format_timestamp(F.col("event_id") * 0.7305).alias("stamp"))


@query("cosine", """
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 6) AS cosine FROM embeddings""")
def _(spark, sf_dir):
    cosine = vectors.cosine(F.col("embedding"), F.reverse("embedding"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(cosine, 6).alias("cosine"))


@query("samples_and_seconds", """
SELECT event_id, event_id * 1024 / 16000.0::DOUBLE AS seconds, CAST(trunc(value * 16000) AS BIGINT) AS samples,
  CAST(printf('%.2f', event_id * 0.015::DOUBLE) AS DOUBLE) AS rounded FROM events""")
def _(spark, sf_dir):
    seconds = text.samples_to_seconds(F.col("event_id") * 1024)
    return table(spark, sf_dir, "events").select(
        "event_id", seconds.alias("seconds"), text.seconds_to_samples(F.col("value")).alias("samples"),
        text.round2(F.col("event_id") * 0.015).alias("rounded"))


TIDY_SQL = r"""
tidy AS (SELECT *, list_filter(string_split_regex(original, '\s+'), lambda x: x <> '') AS ws FROM u),
corrected AS (SELECT *, regexp_replace(array_to_string(list_filter(ws,
  lambda x, i: i = 1 OR lower(x) <> lower(ws[i - 1])), ' '), ' +([,;:])', '\1', 'g') AS corrected FROM tidy)"""


@query("map_sentences", f"""
WITH s AS (SELECT doc_id, string_split_regex(text, '[.!?] ') AS c FROM documents),
u AS (SELECT doc_id, unnest(c) AS original, unnest(range(len(c))) AS pos FROM s), {TIDY_SQL}
SELECT doc_id, string_agg(corrected || ' ', '' ORDER BY pos) AS corrected FROM corrected GROUP BY 1""")
def _(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "doc_id", text.map_sentences(F.col("text"), text.tidy_sentence).alias("corrected"))


# DuckDB's distance counts bytes, so letters outside ASCII count as one mark.
@query("edit_audit", f"""
WITH {CALLS_SQL}, s AS (SELECT call_id, string_split_regex(text, '[.!?] ') AS c FROM calls),
u AS (SELECT call_id, unnest(c) AS original FROM s), {TIDY_SQL},
e AS (SELECT *, list_filter(string_split_regex(corrected, '\\s+'), lambda x: x <> '') AS cs FROM corrected)
SELECT call_id, count(*) AS sentences, count(*) FILTER (original <> corrected) AS changed,
  CAST(sum(levenshtein(regexp_replace(original, '[^ -~\\s]', '~', 'g'), regexp_replace(corrected, '[^ -~\\s]', '~', 'g'))) AS BIGINT) AS distance,
  CAST(sum(len(list_distinct(list_filter(ws, lambda x: NOT list_contains(cs, x))))) AS BIGINT) AS words_removed,
  CAST(sum(len(list_distinct(list_filter(cs, lambda x: NOT list_contains(ws, x))))) AS BIGINT) AS words_added
FROM e GROUP BY 1""")
def _(spark, sf_dir):
    return edits.edit_audit(spread(calls(spark, sf_dir)))


@query("score_batches", "SELECT doc_id, length(text) AS n_chars, length(text) // 100 AS score FROM documents")
def _(spark, sf_dir):
    def score(model, batch):
        n = batch["text"].str.len()
        return batch[["doc_id"]].assign(n_chars=n, score=n // model["unit"])

    return scoring.score_batches(table(spark, sf_dir, "documents").select("doc_id", "text"), lambda: {"unit": 100}, score,
                                 "doc_id long, n_chars long, score long")


@query("score_groups", f"""
WITH {CALLS_SQL} SELECT call_id, segment_no, CAST(sum(length(text)) OVER (PARTITION BY call_id ORDER BY segment_no) AS BIGINT) AS upto
FROM calls""")
def _(spark, sf_dir):
    def running(key, batches):
        total = 0
        for batch in batches:
            upto = batch["n"].cumsum() + total
            total = upto.iloc[-1]
            yield batch[["call_id", "segment_no"]].assign(upto=upto)

    rows = calls(spark, sf_dir).select("call_id", "segment_no", F.length("text").cast("long").alias("n"))
    return scoring.score_groups(rows, ["call_id"], ["segment_no"], running, "call_id long, segment_no long, upto long")
