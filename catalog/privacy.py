"""Queries on personal data."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, table, texts
from parley.functions import pii
from parley.operators.gazetteer import tag_gazetteer
from parley.operators.names import name_words, redact_names

# The same expressions for DuckDB, whose classes and boundaries are ASCII.
FLAGS_SQL = "(?ism)"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _matches_sql(source: str, out: str = "spans") -> str:
    """CTE `out` of all matches with offsets, from the text between the matches."""
    parts = []
    for p in pii.PATTERNS:
        regex = _quoted(FLAGS_SQL + p.regex)
        parts.append(f"""
  SELECT doc_id, '{p.entity}' AS entity, {p.score}::DOUBLE AS score,
    unnest(regexp_extract_all(text, {regex}, 0)) AS m, unnest(string_split_regex(text, {regex})) AS gap,
    unnest(range(len(string_split_regex(text, {regex})))) AS i
  FROM {source} WHERE regexp_matches(text, {regex})""")
    numbered = [f"SELECT *, {n} AS pattern FROM ({p})" for n, p in enumerate(parts)]
    return f"""
pieces AS ({' UNION ALL '.join(numbered)}),
placed AS (SELECT *, sum(length(gap) + coalesce(length(m), 0)) OVER (PARTITION BY doc_id, pattern ORDER BY i) AS e FROM pieces),
{out} AS (SELECT doc_id, entity, CAST(e - length(m) AS BIGINT) AS start, CAST(e AS BIGINT) AS "end", score
  FROM placed WHERE m IS NOT NULL)"""


def _resolved_sql(source: str) -> str:
    return _matches_sql(source) + _outer_sql()


def _outer_sql() -> str:
    """CTE `resolved` of disjoint spans, from `spans`."""
    return """,
outer_spans AS (SELECT * FROM (SELECT *, max("end") OVER (PARTITION BY doc_id ORDER BY start, "end" DESC, score DESC, entity
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans) WHERE reach IS NULL OR "end" > reach),
heads AS (SELECT *, CASE WHEN entity = lag(entity) OVER w AND start < lag("end") OVER w THEN 0 ELSE 1 END AS head
  FROM outer_spans WINDOW w AS (PARTITION BY doc_id ORDER BY start)),
runs AS (SELECT *, sum(head) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM heads),
merged AS (SELECT doc_id, run, any_value(entity) AS entity, min(start) AS start, max("end") AS "end", max(score) AS score
  FROM runs GROUP BY 1, 2),
resolved AS (SELECT doc_id, entity, start,
  least("end", coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY start), "end")) AS "end", score FROM merged)"""


def _chain_sql(column: str) -> str:
    for p in pii.PATTERNS:
        column = f"regexp_replace({column}, {_quoted(FLAGS_SQL + p.regex)}, '<{p.entity}>', 'g')"
    return column


# Dates, amounts, titles and the like do not occur in the texts, so each is put after every fifth text once.
SAMPLES = (
    " Mrs. Doe paid $1,250.00 on March 3, 2021 and 03/04/2021; bill of $75.20. SSN 078-05-1120, confirmation number is"
    " AB12, 77, X9. Ship to 42 Elm Street, Springfield, IL 62704 or call (555) 555-0142, see https://example.com/a?b=1"
    " account 123456789012 ending 4321, write to jo.doe@example.com or Miss Ray.")
WITH_SAMPLES_SQL = f"d AS (SELECT doc_id, text || CASE WHEN doc_id % 5 = 2 THEN {_quoted(SAMPLES)} ELSE '' END AS text FROM documents)"


def _documents(spark, sf_dir):
    sample = F.when(F.col("doc_id") % 5 == 2, SAMPLES).otherwise("")
    return texts(spark, sf_dir).select("doc_id", F.concat("text", sample).alias("text"))


@query("pii_spans", f"WITH {WITH_SAMPLES_SQL}, {_matches_sql('d')} SELECT * FROM spans")
def _(spark, sf_dir):
    spans = pii.pii_spans(_documents(spark, sf_dir)).select("doc_id", F.explode("spans").alias("s"))
    return spans.select("doc_id", "s.entity", F.col("s.start").cast("long").alias("start"),
                        F.col("s.end").cast("long").alias("end"), "s.score")


@query("resolve_spans", f"WITH {WITH_SAMPLES_SQL}, {_resolved_sql('d')} SELECT * FROM resolved")
def _(spark, sf_dir):
    spans = pii.pii_spans(_documents(spark, sf_dir)).select(
        "doc_id", F.explode(pii.resolve_spans(F.col("spans"))).alias("s"))
    return spans.select("doc_id", "s.entity", F.col("s.start").cast("long").alias("start"),
                        F.col("s.end").cast("long").alias("end"), "s.score")


REDACTED_SQL = """
steps AS (SELECT *, coalesce(lag("end") OVER (PARTITION BY doc_id ORDER BY start), 0) AS before FROM resolved),
bodies AS (SELECT doc_id, string_agg(substring(text, before + 1, start - before) || '<' || entity || '>', '' ORDER BY start) AS body,
  max("end") AS upto FROM steps JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, coalesce(body || substring(text, upto + 1), text) AS redacted FROM d LEFT JOIN bodies USING (doc_id)"""


@query("redact_spans", f"WITH {WITH_SAMPLES_SQL}, {_resolved_sql('d')}, {REDACTED_SQL}")
def _(spark, sf_dir):
    return pii.redact_spans(_documents(spark, sf_dir)).drop("text")


@query("redact_entities", f"WITH {WITH_SAMPLES_SQL} SELECT doc_id, {_chain_sql('text')} AS redacted FROM d")
def _(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", pii.redact_entities(F.col("text")).alias("redacted"))


# The last of the four steps needs a look-ahead, which DuckDB lacks; it finds nothing in these texts.
@query("redact_sequences", r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text,
  '\b[\p{L}\p{N}_]+([.*\-_]+[\p{L}\p{N}_]+)+\b', '***', 'g'), '\b\d+\b', '[REDACTED]', 'g'),
  '\b[\p{L}\p{N}_]+([.*\-_]+[\p{L}\p{N}_]+)+\b', '[REDACTED]', 'g') AS redacted FROM documents""")
def _(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", pii.redact_sequences(F.col("text")).alias("redacted"))


@query("mask_terms", r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '\bthe\b', '***', 'g'), '\bwith\b', '****', 'g'),
  '\bis\b', '**', 'g') AS masked FROM documents""")
def _(spark, sf_dir):
    terms = F.array(*[F.lit(t) for t in ("the", "with", "is")])
    return texts(spark, sf_dir).select("doc_id", pii.mask_terms(F.col("text"), terms).alias("masked"))


@query("pii_report", f"WITH {WITH_SAMPLES_SQL}, {_resolved_sql('d')} SELECT entity, count(*) AS n_spans FROM resolved GROUP BY 1")
def _(spark, sf_dir):
    return pii.pii_report(_documents(spark, sf_dir))


NAMES_SQL = """names AS (SELECT DISTINCT lower(w) AS word, CASE WHEN length(w) % 2 = 0 THEN 'PERSON' ELSE 'LOCATION' END AS entity
  FROM (SELECT unnest(regexp_extract_all(text, '[\\p{L}\\p{N}_]+', 0)) AS w FROM benchmark))"""


@query("tag_gazetteer", f"""
WITH {NAMES_SQL},
w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+', 0)) AS m,
  unnest(string_split_regex(text, '[\\p{{L}}\\p{{N}}_]+')) AS gap,
  unnest(range(len(string_split_regex(text, '[\\p{{L}}\\p{{N}}_]+')))) AS i FROM documents),
placed AS (SELECT *, sum(length(gap) + coalesce(length(m), 0)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM w)
SELECT doc_id, entity, word, CAST(e - length(m) AS BIGINT) AS start, CAST(e AS BIGINT) AS "end"
FROM placed JOIN names ON word = lower(m)""")
def _(spark, sf_dir):
    word = F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    names = table(spark, sf_dir, "benchmark").select(word.alias("w"))
    names = names.select(F.lower("w").alias("word"), F.when(F.length("w") % 2 == 0, "PERSON").otherwise("LOCATION").alias("entity"))
    spans = tag_gazetteer(texts(spark, sf_dir), names.distinct())
    return spans.withColumns({"start": F.col("start").cast("long"), "end": F.col("end").cast("long")})


# Names of one to four words: how each item of `benchmark` begins.
MULTI_SQL = """
listed AS (SELECT list_slice(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+', 0), 1, 1 + item_id % 4) AS words,
  min(CASE item_id % 3 WHEN 0 THEN 'PERSON' WHEN 1 THEN 'LOCATION' ELSE 'ORGANIZATION' END) AS entity FROM benchmark GROUP BY 1),
cut AS (SELECT doc_id, regexp_extract_all(text, '[\\p{L}\\p{N}_]+', 0) AS ws, string_split_regex(text, '[\\p{L}\\p{N}_]+') AS gaps FROM d),
tokens AS (SELECT doc_id, unnest(ws) AS m, unnest(gaps[:len(ws)]) AS gap, unnest(range(1, len(ws) + 1)) AS i FROM cut),
located AS (SELECT *, lower(m) AS word, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM tokens),
word_runs AS (SELECT doc_id, word, i, e - length(m) AS start, list(word) OVER w AS words, list(e) OVER w AS ends, list(regexp_full_match(gap, '\\s+')) OVER w AS near
  FROM located WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
hits AS (SELECT doc_id, start, max(ends[len(listed.words)]) AS e, arg_max(entity, len(listed.words)) AS entity
  FROM word_runs JOIN listed ON listed.words[1] = word AND word_runs.words[:len(listed.words)] = listed.words
  WHERE NOT list_contains(near[2:len(listed.words)], false) GROUP BY 1, 2),
follows AS (SELECT a.doc_id, a.start, any_value(a.e) AS e, any_value(a.entity) AS entity, min(b.start) AS next
  FROM hits a LEFT JOIN hits b ON a.doc_id = b.doc_id AND b.start >= a.e GROUP BY 1, 2),
picked AS (SELECT * FROM follows QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY start) = 1
  UNION ALL SELECT f.* FROM picked p JOIN follows f ON f.doc_id = p.doc_id AND f.start = p.next),
spans AS (SELECT * FROM pattern_spans UNION ALL
  SELECT doc_id, entity, CAST(start AS BIGINT), CAST(e AS BIGINT), 0.85::DOUBLE FROM picked)"""


@query("redact_names", f"WITH RECURSIVE {WITH_SAMPLES_SQL}, {_matches_sql('d', 'pattern_spans')}, {MULTI_SQL}{_outer_sql()}, {REDACTED_SQL}")
def _(spark, sf_dir):
    words = name_words(F.col("text"))
    kind = F.element_at(F.array(F.lit("PERSON"), F.lit("LOCATION"), F.lit("ORGANIZATION")), (F.col("item_id") % 3 + 1).cast("int"))
    names = table(spark, sf_dir, "benchmark").select(F.array_join(F.slice(words, F.lit(1), (1 + F.col("item_id") % 4).cast("int")), " ").alias("name"), kind.alias("entity"))
    return redact_names(_documents(spark, sf_dir), names).drop("text")
