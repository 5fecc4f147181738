"""One query per operator over its whole table, and the SQL each must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import (bpe, exact, jaccard, language, licenses, links, ngram, order_minhash, packing, prefix_trie, ranked, suffixes,
                        warc)
from parley.llm.common import held_out, table
from parley.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def vocabulary_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_cross_parsing")
def op1_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = language.sample(docs.where(~held_out("doc_id", 4)))
    told = language.identify(docs.select("doc_id", "text"), samples)
    return told.select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score", "bits_per_letter")


#: The rules that the contract of the query fixes.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query("op2_link_trust")
def op2_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.judge(table(spark, sf_dir, "pages"), RULES)


@query("op3_bpe_lexicon")
def op3_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op4_boundary_chains", """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
         q AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d, n) END AS keep FROM p)
    SELECT page_id, n AS payload_bytes, d AS payload_digest,
           CASE WHEN page_id < keep THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id < keep THEN keep END AS refers_to
    FROM q""")
def op4_boundary_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid4().hex}")


@query("op5_bin_slack_packing")
def op5_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op6_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"), largest=True)


@query("op9_weighted_backoff")
def op9_weighted_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = ngram.learn(docs.where(~held_out("doc_id", 7)))
    return ngram.score(docs, model, counts).withColumn("held_out", held_out("doc_id", 7))


@query("op10_order_minhash")
def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_edits(table(spark, sf_dir, "documents"))


@query("op7_chosen_paths")
def op7_chosen_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_suffix_splitters")
def op8_suffix_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


#: crc32 in SQL: a table of the polynomial, and a step for each character of a decimal number.
_CRC = """
    crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
                         CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


@query("op11_prefix_trie", f"""
    WITH {_CRC},
         own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
                 FROM conversations WHERE conv_id IS NOT NULL),
         convs AS (SELECT c, c - c % 5 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                          lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 9 AS h
                   FROM (SELECT DISTINCT c FROM own), crc_table),
         rebuilt AS (SELECT convs.c, k, 0 AS part, role, text FROM convs JOIN own ON own.c = base WHERE k <= h
                     UNION ALL SELECT convs.c, k, 1, role, text FROM convs JOIN own ON own.c = convs.c WHERE k > h),
         turns AS (SELECT c, row_number() OVER w AS depth, list((role, text)) OVER w AS path, strlen(text) AS bytes
                   FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, k)),
         steps AS (SELECT c, depth, path, bytes FROM turns UNION ALL SELECT c, 0, [], 0 FROM convs),
         lasts AS (SELECT c, max(depth) AS depth FROM steps GROUP BY c),
         nodes AS (SELECT depth, path, min(c) AS c, count(*) AS n, any_value(bytes) AS bytes FROM steps GROUP BY depth, path),
         up AS (SELECT a.c, a.depth, a.n, a.bytes, b.c AS parent FROM nodes a LEFT JOIN nodes b ON b.depth = a.depth - 1 AND b.path = a.path[:-2]),
         kids AS (SELECT parent AS c, depth - 1 AS depth, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY ALL),
         tall AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids USING (c, depth)),
         paths AS (SELECT nodes.c, nodes.depth, path FROM nodes),
         sums AS (SELECT a.c, a.depth, sum((t.n - 1) * t.bytes) AS saved, count(*) FILTER (WHERE t.n_children = 0) AS leaves
                  FROM tall t JOIN paths p ON p.c = t.c AND p.depth = t.depth, LATERAL (SELECT unnest(range(t.depth + 1)) AS d) r
                  JOIN nodes a ON a.depth = r.d AND a.path = p.path[:r.d] GROUP BY a.c, a.depth),
         ended AS (SELECT n.c, n.depth, sha256(string_agg(l.c::VARCHAR, ',' ORDER BY l.c)) AS ends
                   FROM lasts l JOIN steps s USING (c, depth) JOIN nodes n ON n.depth = s.depth AND n.path = s.path GROUP BY n.c, n.depth)
    SELECT tall.c AS conv_id, depth, parent AS parent_conv_id, n AS n_convs, n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens,
           coalesce(ends, sha256('')) AS ends_sha256
    FROM tall JOIN sums USING (c, depth) LEFT JOIN ended USING (c, depth)""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op12_reversed_search", r"""
    WITH terms(kind, id, found) AS (
             SELECT 0, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') FROM documents
             UNION ALL
             SELECT 1, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') FROM benchmark),
         docs AS (SELECT id, len(found) AS n FROM terms WHERE kind = 0 AND len(found) > 0),
         totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM docs),
         counts AS (SELECT kind, id, term, count(*) AS tf FROM (SELECT kind, id, unnest(found) AS term FROM terms) GROUP BY ALL),
         weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals WHERE kind = 0 GROUP BY term, docs),
         scores AS (SELECT i.id AS item_id, d.id AS doc_id, sum(i.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (25 + (75 * n * totals.docs) // length))))::BIGINT AS score
                    FROM counts i JOIN counts d ON i.term = d.term AND i.kind = 1 AND d.kind = 0 JOIN weights ON weights.term = i.term JOIN docs ON docs.id = d.id, totals
                    GROUP BY i.id, d.id)
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 10""")
def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


@query("op13_license_rules")
def op13_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summarised(licenses.scan(table(spark, sf_dir, "documents")))
