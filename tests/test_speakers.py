"""Speakers by dyadic time cells against a comparison of every word with every turn."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from parley.operators.words import assign_speakers, turn_cells

WORD = "call_id long, word_no long, start double, end double, word string"
TURN = "call_id long, speaker string, start double, end double"


def plain(words, turns):
    out = []
    for call, no, start, end, word in words:
        spans = defaultdict(float)
        for c, speaker, ts, te in turns:
            if c == call and None not in (start, end) and te > ts and end > start and start < te and end > ts:
                spans[speaker] += min(end, te) - max(start, ts)
        out.append((call, no, word, min(spans, key=lambda s: (-spans[s], s)) if spans else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_against_every_pair(spark, seed):
    rng = random.Random(seed)
    calls = [1, 2, None]
    turns = [(rng.choice(calls), rng.choice("abc"), s := rng.randrange(-4000, 4000) / 4, s + rng.choice([0, 0.25, 3, 25, 400, 3000, 1e7])) for _ in range(60)]
    turns += turns[:5]
    words = [(rng.choice(calls), i, s := rng.randrange(-6000, 6000) / 4, s + rng.choice([0, 0.25, 1, 12, 100, 50_000]), "w") for i in range(300)]
    words += [*words[:7], (1, 1000, None, 2.0, "x"), (9, 1001, 0.0, 1.0, "alone")]
    found = assign_speakers(spark.createDataFrame(words, WORD), spark.createDataFrame(turns, TURN))
    assert found.columns == ["call_id", "word_no", "start", "end", "word", "speaker"]
    assert sorted(((r["call_id"], r["word_no"], r["word"], r["speaker"]) for r in found.collect()), key=repr) == plain(words, turns)


def test_long_turns_take_few_cells(spark):
    turns = [(1, "a", float(s), float(s) + length) for s in (0, 7, -123_456_789) for length in (1.0, 60.0, 3600.0, 1e9, 1e18)]
    rows = turn_cells(spark.createDataFrame(turns, TURN)).select((F.col("te") - F.col("ts")).alias("long"), F.size("_cover").alias("n"), (F.size("_cover") + F.size("_start")).alias("all")).collect()
    assert max(r["all"] for r in rows if r["long"] <= 1e9) <= 64
    assert max(r["n"] for r in rows) < 300


def test_empty_tables(spark):
    words, turns = spark.createDataFrame([(1, 0, 0.0, 1.0, "w")], WORD), spark.createDataFrame([(1, "a", 0.0, 1.0)], TURN)
    assert assign_speakers(words.limit(0), turns).collect() == []
    assert [r["speaker"] for r in assign_speakers(words, turns.limit(0)).collect()] == [None]


def test_words_are_read_once(spark):
    words, turns = spark.range(10).selectExpr("id % 3 call_id", "id word_no", "double(id) start", "id + 0.5d end", "'w' word"), spark.createDataFrame([(1, "a", 0.0, 9.0)], TURN)
    plan = assign_speakers(words, turns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 10") == 1
