"""Topics, sentiment, hypotheses, prompts, speakers, markers."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from parley.operators import hypotheses, responses, segments, sentiment, topics, words
from parley.plans import calls


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    sentences = spark.createDataFrame([(int(i % 5), int(i), [float(x) for x in rng.normal(size=8)]) for i in range(200)],
                                      "call_id long, pos long, vector array<float>")
    names = spark.createDataFrame([(f"t{i:02d}", [float(x) for x in rng.normal(size=8)]) for i in range(30)],
                                  "topic string, vector array<double>")
    return sentences, names


def test_blocks_of_topics_give_the_same_hits(vectors, monkeypatch):
    sentences, names = vectors
    small = topics.match_topics(sentences, names)
    near = topics.centroid_assign(sentences, names)
    small_rows, near_rows = ([(r["pos"], r["topic"], round(r["cosine"], 9)) for r in d.orderBy("pos", "topic").collect()]
                             for d in (small, near))
    monkeypatch.setattr(topics, "MAX_TOPICS", 10)
    monkeypatch.setattr(topics, "BLOCK_TOPICS", 7)
    monkeypatch.setattr(topics, "GROUP_SENTENCES", 40)
    blocks, near_blocks = topics.match_topics(sentences, names), topics.centroid_assign(sentences, names)
    assert [(r["pos"], r["topic"], round(r["cosine"], 9)) for r in blocks.orderBy("pos", "topic").collect()] == small_rows
    assert [(r["pos"], r["topic"], round(r["cosine"], 9)) for r in near_blocks.orderBy("pos", "topic").collect()] == near_rows
    assert len(small_rows) > 100 and len(near_rows) == 200


def test_threshold_is_strict_and_zero_vectors_match_nothing(spark):
    sentences = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.6, 0.8])], "pos int, vector array<double>")
    names = spark.createDataFrame([("x", [2.0, 0.0]), ("none", [0.0, 0.0])], "topic string, vector array<double>")
    assert rows(topics.match_topics(sentences, names, 0.6)) == [(1, "x", 1.0)]
    assert rows(topics.centroid_assign(sentences, names), "pos", "topic") == [(1, "x"), (3, "x")]


def test_missing_vectors_and_long_topic_numbers(spark):
    sentences = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "pos int, vector array<double>")
    numbers = spark.createDataFrame([(1 << 40, [2.0, 0.0]), (7, None)], "topic long, vector array<double>")
    assert rows(topics.match_topics(sentences, numbers)) == [(1, 1 << 40, 1.0)]


def test_no_topics(spark, vectors):
    empty = spark.createDataFrame([], "topic string, vector array<double>")
    assert topics.match_topics(vectors[0], empty).count() == 0


def test_centroids_by_dimension_and_by_element(vectors):
    phrases = vectors[0].select((F.col("pos") % 3).alias("topic"), "vector")
    wide, long = (topics.topic_centroids(phrases, dim=dim).orderBy("topic").collect() for dim in (8, None))
    for a, b in zip(wide, long):
        assert a["topic"] == b["topic"] and a["vector"] == pytest.approx(b["vector"])


def test_top_hits(spark):
    hits = [(1, i, "t", 0.5 + i / 100) for i in range(11)] + [(1, 20, "u", 0.6), (1, 21, "a", 0.6), (2, 0, "t", 0.4)]
    df = spark.createDataFrame(hits, "call_id int, pos int, topic string, cosine double")
    listed = dict(rows(topics.topic_list(df)))
    assert len(listed[1]) == 10 and listed[1][:3] == ["t", "u", "a"] and listed[2] == ["t"]
    first = topics.primary_secondary(df, score="cosine")
    assert rows(first) == [(1, "a", "t"), (2, "t", "None")] or rows(first) == [(1, "t", "a"), (2, "t", "None")]
    repeated = topics.primary_secondary(df.filter("topic = 't'"), score="cosine", distinct=False)
    assert rows(repeated) == [(1, "t", "t"), (2, "t", "None")]


def test_softmax_adds_up(spark):
    df = spark.createDataFrame([(1, "a", 0.1), (1, "b", 0.9), (2, "c", 5.0)], "call_id int, topic string, score double")
    found = topics.softmax_scores(df).groupBy("call_id").agg(F.sum("probability").alias("p"))
    assert [r["p"] for r in found.collect()] == pytest.approx([1.0, 1.0])


LEX = {"good": 1.0, "bad": -1.0, "meh": 0.01}


@pytest.mark.parametrize("value, label", [
    ("Good. good! Bad", "positive"),  # the second mark is no break before `Bad`... three sentences, two good
    ("bad. good", "negative"),  # a tie goes to the first seen
    ("hm. good. bad", "neutral"),  # three ways
    ("", "neutral"), ("good bad", "neutral"), ("meh", "neutral"), ("BAD, so bad. ", "negative"),
])
def test_segment_labels(spark, value, label):
    df = spark.createDataFrame([(value,)], "text string")
    assert sentiment.segment_sentiment_mode(df, lexicon=LEX).first()["sentiment"] == label


def test_call_label_tie_goes_to_the_first(spark):
    df = spark.createDataFrame([(1, 2, "positive"), (1, 1, "negative"), (2, 1, "neutral")], "call_id int, segment_no int, sentiment string")
    assert rows(calls.call_sentiment(df)) == [(1, "negative"), (2, "neutral")]


def candidate(t, logprob, ratio, silence):
    return (t, logprob, ratio, silence, f"t{t}")


@pytest.mark.parametrize("found, text, temperature, accepted", [
    ([candidate(0.0, -0.5, 1.0, 0.1), candidate(0.2, -0.1, 1.0, 0.1)], "t0.0", 0.0, True),
    ([candidate(0.0, -0.5, 3.0, 0.1), candidate(0.2, -0.9, 2.4, 0.1)], "t0.2", 0.2, True),
    ([candidate(0.0, -3.0, 3.0, 0.7)], "t0.0", 0.0, True),  # silence
    ([candidate(0.0, -1.1, 3.0, 0.1), candidate(0.2, -2.0, 1.0, 0.1), candidate(0.4, -3.0, 1.0, 0.1)], "t0.2", 0.4, False),
    ([candidate(0.0, -1.5, 3.0, 0.1), candidate(0.2, -1.2, 3.0, 0.1)], "t0.2", 0.2, False),
    ([candidate(0.0, -1.5, 3.0, 0.1), candidate(0.2, -1.5, 3.0, 0.1)], "t0.0", 0.2, False),
])
def test_hypotheses(spark, found, text, temperature, accepted):
    df = spark.createDataFrame([(1, *f) for f in found],
                               "seg int, temperature double, avg_logprob double, compression_ratio double, no_speech_prob double, text string")
    row = hypotheses.select_hypothesis(df, ["seg"]).first()
    assert (row["text"], row["temperature"], row["accepted"]) == (text, temperature, accepted)


def test_thresholds_turned_off(spark):
    df = spark.createDataFrame([(1, 0.0, -9.0, 9.0, 0.0, "a")],
                               "seg int, temperature double, avg_logprob double, compression_ratio double, no_speech_prob double, text string")
    assert hypotheses.select_hypothesis(df, ["seg"], None, None, None).first()["accepted"]


def test_prompt_text_is_taken_literally(spark):
    df = spark.createDataFrame([(1, r"costs $1 \1 {}")], "call_id int, text string")
    assert responses.render_prompts(df, {"a": "<{}>"}).first()["prompt"] == r"<costs $1 \1 {}>"


@pytest.mark.parametrize("response, score, valid", [
    ('{"Score": 7, "Reason": "ok"}', 7, True), ('{"Score": "10", "Reason": "ok"}', 10, True),
    ("Here: {'Score': 3, 'Reason': 'slow'}", 3, True), ('{"Score": 11}', 11, False), ('{"Score": 0}', 0, False),
    ("no idea", None, False), ("", None, False), (None, None, False),
])
def test_satisfaction(spark, response, score, valid):
    row = responses.parse_satisfaction(spark.createDataFrame([(response,)], "response string")).first()
    assert (row["score"], row["valid"]) == (score, valid)
    good, bad = responses.quarantine(responses.parse_satisfaction(spark.createDataFrame([(response,)], "response string")))
    assert (good.count(), bad.count()) == ((1, 0) if valid else (0, 1))


def test_speakers(spark):
    spoken = spark.createDataFrame([(1, 0, 0.0, 2.0), (1, 1, 9.0, 11.0), (1, 2, 50.0, 51.0), (1, 3, 3.0, 3.0), (1, 4, 5.0, 35.0)],
                                   "call_id int, word_no int, start double, end double")
    turns = spark.createDataFrame([(1, "b", 0.0, 1.0), (1, "a", 1.0, 2.0), (1, "a", 8.0, 9.5), (1, "b", 9.5, 20.0), (1, "c", 20.0, 30.0),
                                   (1, "c", 30.0, 31.0), (2, "x", 0.0, 99.0)],
                                  "call_id int, speaker string, start double, end double")
    found = {r["word_no"]: r["speaker"] for r in words.assign_speakers(spoken, turns).collect()}
    assert found == {0: "a", 1: "b", 2: None, 3: None, 4: "c"}  # equal shares; most; none; empty; sum over turns


M = 50364


@pytest.mark.parametrize("tokens, parts", [
    ([1, 2], [(10.0, 40.0, [1, 2])]),  # no marker: the whole window
    ([M, 1, M + 50], [(10.0, 11.0, [M, 1, M + 50])]),  # no pair: up to the last marker
    ([M, 1, M + 50, M + 50, 2, M + 100], [(10.0, 11.0, [M, 1, M + 50]), (11.0, 12.0, [M + 50, 2, M + 100])]),
    ([M, 1, M + 50, M + 50, 2], [(10.0, 11.0, [M, 1, M + 50])]),  # the unfinished rest is left out
    ([M], [(10.0, 40.0, [M])]),
])
def test_markers(spark, tokens, parts):
    df = spark.createDataFrame([(1, tokens, 10.0, 30.0)], "w int, tokens array<int>, time_offset double, segment_duration double")
    found = words.split_on_markers(df, M).orderBy("part").collect()
    assert [(pytest.approx(r["start"]), pytest.approx(r["end"]), r["tokens"]) for r in found] == parts


@pytest.mark.parametrize("pieces, merged", [
    ([" He", " said", ' "', "yes", '"', "."], [" He", " said", ' "yes".']),
    ([" (", ' "', " a", ")", "!", "?"], [' ( " a)!?']),
    ([" end "], [" end "]),
    ([" end ", ".", "!"], [" end ", ".!"]),  # nothing is joined to a word that ends with a blank
    ([" a", "", "."], [" a."]),
    ([" a", ' "'], [" a", ' "']),  # the last piece opens nothing
    ([".", " a"], [".", " a"]),
])
def test_punctuation(spark, pieces, merged):
    df = spark.createDataFrame([(1, i, p, float(i), i + 0.5) for i, p in enumerate(pieces)],
                               "call_id int, word_no int, word string, start double, end double")
    assert [r["word"] for r in words.merge_punctuation(df, ["call_id"]).orderBy("word_no").collect()] == merged


def test_median_ignores_empty_words(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.0, 1.0), (1, 1.0, 4.0), (2, 5.0, 5.0)], "call_id int, start double, end double")
    assert rows(words.median_word_duration(df, ["call_id"])) == [(1, 2.0), (2, 0.0)]


def test_stage_defaults(spark):
    base = spark.createDataFrame([(1,), (2,)], "call_id int")
    stage = spark.createDataFrame([(1, "bill", "late", "positive")], "call_id int, primary_topic string, secondary_topic string, sentiment string")
    joined = calls.join_stages(base, stage)
    assert rows(joined) == [(1, "bill", "late", "positive"), (2, "Unidentified", "None", "No Sentiment Identified")]
    assert calls.call_report(joined).filter("level = 3").first()["n_calls"] == 2


@pytest.mark.parametrize("hot", [False, True])
def test_long_and_odd_punctuation_runs(spark, hot):
    """A run of many marks is one row; nulls go first, an empty word ends as the mark before it."""
    texts = [" a", *["!"] * 3000, *[" ("] * 500, " b", None, ",", " ", "", ",", " (", "", ",", " ["]
    df = spark.createDataFrame([(None, i, w, float(i)) for i, w in enumerate(texts)], "call_id long, word_no long, word string, start double")
    found = [(r["word"], r["start"]) for r in words.merge_punctuation(df, ["call_id"], hot=hot).orderBy("word_no").collect()]
    assert found == [(" a" + "!" * 3000, 0.0), (" (" * 500 + " b,", 3501.0), (" ", 3505.0), (",", 3506.0), (" (,", 3508.0), (" [", 3510.0)]


def test_chunks_split_a_text_once(spark):
    text = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([(1, text), (2, " "), (3, None)], "id int, text string")
    found = df.select("id", segments.token_chunks(F.col("text"), 10).alias("chunks"))
    assert [c.split() for c in found.where("id = 1").first().chunks] == [[f"w{i}" for i in range(a, min(a + 10, 25))] for a in (0, 10, 20)]
    assert not [r.chunks for r in found.where("id > 1").collect() if r.chunks]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
