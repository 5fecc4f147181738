"""Rows without a call are a call of their own in every operator that joins on calls, on both paths."""

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parley.operators import speech, summary, topics, words


def renamed(df, *columns):
    """The rows without a call, as those of the call that has the same ones."""
    return rows(df.filter("call_id is null"), *columns), rows(df.filter("call_id = 'x'"), *columns)


@pytest.fixture(scope="module")
def frames(spark):
    probs = [0.1] * 5 + [0.9] * 40 + [0.1] * 30 + [0.8] * 60 + [0.05] * 20
    return spark.createDataFrame([(c, i, p) for c in ("x", None) for i, p in enumerate(probs)], "call_id string, frame_idx long, prob double")


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("longest", [None, 1.5])
def test_chunks_of_frames_without_a_call(frames, small_blocks, hot, longest):
    options = speech.SpeechOptions(min_silence_ms=128, max_speech_s=longest or math.inf) if longest else speech.SpeechOptions(min_silence_ms=128)
    chunks = speech.speech_chunks(frames, options, hot=hot)
    lost, kept = renamed(chunks, "chunk_no", "start", "end")
    assert lost == kept and kept
    lengths = speech.audio_lengths(frames, options)
    for df in (speech.pad_chunks(chunks, lengths, options, hot), speech.speech_stats(chunks, lengths, options)):
        lost, kept = renamed(df, *[c for c in df.columns if c != "call_id"])
        assert lost == kept and kept
    assert all(r.duration_after > 0 for r in speech.speech_stats(chunks, lengths, options).collect())


@pytest.mark.parametrize("hot", [False, True])
def test_long_words_without_a_call(spark, small_blocks, hot):
    line = [(i, w, float(i), i + d) for i, (w, d) in enumerate([("a", .2), (".", 3.), ("b", 3.), ("c", .3), ("?", .1)])]
    df = spark.createDataFrame([(c, *x) for c in ("x", None) for x in line], "call_id string, word_no long, word string, start double, end double")
    found = words.trim_long_words(df, ["call_id"], hot=hot)
    assert found.count() == 10
    lost, kept = renamed(found, "word_no", "start", "end")
    assert lost == kept and kept


@pytest.mark.parametrize("hot", [False, True])
def test_segments_without_a_call(spark, small_blocks, hot):
    segments = spark.createDataFrame([(c, 0, s, s * 10.0, s * 10.0 + 9, 0.3) for c in ("x", None) for s in range(4)],
                                     "call_id string, window_no int, segment_no long, start double, end double, median double")
    spoken = spark.createDataFrame([(c, s, w, f"w{w}", s * 10.0 + w, s * 10.0 + w + 0.5) for c in ("x", None) for s in (0, 1, 3) for w in range(3)],
                                   "call_id string, segment_no long, word_no long, word string, start double, end double")
    fixed = words.fix_segment_boundaries(segments, spoken, hot=hot)
    lost, kept = renamed(fixed, "segment_no", "start", "end", "n_words", "after_pause")
    assert lost == kept and [r[3] for r in kept] == [3, 3, 0, 3]
    lost, kept = renamed(words.apply_boundaries(spoken, fixed), "segment_no", "word_no", "start", "end")
    assert lost == kept and len(kept) == 9


def test_speakers_of_words_without_a_call(spark):
    spoken = spark.createDataFrame([(c, i, float(i), i + 0.8) for c in ("x", None) for i in range(6)], "call_id string, word_no long, start double, end double")
    turns = spark.createDataFrame([(c, s, a, b) for c in ("x", None) for s, a, b in (("A", 0.0, 3.0), ("B", 2.5, 30.0))], "call_id string, speaker string, start double, end double")
    lost, kept = renamed(words.assign_speakers(spoken, turns), "word_no", "speaker")
    assert lost == kept and [r[1] for r in kept] == list("AAABBB")


def test_probabilities_of_any_scores(spark):
    data = [("x", 1.0), ("x", 2.5), (None, 1.0), (None, 2.5), ("big", 1000.0), ("big", 999.0), ("low", -800.0), ("none", None), ("y", None), ("y", 0.5)]
    found = topics.softmax_scores(spark.createDataFrame(data, "call_id string, score double"))
    lost, kept = renamed(found.withColumn("probability", F.round("probability", 9)), "score", "probability")
    assert lost == kept == [(1.0, round(1 / (1 + math.exp(1.5)), 9)), (2.5, round(1 / (1 + math.exp(-1.5)), 9))]
    told = {(r.call_id, r.score): r.probability for r in found.collect()}
    assert told["low", -800.0] == told["y", 0.5] == 1.0 and told["none", None] is None and told["y", None] is None
    assert told["big", 1000.0] == pytest.approx(1 / (1 + math.exp(-1))) and len(told) == 10
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_summaries_keep_every_row(spark):
    long = " ".join(f"Alpha beta {i} gamma delta." for i in range(60)) + " " + "beta " * 20 + "."
    df = spark.createDataFrame([(None, long), (2, long), (2, long), (None, None), (5, " "), (6, "short one")], "doc_id long, text string")
    found = rows(summary.extractive_summary(df, ["doc_id"]))
    assert len(found) == 6 and len({s for k, s in found if k in (2,)}) == 1
    assert [s for k, s in found if k == 2][0] in [s for k, s in found if k is None]
    assert (6, "short one") in found and (5, summary.NO_SUMMARY) in found and (None, summary.NO_SUMMARY) in found
    chunked = rows(summary.summary_by_chunk(df, "doc_id", chunk_tokens=50))
    assert len(chunked) == 6 and (5, summary.NO_SUMMARY) in chunked and (6, "short one") in chunked


def test_summary_equals_counting_by_hand(spark):
    import random
    import re
    from collections import Counter

    rng = random.Random(3)
    texts = [". ".join(" ".join(rng.choice("a b c d E f g h".split()) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 70))) for _ in range(30)]

    def by_hand(text):
        parts = re.split("[.!?] ", text)
        tokens = [p.lower().split() for p in parts]
        tf = Counter(t for own in tokens for t in own)
        if sum(tf.values()) <= 30:
            return text if text.strip() else summary.NO_SUMMARY
        ranked = sorted((-(sum(tf[t] for t in own) / len(own)), i) for i, own in enumerate(tokens) if own)[:150]
        used, chosen = 0, []
        for rank, (_, i) in enumerate(ranked):
            used += len(tokens[i])
            if used <= 150 or not rank:
                chosen.append(i)
        return " ".join(parts[i] for i in sorted(chosen))

    found = summary.extractive_summary(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ["doc_id"])
    assert dict(rows(found)) == {i: by_hand(t) for i, t in enumerate(texts)}
