"""The blocked way gives what the plain window gives, and the check picks between them."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parley.operators import ordered as module
from parley.operators import segments, speech, words
from parley.operators.lookup import is_small, lookup
from parley.operators.ordered import is_hot, ordered, position_block


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(7)
    data = [(key, pos, rng.choice([None, 1, 2, 3])) for key in ("a", "b") for pos in sorted(rng.sample(range(90), 40))]
    data += [("c", 5, None), ("d", 0, 1), (None, 0, 2), (None, 3, None), (None, 40, 1), ("e", None, 3), ("e", 2, 1)]
    return spark.createDataFrame(data, "k string, pos long, v int")


@pytest.mark.parametrize("step", [
    lambda o: o.running_sum(x=F.coalesce("v", F.lit(0)), n=F.lit(1)),
    lambda o: o.number("x"),
    lambda o: o.previous(x=F.col("v"), p=F.col("pos")),
    lambda o: o.following(x=F.col("v"), p=F.col("pos")),
    lambda o: o.last_seen(x=F.col("v")),
    lambda o: o.previous(p=F.col("pos")).running_sum(gap=F.col("pos") - F.coalesce("p", F.lit(0))).last_seen(x=F.col("v")),
])
def test_blocked_equals_plain(numbers, small_blocks, step):
    plain, blocked = (step(ordered(numbers, ["k"], ["pos"], position_block("pos"), hot)).rows() for hot in (False, True))
    assert rows(plain) == rows(blocked, *plain.columns)


def test_hot_key_is_found(numbers):
    assert is_hot(numbers, ["k"], 39) and not is_hot(numbers, ["k"], 40)


def test_check_chooses_the_way(numbers, monkeypatch):
    assert not ordered(numbers, ["k"], ["pos"], position_block("pos")).hot
    monkeypatch.setattr(module, "is_hot", lambda df, keys: is_hot(df, keys, 10))
    assert ordered(numbers, ["k"], ["pos"], position_block("pos")).hot


def test_no_task_gets_a_whole_hot_key(numbers, small_blocks):
    """In the blocked plan, windows over rows are keyed by block; windows by key alone see summaries."""
    plan = ordered(numbers, ["k"], ["pos"], position_block("pos"), True).running_sum(x=F.lit(1)).df
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    by_key = [line for line in text.splitlines() if "Window [" in line and "_block" not in line.split("windowspecdefinition(")[1].split(" ASC")[0]]
    assert all("_s_x" in line for line in by_key)


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(3)
    data = []
    for call in range(6):
        prob = 0.1
        for i in range(300):
            if rng.random() < 0.15:
                prob = rng.choice([0.05, 0.2, 0.4, 0.45, 0.6, 0.9])
            data.append((call, i, prob))
    return spark.createDataFrame(data, "call_id long, frame_idx long, prob double")


OPTIONS = speech.SpeechOptions(min_silence_ms=400, min_speech_ms=200, pad_ms=150)


def test_speech_operators_blocked(frames, small_blocks):
    lengths = speech.audio_lengths(frames, OPTIONS)
    segs = frames.select("call_id", F.col("frame_idx").alias("segment_no"), (F.col("frame_idx") * 0.03).alias("start"),
                         (F.col("frame_idx") * 0.03 + 0.05).alias("end"))
    results = []
    for hot in (False, True):
        chunks = speech.speech_chunks(frames, OPTIONS, hot=hot)
        padded = speech.pad_chunks(chunks, lengths, OPTIONS, hot=hot)
        silence = speech.cumulative_silence(padded, OPTIONS, hot=hot)
        restored = speech.restore_times(segs, padded, OPTIONS, hot=hot)
        limited = speech.speech_chunks(frames, speech.SpeechOptions(min_silence_ms=400, max_speech_s=2.0), hot=hot)
        results.append([rows(d, *sorted(d.columns)) for d in (chunks, padded, silence, restored, limited)])
    assert results[0] == results[1]
    assert all(results[0])


def test_word_operators_blocked(spark, small_blocks):
    rng = random.Random(11)
    vocabulary = [" the", " word", "ly", ".", ",", ' "', " (", ")", '"', "", " stop ", "!?", " ¿", "。"]
    data, at = [], 0.0
    for n in range(400):
        length = rng.choice([0.0, 0.1, 0.2, 0.3, 1.5])
        data.append((n // 200, n, rng.choice(vocabulary), at, at + length))
        at += length + rng.choice([0.0, 0.2, 2.5])
    spoken = spark.createDataFrame(data, "call_id long, word_no long, word string, start double, end double")
    for operator in (words.trim_long_words, words.merge_punctuation):
        plain, blocked = (operator(spoken, ["call_id"], hot=hot) for hot in (False, True))
        assert rows(plain, *sorted(plain.columns)) == rows(blocked, *sorted(plain.columns))
    turns = [segments.alternate_speakers(spoken, number="word_no", hot=hot) for hot in (False, True)]
    assert rows(turns[0], *turns[0].columns) == rows(turns[1], *turns[0].columns)


def test_boundaries_blocked(spark, small_blocks):
    rng = random.Random(5)
    segs, spoken, at = [], [], 0.0
    for n in range(150):
        start = at
        for w in range(rng.choice([1, 1, 2, 3])):
            length = rng.choice([0.2, 0.5, 1.0, 2.0])
            spoken.append((1, n, w, at, at + length))
            at += length + rng.choice([0.0, 0.25, 1.5])
        segs.append((1, n // 10, n, start + rng.choice([-0.75, 0.0, 0.75]), at - rng.choice([0.0, 0.75, 1.5]), rng.choice([0.25, 0.5])))
    segs = spark.createDataFrame(segs, "call_id long, window_no long, segment_no long, start double, end double, median double")
    spoken = spark.createDataFrame(spoken, "call_id long, segment_no long, word_no long, start double, end double")
    plain, blocked = (words.fix_segment_boundaries(segs, spoken, hot=hot) for hot in (False, True))
    assert rows(plain, *sorted(plain.columns)) == rows(blocked, *sorted(plain.columns))
    assert {r[0] for r in plain.select("after_pause").distinct().collect()} == {True, False}


def test_large_reference_is_joined_salted(spark):
    tokens = spark.createDataFrame([(i, "the" if i % 3 else f"w{i}") for i in range(300)], "id long, word string")
    reference = spark.createDataFrame([("the", 1.0), ("w3", 2.0), ("zzz", 3.0)], "word string, weight double")
    for how in ("left", "inner"):
        small = lookup(tokens, reference, "word", F.col("id"), how)
        large = lookup(tokens, reference, "word", F.col("id"), how, max_rows=1, salts=4)
        assert rows(small, "id", "word", "weight") == rows(large, "id", "word", "weight")


def test_small_is_a_matter_of_rows_and_bytes(spark):
    wide = spark.createDataFrame([("a" * 1000, None), (None, [1.5])], "word string, vector array<double>")
    assert is_small(wide) and is_small(wide.limit(0))
    assert not is_small(wide, max_rows=1) and not is_small(wide, max_bytes=1000)


def test_transcript_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(segments, "BLOCK_ROWS", 4)
    data = [(c, n, f"{c}.{n} ") for c in (1, 2) for n in range(50)]
    df = spark.createDataFrame(random.Random(1).sample(data, len(data)), "call_id long, segment_no long, text string")
    found = dict(rows(segments.concat_segments(df)))
    assert found == {c: "".join(f"{c}.{n} " for n in range(50)) for c in (1, 2)}
    nested = {r[0]: [s["segment_no"] for s in r[1]] for r in segments.nested_segments(df, ["text"]).collect()}
    assert nested == {1: list(range(50)), 2: list(range(50))}
