"""Speech chunks against plain sequential reading, and edge cases."""

import random

import pandas as pd
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.functions.text import round2
from parley.operators import speech
from parley.operators.speech import SpeechOptions

W = 1024


def read_through(probs, options):
    """Chunks by reading the frames once."""
    chunks, begin, quiet = [], None, None
    silence, shortest = options.samples(options.min_silence_ms), options.samples(options.min_speech_ms)
    for i, p in enumerate(probs):
        if p >= options.threshold:
            quiet = None
            begin = i if begin is None else begin
        elif p < options.low and begin is not None:
            quiet = i if quiet is None else quiet
            if (i - quiet) * W >= silence:
                chunks.append((begin * W, quiet * W))
                begin = quiet = None
    if begin is not None:
        chunks.append((begin * W, len(probs) * W))
    return [(s, e) for s, e in chunks if e - s > shortest]


def frames_of(spark, calls):
    data = [(c, i, float(p)) for c, probs in enumerate(calls) for i, p in enumerate(probs)]
    return spark.createDataFrame(data, "call_id long, frame_idx long, prob double")


def chunks_by_call(df, n):
    found = {c: [] for c in range(n)}
    for r in df.orderBy("call_id", "chunk_no").collect():
        assert r["chunk_no"] == len(found[r["call_id"]])
        found[r["call_id"]].append((r["start"], r["end"]))
    return [found[c] for c in range(n)]


def random_calls(seed, n):
    rng = random.Random(seed)
    calls = []
    for _ in range(n):
        stay = rng.choice([0.3, 0.7, 0.9])
        probs, p = [], 0.1
        for _ in range(rng.randint(1, 200)):
            p = p if rng.random() < stay else rng.choice([0.0, 0.3, 0.349, 0.35, 0.4, 0.499, 0.5, 0.8])
            probs.append(p)
        calls.append(probs)
    return calls


@pytest.mark.parametrize("silence_ms", [30, 128, 500])
def test_chunks_equal_reading(spark, silence_ms):
    options = SpeechOptions(min_silence_ms=silence_ms)
    calls = random_calls(silence_ms, 120)
    found = chunks_by_call(speech.speech_chunks(frames_of(spark, calls), options), len(calls))
    assert found == [read_through(c, options) for c in calls]


@pytest.mark.parametrize("probs, chunks", [
    ([0.1] * 20, []),  # no speech
    ([0.9] * 20, [(0, 20 * W)]),  # speech from the first frame to the end
    ([0.4] * 20, []),  # only the band between
    ([0.9] * 8 + [0.1] * 3 + [0.9] * 8, [(0, 8 * W), (11 * W, 19 * W)]),  # pause exactly long enough
    ([0.9] * 8 + [0.1] * 2 + [0.9] * 8, [(0, 18 * W)]),  # one frame less
    ([0.9] * 8 + [0.1, 0.4, 0.1] + [0.9] * 8, [(0, 8 * W), (11 * W, 19 * W)]),  # the band does not end a pause
    ([0.9] * 3 + [0.1] * 9, []),  # too short
    ([0.9] * 8 + [0.1] * 2, [(0, 10 * W)]),  # a short pause at the end is kept
    ([0.9], []),
])
def test_chunk_cases(spark, probs, chunks):
    options = SpeechOptions(min_silence_ms=128)
    assert chunks_by_call(speech.speech_chunks(frames_of(spark, [probs]), options), 1) == [chunks]


@pytest.mark.parametrize("silence_ms, longest", [(30, 2.0), (500, 3.0), (500, 1.0), (200, 6.0)])
def test_limited_chunks_do_not_depend_on_stretches(spark, silence_ms, longest):
    """Splitting a call at long pauses changes nothing: each call is also walked in one piece."""
    options = SpeechOptions(min_silence_ms=silence_ms, max_speech_s=longest)
    calls = random_calls(int(longest * 10) + silence_ms, 60)
    found = chunks_by_call(speech.speech_chunks(frames_of(spark, calls), options), len(calls))
    walk = speech._walker(options)
    for probs, got in zip(calls, found):
        whole = pd.DataFrame({"at": range(len(probs)), "prob": probs})
        parts = [p for p in walk((0, 1), iter([whole])) if len(p)]
        expected = []
        for s, e in (r for p in parts for r in zip(p["start"], p["end"])):
            if e is None or pd.isna(e):
                e = len(probs) * W
                if e - s <= options.samples(options.min_speech_ms):
                    continue
            expected.append((s, e))
        assert got == expected


def test_limited_chunks_without_need_equal_unlimited(spark):
    calls = random_calls(99, 40)
    frames = frames_of(spark, calls)
    limited = speech.speech_chunks(frames, SpeechOptions(min_silence_ms=300, max_speech_s=1e6))
    assert rows(limited) == rows(speech.speech_chunks(frames, SpeechOptions(min_silence_ms=300)))


def test_hard_cut_and_cut_at_pause(spark):
    options = SpeechOptions(min_silence_ms=2000, max_speech_s=1.5, pad_ms=0)
    limit = options.max_speech_samples
    n = int(limit // W) + 1
    steady = [0.9] * 60
    paused = [0.9] * 10 + [0.1] * 4 + [0.9] * 46
    found = chunks_by_call(speech.speech_chunks(frames_of(spark, [steady, paused]), options), 2)
    assert found[0][0] == (0, n * W) and found[0][1][0] == (n + 1) * W
    assert found[1][0] == (0, 10 * W) and found[1][1][0] == 14 * W


def pad_through(chunks, length, pad):
    chunks = [list(c) for c in chunks]
    if chunks:
        chunks[0][0] = max(0, chunks[0][0] - pad)
    for a, b in zip(chunks, chunks[1:]):
        gap = b[0] - a[1]
        if gap < 2 * pad:
            a[1], b[0] = a[1] + gap // 2, max(0, b[0] - gap // 2)
        else:
            a[1], b[0] = min(length, a[1] + pad), max(0, b[0] - pad)
    if chunks:
        chunks[-1][1] = min(length, chunks[-1][1] + pad)
    return [tuple(c) for c in chunks]


def test_padding(spark):
    rng = random.Random(4)
    cases = []
    for _ in range(150):
        points = sorted(rng.sample(range(60_000), 2 * rng.randint(1, 6)))
        cases.append(([tuple(points[i:i + 2]) for i in range(0, len(points), 2)], points[-1] + rng.choice([0, 100, 20_000])))
    cases.append(([(100, 200)], 300))
    chunks = spark.createDataFrame([(c, i, s, e) for c, (ch, _) in enumerate(cases) for i, (s, e) in enumerate(ch)],
                                   "call_id long, chunk_no long, start long, end long")
    lengths = spark.createDataFrame([(c, n) for c, (_, n) in enumerate(cases)], "call_id long, samples long")
    found = chunks_by_call(speech.pad_chunks(chunks, lengths), len(cases))
    assert found == [pad_through(ch, n, 6400) for ch, n in cases]


def test_restored_times_keep_their_order(spark):
    chunks = spark.createDataFrame([(1, 0, 16_000, 32_000), (1, 1, 48_000, 64_000), (1, 2, 100_000, 120_000)],
                                   "call_id long, chunk_no long, start long, end long")
    times = [i * 0.05 for i in range(100)]
    segments = spark.createDataFrame([(1, i, t, t + 0.5) for i, t in enumerate(times)],
                                     "call_id long, segment_no long, start double, end double")
    found = [r["start"] for r in speech.restore_times(segments, chunks).orderBy("segment_no").collect()]
    assert found == sorted(found)
    assert found[0] == 1.0 and found[20] == 3.0  # the first chunk ends where the second begins
    assert found[-1] == round(4.25 + times[-1], 2)  # past the end the last chunk counts


def test_word_ends_share_a_chunk(spark):
    chunks = spark.createDataFrame([(1, 0, 0, 16_000), (1, 1, 32_000, 48_000)], "call_id long, chunk_no long, start long, end long")
    spoken = spark.createDataFrame([(1, 0, 0, 0.5, 1.2), (1, 0, 1, 0.9, 1.3)],
                                   "call_id long, segment_no long, word_no long, start double, end double")
    restored = speech.restore_word_times(spoken, chunks)
    assert rows(restored, "word_no", "start", "end") == [(0, 0.5, 1.2), (1, 1.9, 2.3)]
    assert rows(speech.segments_from_words(restored)) == [(1, 0, 0.5, 2.3)]


def test_calls_without_speech_stay_in_the_statistics(spark):
    chunks = spark.createDataFrame([(1, 0, 0, 16_000)], "call_id long, chunk_no long, start long, end long")
    lengths = spark.createDataFrame([(1, 48_000), (2, 32_000)], "call_id long, samples long")
    assert rows(speech.speech_stats(chunks, lengths)) == [(1, 3.0, 1.0, 2.0), (2, 2.0, 0.0, 2.0)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 5000, allow_nan=False), min_size=200, max_size=400))
def test_rounding_is_exact(spark, values):
    values += [n / 200 for n in range(1, 400)] + [1.005, 2.675, 1.035, 2.365, 0.125, 0.375, 1e-9]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    found = df.select("x", round2(F.col("x"))).collect()
    assert all(r[1] == round(r[0], 2) for r in found)
