"""Golden rows for text functions, filters, chunks and edits."""

import random
import zlib

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parley.functions import arrays, text, vectors
from parley.functions.audio import channel, pcm_to_float
from parley.operators import edits, filters, segments, summary


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x"))).first()[0]


@pytest.mark.parametrize("value, parts", [
    ("", [""]), ("One. Two! Three", ["One", "Two", "Three"]), ("End. ", ["End", ""]), ("a.\nb", ["a.\nb"]),
    ("Wie? Süß.", ["Wie", "Süß."]), ("eh!? ok", ["eh!", "ok"]),
])
def test_sentences(spark, value, parts):
    assert one(spark, value, text.sentences) == parts


def test_short_pieces_are_dropped(spark):
    assert one(spark, "a b c d e. one two.  x\ny z v w ", lambda c: text.period_chunks(c, 5)) == ["a b c d e", "  x\ny z v w "]
    assert one(spark, "", lambda c: text.period_chunks(c, 1)) == []


def test_clean_summary_keeps_letters_of_all_languages(spark):
    assert one(spark, "Él dijo: ¡«sí»! 3.5 % _x_ ٣", text.clean_summary) == "Él dijo sí 3.5  _x_ ٣"


@pytest.mark.parametrize("seconds, stamp", [
    (0.0, "00:00.000"), (59.9996, "01:00.000"), (0.0005, "00:00.000"), (0.0015, "00:00.002"), (3725.5, "01:02:05.500"),
    (360000.0, "100:00:00.000"),
])
def test_timestamps(spark, seconds, stamp):
    assert one(spark, seconds, text.format_timestamp, "double") == stamp


def test_timestamp_forms(spark):
    assert one(spark, 61.25, lambda c: text.format_timestamp(c, always_hours=True, marker=","), "double") == "00:01:01,250"
    with pytest.raises(PySparkException):
        one(spark, -1.0, text.format_timestamp, "double")


@pytest.mark.parametrize("value", ["", "abc", "spam " * 500, "é" * 77])
def test_compression_ratio(spark, value):
    data = value.encode()
    assert one(spark, value, text.compression_ratio) == len(data) / len(zlib.compress(data))
    assert one(spark, value, text.is_repetitive) == (len(data) / len(zlib.compress(data)) > 2.4)


def test_map_sentences_puts_a_blank_after_each(spark):
    assert one(spark, "the the cat , sat. It It is", lambda c: text.map_sentences(c, text.tidy_sentence)) == "the cat, sat It is "
    assert one(spark, "", lambda c: text.map_sentences(c, F.upper)) == " "


def test_running_sums_of_long_arrays(spark):
    rng = random.Random(2)
    for n in (0, 1, 63, 64, 65, 128, 4097):
        values = [rng.randint(-5, 9) for _ in range(n)]
        total, sums, best, tops = 0, [], None, []
        for v in values:
            total += v
            best = v if best is None else max(best, v)
            sums.append(total)
            tops.append(best)
        assert one(spark, values, arrays.running_sums, "array<int>") == sums
        assert one(spark, values, arrays.running_max, "array<int>") == tops


def test_cosine_of_zero_vector_is_null(spark):
    assert one(spark, [3.0, 4.0], lambda c: vectors.cosine(c, c), "array<float>") == pytest.approx(1.0)
    assert one(spark, [0.0, 0.0], lambda c: vectors.cosine(c, c), "array<float>") is None


def test_pcm(spark):
    assert one(spark, [0, 16384, -32768, 1], pcm_to_float, "array<smallint>") == [0.0, 0.5, -1.0, pytest.approx(1 / 32768)]
    assert one(spark, [1, 2, 3, 4], lambda c: channel(c, 1), "array<smallint>") == [2, 4]


@pytest.mark.parametrize("n, chunks", [(0, []), (999, [999]), (1000, [1000]), (1001, [1000, 1])])
def test_token_chunks(spark, n, chunks):
    df = spark.createDataFrame([(1, " ".join(["w"] * n))], "id int, text string")
    assert [len(r["chunk"].split()) for r in segments.fixed_token_chunks(df).orderBy("chunk_no").collect()] == chunks


def test_packing_keeps_every_sentence(spark):
    df = spark.createDataFrame([(1, "a b. c d. " + "x " * 12 + ". e")], "id int, text string")
    found = [r["chunk"] for r in segments.pack_sentences(df, 5).orderBy("chunk_no").collect()]
    assert found == ["a b\nc d", "x " * 11 + "x ", "e"]


def test_duration_text_and_numbers(spark):
    df = spark.createDataFrame([("60",), ("61",), ("x",), (None,), ("600",)], "duration string")
    assert rows(filters.filter_min_duration(df)) == [("600",), ("61",)]


def test_dates_are_bounded_at_midnight(spark):
    days = ["2024-01-04 23:59:59", "2024-01-05 00:00:00", "2024-01-06 00:00:00", "2024-01-06 00:00:01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_timestamp("d").alias("date_created"))
    assert filters.filter_date_range(df, "2024-01-05T09:00", "2024-01-06T09:00").count() == 2


def test_silence_thresholds(spark):
    df = spark.createDataFrame([(0.7, -2.0), (0.7, -0.5), (0.6, -2.0), (0.7, -1.0)], "no_speech_prob double, avg_logprob double")
    assert rows(filters.drop_silence(df)) == [(0.6, -2.0), (0.7, -0.5)]
    assert rows(filters.drop_silence(df, logprob=None)) == [(0.6, -2.0)]
    assert filters.drop_silence(df, no_speech=None).count() == 4


def test_first_copy_stays(spark):
    data = [(3, "x"), (1, "x"), (2, None), (5, None), (4, "X"), (6, "")]
    df = spark.createDataFrame(data, "id int, text string")
    assert sorted(r["id"] for r in filters.dedupe_keep_first(df, "text", "id").collect()) == [1, 2, 4, 6]


def test_languages(spark):
    df = spark.createDataFrame([("en",), ("xx",), (None,), ("yue",)], "lang string")
    known, rest = filters.validate_language(df)
    assert rows(known) == [("en",), ("yue",)] and rest.count() == 2
    assert len(set(filters.LANGUAGE_CODES)) == 100
    assert df.select(filters.effective_language(F.col("lang"), multilingual=False)).distinct().collect()[0][0] == "en"


def test_turns(spark):
    df = spark.createDataFrame([(1, 5, " hi \n"), (1, 2, "yo"), (1, 9, "")], "call_id int, segment_no long, text string")
    assert segments.render_turns(df).first()[1] == 'Speaker 1: "yo"\nSpeaker 2: "hi"\nSpeaker 1: ""\n'


def test_frames(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0, 5.0])], "id int, samples array<float>")
    plain = [r["frame"] for r in segments.frame_signal(df, 2).orderBy("frame_no").collect()]
    assert plain == [[1, 2], [3, 4], [5, 0]]
    centred = [r["frame"] for r in segments.frame_signal(df, 4, 2, reflect=True).orderBy("frame_no").collect()]
    assert centred == [[3, 2, 1, 2], [1, 2, 3, 4], [3, 4, 5, 4]]


def test_edits(spark):
    df = spark.createDataFrame([(1, "the the cat. Fine so"), (1, "a ,b")], "call_id int, text string")
    assert rows(edits.edit_audit(df)) == [(1, 3, 2, 5, 2, 1)]  # the second `the` is no new word; `a ,b` becomes `a,b`


def summarise(value, max_tokens=150):
    """The same summary by plain counting."""
    parts = value.replace("! ", ". ").replace("? ", ". ").split(". ")
    tokens = [p.lower().split() for p in parts]
    if sum(map(len, tokens)) <= 30:
        return value if value.strip() else "Summary not generated for this transcription"
    counts = {}
    for t in (t for ts in tokens for t in ts):
        counts[t] = counts.get(t, 0) + 1
    ranked = sorted((-sum(counts[t] for t in ts) / len(ts), i) for i, ts in enumerate(tokens) if ts)
    kept, used = [], 0
    for n, (_, i) in enumerate(ranked):
        used += len(tokens[i])
        if n and used > max_tokens:
            break
        kept.append(i)
    return " ".join(parts[i] for i in sorted(kept))


def test_summary_equals_counting(spark):
    rng = random.Random(8)
    texts = ["", "  ", "short one. here", "w " * 200]
    for _ in range(40):
        texts.append("".join(" ".join(rng.choice("abcdefghij") * rng.randint(1, 2) for _ in range(rng.randint(0, 12)))
                             + rng.choice([". ", "! ", "? ", "\n"]) for _ in range(rng.randint(1, 30))))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    assert dict(rows(summary.extractive_summary(df, ["id"]))) == {i: summarise(t) for i, t in enumerate(texts)}
    assert dict(rows(summary.extractive_summary(df, ["id"], max_tokens=20))) == {i: summarise(t, 20) for i, t in enumerate(texts)}
