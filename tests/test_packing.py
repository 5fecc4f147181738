"""Sentences packed into chunks, against a plain loop."""

import random
import re
import time

from conftest import rows

from parley.operators import segments


def by_hand(text, limit):
    chunks, n = [], 0
    for i, sentence in enumerate(re.split("[.!?] ", text)):
        own = len(sentence.split())
        if i and n + own < limit:
            chunks[-1].append(sentence)
            n += own
        else:
            chunks.append([sentence])
            n = own
    return ["\n".join(c) for c in chunks]


def test_chunks_equal_a_plain_loop(spark):
    rng = random.Random(9)
    texts = ["", "one", "a b c d e f g h. i", ". . . . "] + [". ".join(" ".join("w" * rng.randint(0, 12)) for _ in range(rng.randint(1, 400))) for _ in range(20)]
    df = spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id int, text string")
    for limit in (1, 6, 40):
        found = rows(segments.pack_sentences(df, limit), "doc_id", "chunk_no", "chunk")
        assert found == sorted(((i, k, c) for i, t in enumerate(texts) for k, c in enumerate(by_hand(t, limit))), key=repr)


def test_work_grows_with_the_sentences(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, "some words. " * n)], "doc_id int, text string").cache()
        df.count()
        start = time.perf_counter()
        assert segments.pack_sentences(df, 5).count() == n // 2  # two sentences each; the empty rest joins the last
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(100_000) < 10 + 12 * seconds(10_000)
