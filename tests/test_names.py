"""Names of several words against a plain search."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parley.operators import lookup, names

LISTED = [("New York", "LOCATION"), ("new york times", "ORGANIZATION"), ("York", "PERSON"), ("a a", "PERSON"), ("a b a b", "LOCATION"), ("Jos\u00e9 \u00c9l", "PERSON"),
          ("b", "PERSON"), ("b", "LOCATION"), (None, "PERSON"), ("..", "PERSON"), ("van der Berg", "PERSON")]


def by_hand(text):
    if text is None:
        return []
    found = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"\w+", text)]
    listed = {}
    for name, entity in LISTED:
        own = tuple(w.lower() for w in re.findall(r"\w+", name or ""))
        if own:
            listed[own] = min(entity, listed.get(own, entity))
    out, upto = [], 0
    for i, (_, start, _) in enumerate(found):
        if start < upto:
            continue
        for n in range(min(4, len(found) - i), 0, -1):
            own = tuple(w for w, _, _ in found[i:i + n])
            if own in listed and all(re.fullmatch(r"\s+", text[found[j][2]:found[j + 1][1]]) for j in range(i, i + n - 1)):
                out.append((listed[own], start, found[i + n - 1][2]))
                upto = out[-1][2]
                break
    return out


@pytest.mark.parametrize("small", [True, False])
def test_leftmost_longest_names(spark, monkeypatch, small):
    monkeypatch.setattr(lookup, "is_small", lambda *a: small)
    rng = random.Random(5)
    texts = [None, "", "New York Times in NEW  YORK, New. York and york", "a a a a a b a b a b", "Jos\u00e9 \u00c9L van der\nBerg; van derBerg", "a " * 5000]
    texts += ["".join(rng.choice(["a ", "b ", "a, ", "New ", "York ", "times ", "x "]) for _ in range(rng.randint(1, 200))) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[2])], "id int, text string").withColumn("word", F.lit("own"))
    listed = spark.createDataFrame(LISTED, "name string, entity string")
    found = names.name_spans(df, listed)
    told = {r.digest: [(s.entity, s.start, s.end) for s in r.spans] for r in df.select(F.sha2("text", 256).alias("digest")).distinct().join(found, "digest").collect()}
    digests = {r.text: r.d for r in df.select("text", F.sha2("text", 256).alias("d")).collect()}
    assert {t: told.get(digests[t], []) for t in texts} == {t: by_hand(t) for t in texts}
    redacted = rows(names.redact_names(df, listed).select("id", "redacted"))
    assert len(redacted) == len(texts) + 1 and (0, None) in redacted
    assert (2, "<ORGANIZATION> in <LOCATION>, New. <PERSON> and <PERSON>") in redacted and (None, "<ORGANIZATION> in <LOCATION>, New. <PERSON> and <PERSON>") in redacted


def test_names_and_patterns_resolve_together(spark):
    df = spark.createDataFrame([(1, "Miss Ann Lee, SSN 078-05-1120, mail ann@x.org")], "id int, text string")
    listed = spark.createDataFrame([("Miss Ann Lee", "PERSON"), ("ann", "PERSON")], "name string, entity string")
    assert names.redact_names(df, listed).first().redacted == "<PERSON>, SSN <US_SSN>, mail <EMAIL_ADDRESS>"
    assert names.redact_names(df, listed.limit(0)).first().redacted == "<TITLE> Ann Lee, SSN <US_SSN>, mail <EMAIL_ADDRESS>"
    assert names.redact_names(df.limit(0), listed).collect() == []


def test_names_that_begin_alike_do_not_multiply(spark, monkeypatch):
    met, plain = [], names.lookup

    def counted(*given, **named):
        out = plain(*given, **named)
        met.append(out.count())
        return out

    monkeypatch.setattr(names, "lookup", counted)
    listed = spark.createDataFrame([(f"the n{i}", "PERSON") for i in range(300)] + [("the a", "PERSON")], "name string, entity string")
    found = names.name_spans(spark.createDataFrame([("the a " * 50,)], "text string"), listed)
    assert max(met) <= 100 and [(s.start, s.end) for s in found.first().spans] == [(6 * i, 6 * i + 5) for i in range(50)]
