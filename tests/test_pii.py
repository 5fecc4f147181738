"""Golden rows for personal data; all names, numbers and addresses are invented."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parley.functions import pii
from parley.operators.gazetteer import tag_gazetteer

CASES = [
    ("nothing here", "nothing here"),
    ("", ""),
    ("call 555-555-0142 now", "call <PHONE_NUMBER> now"),
    ("call (555) 555 0142", "call <PHONE_NUMBER>"),
    ("mail Jo.Doe+x@Example.com, ok", "mail <EMAIL_ADDRESS>, ok"),
    ("account 123456789012.", "account <ACCOUNT_NUMBER>."),
    ("on 03/04/2021 and 2021-04-03", "on <DATE> and <DATE>"),
    ("on march 3, 2021", "on <DATE>"),
    ("ssn 078-05-1120 or 1120", "ssn <US_SSN> or <US_SSN>"),
    ("paid $1,250.00 and $ 5", "paid <DOLLAR_AMOUNT> and <DOLLAR_AMOUNT>"),
    ("a bill of $75.20", "a <BILL_AMOUNT>"),
    ("PAYMENT OF $9", "<BILL_AMOUNT>"),
    ("confirmation number is AB12, 77, X9!", "<CONFIRMATION_NUMBER>!"),
    ("see https://example.com/a?b=1 there", "see <URL> there"),
    ("Mr. Doe, Mrs. Ray and miss Ray dismiss", "<TITLE> Doe, <TITLE> Ray and <TITLE> Ray dismiss"),
    ("at 42 Elm Street, Springfield, IL 62704 today", "at <ADDRESS> today"),
    ("déjà vu ñandú 4321 é", "déjà vu ñandú <US_SSN> é"),
    ("é4321 is a word", "é4321 is a word"),
    ("4321", "<US_SSN>"),
    ("4321 4321", "<US_SSN> <US_SSN>"),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, text string")


def test_both_ways_mask_the_cases(cases):
    fast = rows(cases.select("id", pii.redact_entities(F.col("text")).alias("r")))
    exact = rows(pii.redact_spans(cases).select("id", "redacted"))
    expected = sorted(((i, r) for i, (_, r) in enumerate(CASES)), key=repr)
    assert fast == expected
    assert exact == expected


def test_offsets_equal_a_search(spark):
    texts = [" ".join(t for t, _ in CASES), "ü" * 10 + " 4321 " + "𝒳 4321 " * 200, *[t for t, _ in CASES]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    found = {r["id"]: r["spans"] for r in pii.pii_spans(df).collect()}
    for i, text in enumerate(texts):
        expected = [(p.entity, m.start(), m.end(), p.score) for p in pii.PATTERNS
                    for m in re.finditer(p.regex, text, re.I | re.S | re.M)]
        assert [tuple(s) for s in found[i]] == expected


def test_null_text_stays_null(spark):
    df = spark.createDataFrame([(None,)], "text string")
    assert pii.redact_spans(df).first()["redacted"] is None
    assert df.select(pii.redact_entities(F.col("text"))).first()[0] is None


@pytest.mark.parametrize("spans, resolved", [
    ([], []),
    ([("A", 0, 5, .5)], [("A", 0, 5, .5)]),
    ([("A", 2, 4, .9), ("B", 0, 5, .1)], [("B", 0, 5, .1)]),  # inside another
    ([("B", 0, 5, .5), ("A", 0, 5, .5)], [("A", 0, 5, .5)]),  # equal: first name
    ([("A", 0, 5, .5), ("B", 0, 5, .6)], [("B", 0, 5, .6)]),  # equal: higher score
    ([("A", 0, 5, .5), ("A", 3, 8, .7)], [("A", 0, 8, .7)]),  # one entity merges
    ([("A", 0, 5, .5), ("A", 3, 8, .7), ("A", 7, 9, .1)], [("A", 0, 9, .7)]),
    ([("A", 0, 5, .5), ("B", 3, 8, .7)], [("A", 0, 3, .5), ("B", 3, 8, .7)]),  # clipped
    ([("A", 0, 5, .5), ("A", 5, 8, .5)], [("A", 0, 5, .5), ("A", 5, 8, .5)]),  # touching
    ([("A", 0, 5, .5), ("B", 3, 8, .5), ("A", 7, 9, .5)], [("A", 0, 3, .5), ("B", 3, 7, .5), ("A", 7, 9, .5)]),
])
def test_overlaps(spark, spans, resolved):
    df = spark.createDataFrame([(spans,)], f"spans array<{pii.SPAN}>")
    assert [tuple(s) for s in df.select(pii.resolve_spans(F.col("spans"))).first()[0]] == resolved


def test_many_spans_cross_scan_blocks(spark):
    text = " ".join(f"{n:04d}" for n in range(1000))
    df = spark.createDataFrame([(text,)], "text string")
    assert pii.redact_spans(df).first()["redacted"] == " ".join(["<US_SSN>"] * 1000)


def test_masked_text_stays_masked(cases):
    once = cases.select("id", pii.redact_entities(F.col("text")).alias("text"))
    again = once.select("id", pii.redact_entities(F.col("text")).alias("text"))
    assert rows(once) == rows(again)


@pytest.mark.parametrize("text, masked", [
    ("a-b c_d e.f", "*** *** ***"),  # word characters include the underscore, so `c_d` is one sequence
    ("12 x 345", "[REDACTED] x [REDACTED]"),
    ("id 123456789012abc", "id XXXX56789012abc"),
    ("plain words", "plain words"),
])
def test_sequences(spark, text, masked):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(pii.redact_sequences(F.col("t"))).first()[0] == masked


def test_terms(spark):
    df = spark.createDataFrame([("Ann saw a+b and Anna, Ann.", ["Ann", "a+b", "zz"])], "t string, w array<string>")
    assert df.select(pii.mask_terms(F.col("t"), F.col("w"))).first()[0] == "*** saw *** and Anna, ***."


def test_names(spark):
    df = spark.createDataFrame([(1, "Ann met ANN in Ulm")], "id int, text string")
    names = spark.createDataFrame([("ann", "PERSON"), ("ulm", "LOCATION")], "word string, entity string")
    assert rows(tag_gazetteer(df, names)) == sorted(
        [(1, "PERSON", "ann", 0, 3), (1, "PERSON", "ann", 8, 11), (1, "LOCATION", "ulm", 15, 18)], key=repr)
