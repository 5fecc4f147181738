"""The call pipeline and the store of its stages."""

import pytest
from pyspark.sql import functions as F

from parley.operators.lookup import same_keys
from parley.plans.calls import process_calls
from parley.plans.stages import StageStore, content_digests, table_digest
from parley.session import cut

SEGMENTS = [(1, 0, "Anna Lee called. It was great. "), (1, 1, "My mail is jo@example.com. Bad. "), (2, 0, "nothing"), (3, 0, None), (None, 0, "Lost in Ulm. "), (None, 1, "Good good. ")]
VECTORS = [(1, 0, [1.0, 0.0]), (1, 1, [0.6, 0.8]), (None, 0, [0.0, 1.0]), (2, 0, [-1.0, 0.0]), (77, 0, [1.0, 0.0])]
NAMES = [("Anna Lee", "PERSON"), ("ulm", "LOCATION"), (None, "PERSON")]


@pytest.fixture
def parts(spark):
    return [spark.createDataFrame(SEGMENTS, "call_id long, segment_no long, text string"),
            spark.createDataFrame(VECTORS, "call_id long, pos long, vector array<double>"),
            spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "topic string, vector array<double>"),
            spark.createDataFrame(NAMES, "name string, entity string")]


def by_call(df):
    rows = df.collect()
    assert len({r["call_id"] for r in rows}) == len(rows)
    return {r["call_id"]: r for r in rows}


def test_call_table(parts, tmp_path):
    found = by_call(process_calls(*parts, str(tmp_path / "calls")))
    assert set(found) == {1, 2, 3, None}
    assert found[1]["transcription"] == found[1]["summary"] and found[1]["transcription"].startswith("<PERSON> called. It was great. ")
    assert "Anna" not in str(found[1]) and "jo@example.com" not in str(found[1])
    assert "<LOCATION>" in found[None]["transcription"] and "Ulm" not in str(found[None])
    assert [s["segment_no"] for s in found[1]["segments"]] == [0, 1]
    assert (found[1]["primary_topic"], found[1]["secondary_topic"], found[1]["topics"]) == ("a", "b", ["a", "b", "a"])
    chances = found[1]["topic_with_probabilities"]
    assert [c["topic"] for c in chances] == ["a", "b"] and sum(c["probability"] for c in chances) == pytest.approx(1)
    assert found[None]["primary_topic"] == "b"
    for call in (2, 3):
        assert (found[call]["primary_topic"], found[call]["topics"], found[call]["topic_with_probabilities"]) == ("Unidentified", ["UNIDENTIFIED"], [])
    assert found[3]["summary"] == "Summary not generated for this transcription"


def test_empty_tables(parts, tmp_path):
    assert process_calls(*(p.limit(0) for p in parts), str(tmp_path / "calls")).collect() == []


def test_only_new_and_changed_calls_are_worked_on(spark, parts, tmp_path):
    segments = parts[0]
    store, tried = StageStore(spark, str(tmp_path / "kept")), []

    def sizes(rows):
        def compute(some):
            tried.append({r["call_id"] for r in some.collect()})
            return same_keys(rows.where("text is not null"), some, ["call_id"], "left_semi").groupBy("call_id").agg(F.count("*").alias("n"))
        return {r["call_id"]: r["n"] for r in store.run("sizes", cut(content_digests(rows, "call_id", ["segment_no", "text"])), compute, "v1").collect()}

    assert sizes(segments) == {1: 2, 2: 1, None: 2} and tried.pop() == {1, 2, 3, None}
    assert sizes(segments.orderBy(F.desc("segment_no"))) == {1: 2, 2: 1, None: 2} and not tried  # call 3 has no rows and is not tried again
    more = segments.unionByName(spark.createDataFrame([(2, 1, "more"), (4, 0, "new")], segments.schema))
    assert sizes(more) == {1: 2, 2: 2, 4: 1, None: 2} and tried.pop() == {2, 4}
    assert sizes(segments.where("call_id = 2")) == {2: 1} and not tried  # the earlier content is still there


def test_a_broken_run_doubles_nothing(spark, parts, tmp_path):
    digests = cut(content_digests(parts[0], "call_id", ["text"]))
    store = StageStore(spark, str(tmp_path / "kept"))
    stage = lambda some: some.withColumn("x", F.lit(1))
    first = store.run("s", digests, stage)
    folder = next((tmp_path / "kept").iterdir())
    stray = spark.read.parquet(str(folder / "rows")).withColumn("run", F.lit("0"))  # rows whose run was never marked as finished
    stray.write.mode("append").parquet(str(folder / "rows"))
    assert first.count() == store.run("s", digests, stage).count() == 4
    spark.read.parquet(str(folder / "finished")).withColumn("run", F.lit("0")).write.mode("append").parquet(str(folder / "finished"))
    assert store.run("s", digests, stage).count() == 4  # two runs at the same time


def test_digests_tell_content_apart(spark, parts):
    rows = parts[0]
    assert table_digest(rows, ["text"]) == table_digest(rows.repartition(5), ["text"])
    assert table_digest(rows, ["text"]) != table_digest(rows.unionByName(rows), ["text"])
    assert table_digest(rows, ["text"]) != table_digest(rows.fillna("", ["text"]), ["text"])
