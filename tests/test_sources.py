"""Files in and out."""

import json
import os
import wave

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyarrow import feather
from pyspark.sql import functions as F

from parley.operators import scoring
from parley.sources import files, manifests, run_log, tables
from parley.streaming.manifests import stream_manifest

SCHEMA = "id long, text string, x double, parts array<string>"


@pytest.fixture(scope="module")
def table(spark):
    data = [(i, f'line {i}\nsaid "hi", ok', i / 3, ["a", str(i)]) for i in range(1000)] + [(1000, None, None, None)]
    return spark.createDataFrame(data, SCHEMA).repartition(4)


@pytest.mark.parametrize("format", ["feather", "csv", "parquet", "anything"])
def test_round_trip(spark, table, tmp_path, format):
    df = table.drop("parts") if format == "csv" else table
    path = str(tmp_path / "t")
    tables.write_table(df, path, format)
    back = tables.read_table(spark, path, format, df.schema if format == "csv" else None)
    assert rows(back, *df.columns) == rows(df)


def test_feather_overwrite_append_and_foreign_files(spark, table, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.write_table(table, path)
    assert tables.read_table(spark, path).count() == 1001
    tables.write_table(table, path, mode="append")
    assert tables.read_table(spark, path).count() == 2002
    assert not os.path.exists(f"{path}/_staging")
    single = str(tmp_path / "one.feather")
    feather.write_feather(pd.DataFrame({"a": range(10_000)}), single, chunksize=100)
    found = tables.read_table(spark, single)
    assert found.rdd.getNumPartitions() == 2
    assert found.agg(F.sum("a")).first()[0] == sum(range(10_000))


def page(numbers):
    return {"recordings": [{"sid": f"RE{n}", "call_sid": f"CA{n}", "duration": str(n), "date_created": "2024-01-05T10:00:00Z",
                            "media_url": f"https://example.com/{n}"} for n in numbers]}


def test_manifest_pages(spark, tmp_path):
    for i, numbers in enumerate(([1, 2], [3], [])):
        (tmp_path / f"{i}.json").write_text(json.dumps(page(numbers), indent=1))
    found = manifests.read_manifest(spark, str(tmp_path))
    assert sorted(r["sid"] for r in found.collect()) == ["RE1", "RE2", "RE3"]
    assert found.schema["date_created"].dataType.typeName() == "timestamp"


def test_manifest_as_it_lands(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text(json.dumps(page([1, 2])))
    stream = stream_manifest(spark, str(source)).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
    stream.start(str(tmp_path / "out")).awaitTermination(60)
    (source / "2.json").write_text(json.dumps(page([3])))
    stream.start(str(tmp_path / "out")).awaitTermination(60)
    assert sorted(r["sid"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["RE1", "RE2", "RE3"]


def test_taxonomy(spark):
    df = spark.createDataFrame([('{"Bills": ["high bill", "late fee"], "Empty": []}',), ("no json",)], "taxonomy string")
    assert rows(manifests.load_taxonomy(df)) == [("Bills", 0, "high bill"), ("Bills", 1, "late fee")]


def test_legacy_segments(spark):
    texts = ["[{'start': 0.0, 'end': 1.5, 'text': \"it's\", 'no_speech_probability': 0.25}]",
             "[{'start': 1, 'end': 2.0, 'text': 'say \"x\"', 'sentiment': 'neutral'}, {}]", "[{'start': ", "7", "[]", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, segmented_transcription string")
    found = {r["id"]: r["s"] for r in df.select("id", manifests.legacy_segments().alias("s")).collect()}
    assert found[0][0]["text"] == "it's" and found[0][0]["no_speech_probability"] == 0.25
    assert found[1][0]["sentiment"] == "neutral" and found[1][0]["start"] == 1.0 and found[1][1]["text"] is None
    assert found[2] is None and found[3] is None and found[4] == [] and found[5] is None


def test_audio_and_inventory(spark, tmp_path):
    samples = (np.arange(32) * 100).astype("<i2")
    for name, channels in (("mono.wav", 1), ("stereo.wav", 2)):
        with wave.open(str(tmp_path / name), "wb") as f:
            f.setnchannels(channels)
            f.setsampwidth(2)
            f.setframerate(16_000)
            f.writeframes(samples.tobytes())
    (tmp_path / "broken.wav").write_bytes(b"RIFFnothing")
    (tmp_path / "note.txt").write_text("x" * 10)
    (tmp_path / "empty.txt").write_text("")
    found = {os.path.basename(r["path"]): r for r in files.read_wav(spark, str(tmp_path)).collect()}
    assert set(found) == {"mono.wav", "stereo.wav", "broken.wav"}
    assert found["mono.wav"]["samples"] == samples.tolist() and found["stereo.wav"]["channels"] == 2
    assert found["broken.wav"]["samples"] is None
    inventory = files.file_inventory(spark, str(tmp_path)).first()
    total = sum(os.path.getsize(tmp_path / n) for n in os.listdir(tmp_path))
    assert (inventory["n_files"], inventory["total_bytes"]) == (5, total)
    assert {r["name"] for r in files.list_files(spark, str(tmp_path)).collect()} == set(os.listdir(tmp_path)) - {"empty.txt"}
    plan = files.file_inventory(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_run_log(spark, tmp_path):
    df, observation = run_log.observed(spark.range(10), "stage", F.col("id") > 7)
    df.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 10, "errors": 2}
    for _ in range(2):
        run_log.write_run_log(spark, str(tmp_path / "log"), "stage", observation.get, ["bad row"])
    found = spark.read.parquet(str(tmp_path / "log"))
    assert rows(found, "stage", "level", "message") == [("stage", "ERROR", "bad row")] * 2 + [("stage", "INFO", "errors=2, rows=10")] * 2


def test_model_is_loaded_once_per_task(spark):
    loads = spark.sparkContext.accumulator(0)

    def loader():
        loads.add(1)
        return 10

    df = spark.range(0, 50_000, 1, 3)
    found = scoring.score_batches(df, loader, lambda m, b: b.assign(y=b["id"] * m), "id long, y long")
    assert found.agg(F.sum("y")).first()[0] == 10 * sum(range(50_000))
    assert loads.value == 3


def test_groups_are_read_in_order(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("k"), (30_000 - F.col("id")).alias("n"))

    def gaps(key, batches):
        last = 0
        for batch in batches:
            assert (batch["n"] > last).all() and batch["n"].is_monotonic_increasing
            last = batch["n"].iloc[-1]
            yield pd.DataFrame({"k": [key[0]], "rows": [len(batch)]})

    found = scoring.score_groups(df, ["k"], ["n"], gaps, "k long, rows long")
    assert found.agg(F.sum("rows")).first()[0] == 30_000


def test_files_are_scored(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.bin").write_bytes(b"x" * (i + 1))
    listed = files.list_files(spark, str(tmp_path)).select("path", "length")
    found = scoring.score_files(listed, lambda: None, lambda m, b: b[["length"]], "length long", 3)
    assert sorted(r[0] for r in found.collect()) == [1, 2, 3, 4, 5]


def test_feather_skips_staged_files_and_reads_an_empty_table(spark, tmp_path):
    from parley.sources.feather import FeatherDataSource

    spark.dataSource.register(FeatherDataSource)
    path = str(tmp_path / "table")
    for _ in range(2):
        spark.range(3).coalesce(1).write.format("feather").mode("append").save(path)
    committed = sorted((tmp_path / "table").iterdir())
    assert len(committed) == 2 and all(f.is_file() for f in committed)
    (tmp_path / "table" / "_staging-other").mkdir()
    (tmp_path / "table" / "_staging-other" / committed[0].name).write_bytes(committed[0].read_bytes())
    assert spark.read.format("feather").load(path).count() == 6
    empty = str(tmp_path / "empty")
    spark.range(3).where("id > 5").coalesce(1).write.format("feather").mode("append").save(empty)
    assert spark.read.format("feather").load(empty).collect() == []
