"""Punctuation is merged in little memory, and long texts are merged as short ones are."""

import os
import random
import subprocess
import sys

import pytest
from conftest import ROOT, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog import timing
from parley.operators import words
from parley.session import spread_by, tune

SMALL_HEAP = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from parley.operators import words
from parley.session import tune
conf = {"spark.driver.memory": "600m", "spark.buffer.pageSize": "32m", "spark.sql.shuffle.partitions": "1", "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1", "spark.local.dir": sys.argv[2]}
spark = tune(SparkSession.builder.master("local[1]").config(map=conf).getOrCreate())
n = F.col("id")
spoken = spark.range(1_500_000).select(
    F.floor(n / 6000).alias("call_id"), (n % 6000).alias("word_no"),
    F.when(n % 5 == 4, ".").otherwise(F.concat(F.lit(" w"), (n % 1000).cast("string"))).alias("word"),
    (n * 0.5).alias("start"), (n * 0.5 + 0.5).alias("end"))
words.merge_punctuation(spoken, ["call_id"], hot=False).write.parquet(sys.argv[2] + "/merged")
print("rows", spark.read.parquet(sys.argv[2] + "/merged").count())
spark.stop()
"""


def test_a_task_of_many_long_calls_needs_little_memory(tmp_path):
    """Before, a sort took the memory of the windows before it in the same task: windows buffer calls of over 4,096 words."""
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY")}
    done = subprocess.run([sys.executable, "-c", SMALL_HEAP, ROOT, str(tmp_path)], capture_output=True, text=True, timeout=300, env=env)
    assert "rows 1200000" in done.stdout, done.stderr[-2000:]


def documents(spark, path, texts):
    """Some ids come twice, one is null; of texts with one id, all but one are empty, so that their words have one order."""
    data = [(i, t, "en") for i, t in enumerate(texts)] + [(0, "", "en"), (1, None, "en"), (None, 'A null "id", too.', "en")]
    spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{path}/documents.parquet")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_dealt_out_instead_of_their_pieces(spark, tmp_path):
    documents(spark, tmp_path, ['He said "yes".'])
    plan = plan_of(entry.queries()["merge_punctuation"](spark, str(tmp_path)))
    above, below = plan.split("Exchange hashpartitioning")
    assert "Generate posexplode" in above and "Generate" not in below and "Exchange" not in below


def test_no_sort_waits_for_windows(spark):
    spoken = spark.createDataFrame([(1, 0, " a", 0.0), (1, 1, ".", 1.0)], "call_id int, word_no int, word string, start double")
    plan = plan_of(words.merge_punctuation(spoken, ["call_id"], hot=False))
    above, _, below = plan.partition("Window [")
    assert "Sort [" not in above and "Window [" not in below and plan.count("Sort [") == 1 and "SortAggregate" in above


def test_long_texts_are_merged_as_short_ones(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    parts = ["word", " and", " (", " \"", ")", ".", ",", "!?", " ¿", "。", "  ", "\n", " x1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 40, 90]))) for _ in range(40)]
    documents(spark, tmp_path, texts)
    query, found = entry.queries()["merge_punctuation"], []
    for most in (timing.MAX_TEXT_BYTES, 200, 0):
        monkeypatch.setattr(timing, "MAX_TEXT_BYTES", most)
        found.append(rows(query(spark, str(tmp_path))))
    assert found[0] and found[0] == found[1] == found[2]
    assert sum(r[0] is None for r in found[0]) == 4


def test_a_long_call_is_not_folded_in_one_row(spark, monkeypatch):
    spoken = spark.range(60).select((F.col("id") % 2).alias("call_id"), F.col("id").alias("word_no"), F.when(F.col("id") % 3 == 0, ".").otherwise(" a").alias("word"))
    found = []
    for most in (30, 29):
        monkeypatch.setattr(words, "MAX_FOLDED_ROWS", most)
        merged = words.merge_punctuation(spoken, ["call_id"])
        found.append(rows(merged, *sorted(merged.columns)))
        assert ("_line" in merged._jdf.queryExecution().optimizedPlan().toString()) == (most == 30)
    assert found[0] == found[1]


@pytest.mark.parametrize("extra", ["map('k', word_no)", "array(struct(word_no AS n))"])
def test_columns_that_have_no_order_are_kept(spark, extra):
    spoken = spark.createDataFrame([(1, 0, ' "'), (1, 1, "yes"), (1, 2, "."), (1, 3, " no")], "call_id int, word_no int, word string")
    spoken = spoken.withColumn("extra", F.expr(extra))
    given = {r["word_no"]: r["extra"] for r in spoken.collect()}
    merged = words.merge_punctuation(spoken, ["call_id"]).orderBy("word_no").collect()
    assert [(r["word_no"], r["word"], r["extra"]) for r in merged] == [(1, ' "yes.', given[1]), (3, " no", given[3])]


def test_rows_of_a_key_are_dealt_out_together(spark):
    tune(spark)
    keyed = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    dealt = spread_by(keyed, ["k"], 16_001, part_bytes=1000)
    assert dealt.rdd.getNumPartitions() == 17 and spread_by(keyed, ["k"], 16_001).rdd.getNumPartitions() == 8
    assert dealt.select("k", F.spark_partition_id().alias("p")).distinct().count() == 7
