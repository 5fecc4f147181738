"""What the plans must look like at scale."""

import pytest

import __spark_entry__ as entry
from parley.session import shared_dir, spread

SF_DIR = "/root/testdata/sf0.001"
PYTHON = ("legacy_segments score_batches score_groups score_files flag_repetitive speech_chunks_limited match_topics top_topics "
          "topic_list centroid_assign primary_secondary softmax_scores join_stages call_report").split()
NO_SHUFFLE = ("split_sentences split_periods filter_min_duration project_segment drop_silence sentence_sentiment "
              "segment_sentiment_mode render_prompts parse_satisfaction format_timestamp load_taxonomy").split()


def plan_of(spark, name):
    return {k: q for k, q in entry.queries().items() if k not in entry.LLM_QUERIES}[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set({k: q for k, q in entry.queries().items() if k not in entry.LLM_QUERIES}) - set(PYTHON) - {"table_feather"}))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_row_work_is_not_shuffled(spark, name):
    assert "Exchange" not in plan_of(spark, name)


@pytest.mark.parametrize("name, pushed", [
    ("filter_date_range", "GreaterThanOrEqual(ts"), ("speech_chunks", "ReadSchema: struct<event_id:bigint,ts:timestamp"),
])
def test_scans_are_pruned(spark, name, pushed):
    df = {k: q for k, q in entry.queries().items() if k not in entry.LLM_QUERIES}[name](spark, SF_DIR)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert pushed in plan and "props" not in plan


@pytest.mark.parametrize("name", ["dedupe_keep_first", "top_topics", "primary_secondary"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    assert plan_of(spark, name).count("WindowGroupLimit") >= 2


def test_one_shuffle_feeds_all_windows_of_a_call(spark):
    plan = plan_of(spark, "speech_chunks").split("Join")[0]
    assert plan.count("Window [") >= 1
    assert plan_of(spark, "cumulative_silence").count("Exchange hashpartitioning") <= 3


def test_many_files_are_not_dealt_out(spark, tmp_path):
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    spark.range(100).coalesce(1).write.parquet(few)
    spark.range(100).repartition(16).write.parquet(many)
    assert "Exchange" in spread(spark.read.parquet(few))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in spread(spark.read.parquet(many))._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_is_the_cluster_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("name", ["extractive_summary", "summary_by_chunk"])
def test_summaries_are_row_work(spark, name):
    plan = plan_of(spark, name)
    assert plan.count("FileScan") == 1 and "hashpartitioning" not in plan and "Sort " not in plan


def test_punctuation_is_folded_in_one_pass(spark):
    plan = plan_of(spark, "merge_punctuation")
    assert plan.count("Exchange hashpartitioning") <= 1 and plan.count("Sort ") <= 2 and plan.count("FileScan") == 1


@pytest.mark.parametrize("name", ["pii_spans", "trim_long_words", "merge_punctuation", "redact_names"])
def test_row_work_is_not_repeated_before_it_is_dealt_out(spark, name):
    """No inferred filter on an exploded array repeats the expressions and searches below the exchange."""
    below = [line for line in plan_of(spark, name).split("\n") if "Filter" in line]
    assert not any("regexp_extract_all" in line for line in below)


def test_punctuation_is_sorted_once_for_its_aggregate(spark):
    plan = plan_of(spark, "merge_punctuation")
    assert "ObjectHashAggregate" not in plan and plan.count("SortAggregate") == 1
