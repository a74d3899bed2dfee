"""What the plans must look like, whatever the size of the data."""

import re

import pytest

import __spark_entry__ as contract
from checks.queries import QUERIES as OWN

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in contract.queries().items() if name in OWN}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("infer_")])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search("EvalPython|InPandas|CartesianProduct", text)
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["recent_items", "top_problems", "top_theme", "top_locations",
                                  "wall", "bronze_preview"])
def test_top_k_keeps_k_rows_per_task(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


def test_rank_per_kind_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["top_entities"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["sentiment_mix", "hourly_running_utc", "resonance_by_theme"])
def test_counting_queries_do_not_read_texts(spark, name):
    for columns in re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, SF_DIR))):
        assert "text" not in columns


def test_filters_reach_the_scan_of_a_stored_gold_table(spark, tmp_path):
    from datetime import date

    from feedlens.plans import metrics
    from feedlens.sources.store import FeedStore

    gold = FeedStore(spark, str(tmp_path)).create().gold()
    day = plan(metrics.total_items(metrics.on_event_day(gold, 2, date(2024, 1, 1))))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(created_at,2024-01-02", day)
    assert "ReadSchema: struct<created_at:timestamp>" in day
    assert re.search(r"PushedFilters: \[[^\]]*action_bucket", plan(metrics.bucket_counts(gold)))
    assert re.search(r"PushedFilters: \[Or\(", plan(metrics.top_problems(gold)))


@pytest.mark.parametrize("name", ["dedup_rows", "thread_rollup", "quality_check", "top_theme",
                                  "payload_items"])
def test_groups_are_folded_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "partial_" in text


@pytest.mark.parametrize("name", ["thread_rollup", "quality_check"])
def test_threads_and_quality_take_one_grouping_and_no_join_of_items(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "SortMergeJoin" not in text
