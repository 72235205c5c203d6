"""Plan-shape guards: the properties the design relies on at scale."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
                          plan))


@pytest.mark.parametrize("name", ["bucket_activity", "bucket_price", "weekday_counts", "top_sellers"])
def test_reports_push_filter_and_prune_columns(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "EqualTo(event_type,purchase)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema.count(":") == 2
    assert _shuffles(plan) == 1


def test_all_reports_one_scan_one_shuffle(spark):
    plan = _plan(E.queries()["all_reports"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1
    assert _shuffles(plan) == 1
    assert "Expand" in plan


def test_top_sellers_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(E.queries()["top_sellers"](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["lenient_cast", "reject_split", "decode_json", "encode_decode"])
def test_row_wise_queries_do_not_shuffle(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert _shuffles(plan) == 0
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_metrics_are_one_global_aggregation(spark):
    plan = _plan(E.queries()["reg_metrics_multi"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1
    assert _shuffles(plan) == 1


def test_no_python_udfs_anywhere(spark):
    for name in ["all_reports", "clean_distinct", "clf_metrics", "class_recall", "landed_csv"]:
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_classification_metrics_two_shuffles_no_join(spark):
    plan = _plan(E.queries()["clf_metrics"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1
    assert _shuffles(plan) == 2
    assert "Join" not in plan


def test_document_features_move_no_text(spark):
    from lotcast.plans.catalogue import _labelled_documents
    plan = _plan(_labelled_documents(spark, SF_SMALL))
    for line in plan.splitlines():
        if re.search(r"Exchange (?!SinglePartition)|RoundRobin", line):
            assert "text" not in line
    # labelled ids meet the documents before their text is measured
    assert "LeftSemi" in plan


@pytest.mark.parametrize("name", ["score_all", "price_linear_scores"])
def test_scoring_does_not_shuffle(spark, name):
    assert _shuffles(_plan(E.queries()[name](spark, SF_SMALL))) == 0
