"""Physical plans keep their shape: pushdown, pruning, partial top-k, no cross joins."""

import re

import pytest

from tidyspark.operators import ask
from tidyspark.queries import QUERIES
from tidyspark.queries.base import table

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["quality_score", "profile_table", "profile_columns", "profile_top_values", "knowledge_rows", "tfidf_topk",
     "lookup_exact", "run_summary", "feat_encode_ordinal", "validate_report"],
)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython", text)


@pytest.mark.parametrize("name", ["profile_top_values", "tfidf_topk", "knowledge_rows"])
def test_top_k_is_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(QUERIES[name](spark, SMALL)))


@pytest.mark.parametrize("name", ["extreme_rows_max", "head_rows", "tail_rows", "group_total_top5", "preview_rows"])
def test_limits_are_per_task(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SMALL))


def test_documents_are_shuffled_once(spark):
    text = plan(QUERIES["tfidf_weights"](spark, SMALL))
    assert len(re.findall("Exchange hashpartitioning", text)) == 1


def test_scans_read_only_their_columns(spark):
    totals = ask.group_total(table(spark, SMALL, "orders"), "o_orderpriority", "o_totalprice")
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in plan(totals)


def test_cleaning_is_a_projection(spark):
    """After its statistics, cleaning is one scan of the kept rows without a shuffle."""
    text = plan(QUERIES["clean_run"](spark, SMALL))
    assert "Exchange" not in text and text.count("FileScan") == 1
