"""Every query with a SQL check returns the check's rows."""

import pytest

from tests.oracle import connect, differences
from tidyspark.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, name):
    assert differences(spark, SMALL, name, connection) == []


def test_queries_without_sql_are_models_only():
    assert set(QUERIES) - set(ORACLES) == {"model_rf", "model_gbt", "model_linear", "model_knn", "model_lift"}


def test_linear_model_on_lineitem(spark):
    row = QUERIES["model_linear"](spark, SMALL).first()
    assert row["task"] == "regression"
    assert 0.0 <= row["baseline_score"] <= 100.0
    assert row["train_rows"] + row["test_rows"] == 6000
