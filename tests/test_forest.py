"""Forests that nobody holds: the rules against plain Python and MLlib, the same votes wherever a node is finished."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tidyspark.operators import forest, models

SCHEMA = "numbers array<double>, slots array<int>, width int, label double, training boolean, times long"


def cells(spark, rows=1500, classes=3, noise=0.4):
    """Two numbers and a category of six as slots; the label follows from them but for some noise."""
    rng = np.random.default_rng(8)
    made = []
    for i in range(rows):
        a, b, c = int(rng.integers(32)), int(rng.integers(9)), int(rng.integers(6))
        rule = (a > 11) + (b > 4 and c in (1, 5))
        other = rng.integers(3) if classes else rng.normal()
        label = float(other if rng.random() < noise else rule)
        made.append(([float(a), float(b)], [c + 1] if c else [], 7, label, i % 4 > 0, int(rng.integers(1, 4))))
    df = spark.createDataFrame(made, SCHEMA)
    return df.groupBy("numbers", "slots", "width", "label", "training").agg(F.sum("times").alias("times"))


def answers(df):
    return sorted((r["label"], round(r["prediction"], 9), r["times"]) for r in df.collect())


@pytest.mark.parametrize("classes", [3, 0])
@pytest.mark.parametrize("least", [300, 30, 0])
def test_votes_do_not_hang_on_where_nodes_are_finished(spark, monkeypatch, classes, least):
    """Nodes cut by counts of the cluster and nodes finished in a task give the same forest, leaves merged alike."""
    data = cells(spark, classes=classes).localCheckpoint()
    whole = answers(forest.predict(data, classes, 7, 12, 42))
    assert sum(r[2] for r in whole) == data.filter("NOT training").agg(F.sum("times")).first()[0]
    monkeypatch.setattr(forest, "NODE_ROWS", least)
    monkeypatch.setattr(forest, "BATCH_ROWS", 200)
    monkeypatch.setattr(forest, "TABLE_CELLS", 50)
    assert answers(forest.predict(data.repartition(3), classes, 7, 12, 42)) == whole


@pytest.mark.parametrize("classes", [3, 0])
def test_one_tree_is_that_of_mllib(spark, classes):
    """A single tree has no draws: cuts, ties, merged leaves and votes are those of MLlib's decision tree."""
    data = cells(spark, classes=classes).localCheckpoint()
    got = forest.predict(data, classes, 1, 5, 42)
    kind = DecisionTreeClassifier if classes else DecisionTreeRegressor
    rows = models.assembled(data)
    learner = kind(maxDepth=5, seed=42, weightCol="times")
    want = learner.fit(rows.filter("training")).transform(rows.filter("NOT training"))
    assert answers(got) == answers(want.select("label", "prediction", "times"))


def test_large_tables_get_a_forest_that_is_not_held(spark, monkeypatch):
    """From ``FOREST_ROWS`` on MLlib's forest, which sits whole in the driver and in every task, is not asked for; both learn alike."""
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b), "uv"[i % 2], "yes" if a * b > 0 else "no") for i, (a, b) in enumerate(rng.normal(size=(900, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, kind string, approved string")
    line = df.select("a", "kind", (F.col("a") * 3 + 1).alias("total"))
    held = models.benchmark(df, "approved", "random_forest", depth=8).first()
    held_line = models.benchmark(line, "total", "random_forest", depth=8).first()
    monkeypatch.setattr(models, "FOREST_ROWS", 1)
    monkeypatch.setattr(models, "_learner", None)
    row = models.benchmark(df, "approved", "random_forest", depth=8).first()
    for score in ("baseline_score", "model_aware_score"):
        assert row[score] > 85 and abs(row[score] - held[score]) < 6
    row = models.benchmark(line, "total", "random_forest", depth=8).first()
    assert row["task"] == "regression" and abs(row["model_aware_score"] - held_line["model_aware_score"]) < 6


def test_equal_rows_are_drawn_together(spark):
    """Weights hang on the cell alone; their mean and variance are the number of rows. Cells asked about have none."""
    data = spark.range(3000).select(
        F.array((F.col("id") % 32).cast("double")).alias("numbers"), F.array(F.col("id").cast("int")).alias("slots"), F.lit(3001).alias("width"),
        F.lit(0.0).alias("label"), (F.col("id") % 3 > 0).alias("training"), F.lit(5).cast("long").alias("times"),
    )
    shape = forest.Shape(2, 3001, 40, 5, 42)
    made = [forest._weighted(df, shape).collect() for df in (data, data.repartition(5))]
    first, second = ({r["slots"][0]: r["weights"] for r in rows} for rows in made)
    assert first == second and not any(any(first[i]) for i in range(0, 3000, 3))
    drawn = np.array([first[i] for i in range(3000) if i % 3])
    assert abs(drawn.mean() - 5) < 0.05 and abs(drawn.var() - 5) < 0.15
