"""Cross-validation by class, and a linear learner in closed form.

Folds are dealt by rank within the class, so every fold holds each class in proportion. The linear learner
needs one aggregation over the rows, the sums of products of its features; what is solved on the driver
has one row and column per feature, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyspark.functions.numbers import round_even
from tidyspark.operators import models
from tidyspark.operators.keyed import look_up, number_rows

FOLDS = 5


def deal_folds(df: DataFrame, label: str, order_by: list[str], folds: int = FOLDS, name: str = "fold") -> DataFrame:
    """``df`` with the column ``name``: the rank of a row in its class (nulls are a class), in ``order_by`` order, modulo ``folds``.

    Classes are numbered by slices of one sort, so a class of any size is many tasks' work. ``order_by`` should
    tell rows apart; rows that it does not are dealt in any order. An empty table keeps its columns.
    """
    if folds < 2:
        raise ValueError("cross-validation needs two folds at least")
    order = [F.col(f"`{label}`"), *[F.col(f"`{c}`") for c in order_by]]
    numbered = number_rows(df, order, "__place")
    key = F.struct(F.col(f"`{label}`").isNull().alias("none"), F.col(f"`{label}`").alias("value"))
    numbered = numbered.withColumn("__class", F.to_json(key))
    first = numbered.groupBy("__class").agg(F.min("__place").alias("__first"))
    placed = look_up(numbered, first, "__class", ["__place"])
    return placed.withColumn(name, ((F.col("__place") - F.col("__first")) % folds).cast("int")).drop("__class", "__place", "__first")


def cross_validate(
    df: DataFrame, target: str, order_by: list[str], family: str = models.FALLBACK, folds: int = FOLDS,
    rounds: int = models.BOOST_ROUNDS, depth: int = models.FOREST_DEPTH,
) -> DataFrame:
    """One row per fold: model_type, fold, plain_score, model_aware_score, train_rows, test_rows. Preparation is fitted on
    the other folds' rows only; ``summary`` gives means and spreads."""
    dealt = deal_folds(df, target, order_by, folds, "__fold")
    problem = models.pose(dealt, target, split="__fold")
    rows = []
    for fold in range(folds):
        data = problem.data.withColumn("training", F.col("__fold") != fold)
        counts = {r["training"]: r["count"] for r in data.groupBy("training").count().collect()}
        train, test = counts.get(True, 0), counts.get(False, 0)
        one = models.Problem(data, problem.numeric, problem.textual, problem.task, problem.classes, train, test)
        scores = [models.score(one, family, aware, rounds, depth) for aware in (False, True)] if train and test else [None, None]
        rows.append((family, fold, *scores, train, test))
    schema = "model_type string, fold int, plain_score double, model_aware_score double, train_rows bigint, test_rows bigint"
    return df.sparkSession.createDataFrame(rows, schema)


def summary(scores: DataFrame) -> DataFrame:
    """Mean and spread (standard deviation of the folds) per model."""
    def both(column: str) -> list[Column]:
        return [
            round_even(F.avg(column), 1).alias(f"{column}_mean"),
            round_even(F.coalesce(F.stddev_samp(column), F.lit(0.0)), 1).alias(f"{column}_spread"),
        ]

    return scores.groupBy("model_type").agg(F.count("*").alias("folds"), *both("plain_score"), *both("model_aware_score"))


def ridge(df: DataFrame, features: list[str], label: str, penalty: float = 1.0) -> DataFrame:
    """(term, coefficient) of the ridge regression of ``label``, the intercept (not penalised) first.

    Rows with a null among features or label take no part. The sums of centred products come from two
    aggregations; a table without rows gives zeros, a singular system its smallest solution.
    """
    values = [F.col(f"`{c}`").cast("double") for c in (*features, label)]
    rows = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).na.drop()
    many = len(features)
    means = rows.agg(*[F.avg(f"v{i}").alias(f"m{i}") for i in range(many + 1)]).first()
    centre = [means[f"m{i}"] or 0.0 for i in range(many + 1)]
    centred = [F.col(f"v{i}") - F.lit(centre[i]) for i in range(many + 1)]
    pairs = [(i, j) for i in range(many) for j in range(i, many + 1)]
    sums = rows.agg(*[F.sum(centred[i] * centred[j]).alias(f"s{i}_{j}") for i, j in pairs]).first() if pairs else None
    gram, moment = np.zeros((many, many)), np.zeros(many)
    for i, j in pairs:
        value = sums[f"s{i}_{j}"] or 0.0
        if j == many:
            moment[i] = value
        else:
            gram[i, j] = gram[j, i] = value
    slopes = np.linalg.lstsq(gram + penalty * np.eye(many), moment, rcond=None)[0] if many else np.zeros(0)
    intercept = centre[many] - float(np.dot(slopes, centre[:many]))
    terms = [("intercept", intercept), *zip(features, map(float, slopes))]
    return df.sparkSession.createDataFrame(terms, "term string, coefficient double")
