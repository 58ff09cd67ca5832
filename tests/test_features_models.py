"""Feature preparation, neighbours, metrics and benchmarks on small tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidyspark.operators import features, keyed, knn, models


def numbers(spark, rows=300):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(
        {"x": rng.normal(size=rows) * 10, "y": rng.integers(0, 5, rows).astype(float), "c": 4.0, "k": range(rows)}
    )
    frame.loc[5, "x"] = np.nan
    return frame, spark.createDataFrame(frame).select(F.when(~F.isnan("x"), F.col("x")).alias("x"), "y", "c", "k")


def test_clip_matches_pandas(spark):
    frame, df = numbers(spark)
    got = features.clip_outliers(df.select("x", "k"), target="k").orderBy("k").toPandas()["x"]
    want = frame["x"].clip(frame["x"].quantile(0.01), frame["x"].quantile(0.99))
    assert np.allclose(got.astype(float), want, equal_nan=True)


def test_clip_leaves_short_columns(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (400.0,), (None,)], "x double")
    assert features.clip_outliers(df).collect() == df.collect()


@pytest.mark.parametrize("method", ["standard", "minmax", "robust"])
def test_scale_matches_pandas(spark, method):
    frame, df = numbers(spark)
    got = features.scale(df.select("x", "c", "k"), method, target="K").orderBy("k").toPandas()
    x = frame["x"]
    want = {
        "standard": (x - x.mean()) / x.std(),
        "minmax": (x - x.min()) / (x.max() - x.min()),
        "robust": (x - x.median()) / (x.quantile(0.75) - x.quantile(0.25)),
    }[method].round(4)
    assert np.allclose(got["x"].astype(float), want, equal_nan=True)
    assert set(got["c"]) == {0.0}
    assert list(got["k"]) == list(range(300))


def test_one_row_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,)], "x double")
    assert features.scale(df, "standard").first()[0] == 0.0


def test_ordinal_codes_by_first_appearance(spark):
    rows = [(i, v, f"n{i}") for i, v in enumerate(["b", None, "a", "b", "c", "a"])]
    df = spark.createDataFrame(rows, "k int, kind string, full_name string").repartition(3)
    got = features.encode_ordinal(df, ["k"]).orderBy("k").collect()
    assert [r["kind"] for r in got] == [0, -1, 1, 0, 2, 1]
    assert got[0]["full_name"] == "n0"


def test_ordinal_codes_with_a_large_dictionary(spark):
    rows = [(i, f"v{(i * 37) % 211}", "hot" if i % 3 else f"w{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "k int, a string, b string").repartition(4)
    small = features.encode_ordinal(df, ["k"]).orderBy("k").collect()
    assert features.encode_ordinal(df, ["k"], limit=10).orderBy("k").collect() == small


def test_onehot(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4)], "kind string, x int")
    got = features.encode_onehot(df)
    assert got.columns == ["x", "kind_b", "kind_c"]
    assert sorted(map(tuple, got.collect())) == [(1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 0, 1)]
    with pytest.raises(ValueError, match="kind"):
        features.encode_onehot(df, max_categories=2)


def test_look_up_salted_equals_broadcast(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
    dictionary = df.select("key").distinct().withColumn("size", F.length("key"))
    plain = keyed.look_up(df, dictionary, "key", ["id"])
    salted = keyed.look_up(df, dictionary, "key", ["id"], limit=3)
    rows = [frame.orderBy("id").select("id", "key", "size").collect() for frame in (plain, salted)]
    assert rows[0] == rows[1] and len(rows[0]) == 2000


def test_number_rows_is_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(5)
    got = keyed.number_rows(df, [F.col("v")], "n", slices=7).collect()
    assert all(r["v"] == r["n"] for r in got) and len(got) == 1000


@pytest.mark.parametrize("sizes", [(2048, 2048), (40, 16)])
def test_nearest_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(11)
    train = np.vstack([rng.normal(size=(300, 3)), np.zeros((200, 3)), rng.integers(0, 3, (200, 3))]).astype(float)
    labels = rng.integers(0, 4, len(train)).astype(float)
    asked = np.vstack([rng.normal(size=(60, 3)) * 2, np.zeros((40, 3)), rng.integers(0, 3, (40, 3))]).astype(float)
    tdf = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(train, labels)], "vector array<double>, label double")
    qdf = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(asked)], "query long, vector array<double>")
    found = knn.nearest(tdf, qdf, 5, *sizes)
    got = {}
    for row in found.collect():
        got.setdefault(row["query"], []).extend([row["label"]] * row["weight"])
    for i, point in enumerate(asked):
        squared = ((train - point) ** 2).sum(axis=1)
        order = np.lexsort((labels, squared))[:5]
        assert sorted(got[i]) == sorted(labels[order]), i
    votes = {r["query"]: r["prediction"] for r in knn.vote(found).collect()}
    assert len(votes) == len(asked)


def test_metrics(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("b", "d")]
    df = spark.createDataFrame(rows, "label string, prediction string")
    # a: 2*1/(2+2)=.5  b: 2*1/(2+2)=.5  c: 0  d: 0
    assert models.macro_f1(df).first()[0] == pytest.approx(0.25)
    line = spark.createDataFrame([(1.0, 1.5, 2), (2.0, 2.0, 1), (4.0, 3.0, 1)], "label double, prediction double, w int")
    assert models.r2(line).first()[0] == pytest.approx(1 - 1.25 / 4.666666666666667)
    y, p = np.array([1, 1, 2, 4.0]), np.array([1.5, 1.5, 2, 3])
    assert models.r2(line, weight="w").first()[0] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert models.r2(spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "label double, prediction double")).first()[0] == 1.0


@pytest.mark.parametrize("family", models.FAMILIES)
def test_families_learn_a_simple_rule(spark, family):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b), "uv"[i % 2], "yes" if a > 0 else "no") for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, kind string, approved string")
    row = models.benchmark(df, "Approved", family, rounds=10, depth=6).first()
    assert row["task"] == "classification" and row["target_column"] == "approved"
    assert row["model_aware_score"] > 80.0
    assert row["lift"] == pytest.approx(row["model_aware_score"] - row["baseline_score"], abs=0.05)


def test_scale_matters_to_neighbours(spark):
    rng = np.random.default_rng(9)
    rows = [(float(a), float(b) * 10000, "yes" if a > 0 else "no") for a, b in rng.normal(size=(400, 2))]
    df = spark.createDataFrame(rows, "a double, b double, approved string")
    assert models.benchmark(df, "approved", "knn").first()["lift"] > 10


def test_a_table_with_one_side_is_not_scored(spark):
    one_sided = next(k for k in range(50) if _sides(spark, k) == 1)
    row = models.benchmark(_pair(spark, one_sided), "status", "knn").first()
    assert row["baseline_score"] is None and row["lift"] is None and row["note"].startswith("not scored")
    assert row["features"] == ["a"]


def _pair(spark, k):
    return spark.createDataFrame([(float(k), "x"), (k + 0.5, "y")], "a double, status string")


def _sides(spark, k):
    posed = models.pose(_pair(spark, k), "status")
    return (posed.train_rows > 0) + (posed.test_rows > 0)


def test_many_classes_and_categories(spark):
    df = spark.range(6000).select(
        F.concat(F.lit("v"), F.col("id") % 150).alias("kind"), (F.col("id") % 7).cast("double").alias("a"),
        F.concat(F.lit("t"), F.col("id") % 2000).alias("status"),
    )
    posed = models.pose(df, "status")
    assert posed.classes == 2000 and posed.data.agg(F.countDistinct("label"), F.max("label")).first()[:] == (2000, 1999.0)
    assert len(models.dense(models.prepare(posed, "knn", False)).select("vector").first()[0]) == 1 + 149
    assert models.benchmark(df.drop("status"), "a", "random_forest", depth=5).first()["task"] == "classification"


@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_prepared_vectors_from_a_dictionary(spark, monkeypatch, limit):
    """Codes, sparse and dense vectors against plain Python, by broadcast and by salted join, without a collect of values."""
    monkeypatch.setattr(features, "categories", None)
    words = ["b", None, "é", "a", "Z", "", "b", "b"]
    rows = [(i, words[i % 8], f"w{i % 5}" if i % 11 else None, float(i % 4), i % 3 > 0) for i in range(88)]
    rows += [(88, "unseen", "w1", None, False)]
    data = spark.createDataFrame(rows, "id int, `a.b` string, c string, x double, training boolean").withColumn("label", F.col("id") * 1.0)
    posed = models.Problem(data, ["x"], ["a.b", "c"], "regression", 0, 59, 30)
    train = [r for r in rows if r[4]]
    order = [sorted({r[j] for r in train if r[j] is not None}, key=lambda v: v.encode()) for j in (1, 2)]
    middle = sorted(r[3] for r in train)
    middle = (middle[(len(middle) - 1) // 2] + middle[len(middle) // 2]) / 2
    plain, codes = {}, {}
    for r in rows:
        number = middle if r[3] is None else r[3]
        plain[r[0]] = [number, *[float(r[j + 1] == v) for j in (0, 1) for v in order[j][1:]]]
        codes[r[0]] = [number, *[float(order[j].index(r[j + 1])) if r[j + 1] in order[j] else -1.0 for j in (0, 1)]]
    one_hot = models.prepare(posed, "random_forest", False, limit)
    ordinal = models.prepare(posed, "xgboost", True, limit)
    for prepared, want in ((one_hot, plain), (ordinal, codes)):
        assert {int(r["label"]): r["vector"] for r in models.dense(prepared).collect()} == want
        got = {int(r["label"]): r["features"] for r in models.assembled(prepared).collect()}
        assert {k: list(v.toArray()) for k, v in got.items()} == want
    assert max(len(r["features"].indices) for r in models.assembled(one_hot).collect()) <= 3


def test_model_on_a_column_of_many_values(spark):
    """One value a row: no list of values is made, a row stays three entries long."""
    df = spark.range(60_000).select(
        F.concat(F.lit("k"), F.col("id")).alias("kind"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 7 * 2.0).alias("total")
    )
    posed = models.pose(df, "total")
    prepared = models.prepare(posed, "logistic_regression", False)
    assert prepared.select("width").first()[0] > 45_000
    assert models.assembled(prepared).filter("training").count() == posed.train_rows


def test_text_only_and_empty_features(spark):
    df = spark.createDataFrame([("p" if i % 2 else "q", None if i % 3 else "z", "yes" if i % 2 else "no") for i in range(60)], "u string, v string, status string")
    row = models.benchmark(df.withColumn("u", F.concat("u", (F.monotonically_increasing_id() % 9).cast("string"))), "status", "logistic_regression").first()
    assert row["baseline_score"] is None or row["baseline_score"] >= 0


def test_regression_and_fallback(spark):
    df = spark.range(400).select((F.col("id") % 17).cast("double").alias("a"), (F.col("id") * 1.0).alias("b"), ((F.col("id") % 17) * 3.0 + 1).alias("total"))
    row = models.benchmark(df, "total", "linear_regression", depth=6).first()
    assert (row["model_type"], row["task"], row["metric_name"]) == ("random_forest", "regression", "R² Score")
    assert models.benchmark(df, "total", "logistic_regression").first()["model_aware_score"] > 99


def test_single_class(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "a int, status string")
    row = models.benchmark(df, "status").first()
    assert (row["baseline_score"], row["model_aware_score"], row["lift"]) == (100.0, 100.0, 0.0)


def test_registered_models_run_the_defaults(monkeypatch):
    import inspect

    from tidyspark.operators import models as library
    from tidyspark.queries import models as registered

    calls = []
    shape = inspect.signature(library.benchmark)

    class Frame:
        def __getattr__(self, name):
            return lambda *a, **b: self

    def called(*a, **b):
        bound = shape.bind(*a, **b)
        bound.apply_defaults()
        calls.append((bound.arguments["rounds"], bound.arguments["depth"]))
        return Frame()

    monkeypatch.setattr(library, "benchmark", called)
    monkeypatch.setattr(registered, "table", lambda *a: Frame())
    monkeypatch.setattr(registered, "reduce", lambda f, xs: xs)
    for name in ("model_rf", "model_gbt", "model_lift"):
        getattr(registered, name)(None, "")
    assert len(calls) == 2 + len(library.FAMILIES) and set(calls) == {(library.BOOST_ROUNDS, library.FOREST_DEPTH)}


def test_boosting_counts_rows_it_cannot_tell_apart(spark, monkeypatch):
    """Merged rows give the predictions of the rows themselves, and do not grow with the table."""
    rng = np.random.default_rng(3)
    rows = [(float(i % 9), float(rng.integers(12)), "uvw"[i % 3], float(x > 0.3)) for i, x in enumerate(rng.normal(size=900))]
    df = spark.createDataFrame(rows, "a double, b double, kind string, label double")
    df = df.withColumn("label", F.when(F.col("a") > 4, 1.0).otherwise(F.col("label"))).withColumn("training", F.col("b") != 5)
    posed = models.Problem(df, ["a", "b"], ["kind"], "classification", 2, 825, 75)
    for aware in (False, True):
        prepared = models.prepare(posed, "xgboost", aware)
        small, large = models.merged(prepared), models.merged(prepared.unionByName(prepared).unionByName(prepared))
        assert small.agg(F.sum("times")).first()[0] == 900 and large.agg(F.sum("times")).first()[0] == 2700
        assert small.count() == large.count() < 650
        found = []
        for least in (10**9, 1):
            monkeypatch.setattr(models, "MERGE_ROWS", least)
            got = models._predict_with_learner(posed, prepared, "xgboost", 5, 5)
            found.append(sorted(map(tuple, got.groupBy("label", "prediction").agg(F.sum("times")).collect())))
        assert found[0] == found[1]


def test_merged_numbers_of_many_values(spark):
    rows = [([float(i), 7.0], [], 2, 0.0, i % 5 > 0) for i in range(1000)]
    prepared = spark.createDataFrame(rows, "numbers array<double>, slots array<int>, width int, label double, training boolean")
    got = models.merged(prepared).filter("training").collect()
    assert sorted(r["numbers"][0] for r in got) == list(range(models.RANGES)) and {r["numbers"][1] for r in got} == {0.0}
    assert {r["times"] for r in got} == {25}


def test_nearest_places_sort_no_whole_rows(monkeypatch):
    rng = np.random.default_rng(4)
    cases = [(rng.integers(0, high, size=(40, n)).astype(float), k) for high in (2, 50) for n in (1, 3, 60) for k in (1, 3, 80)]
    want = [np.argsort(squared, axis=1, kind="stable")[:, :k] for squared, k in cases]
    monkeypatch.setattr(np, "argsort", None)
    for (squared, k), places in zip(cases, want):
        rows, columns = knn._nearest_places(squared, k)
        assert rows.tolist() == np.repeat(np.arange(40), places.shape[1]).tolist() and columns.tolist() == places.ravel().tolist()
