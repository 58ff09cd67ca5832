"""Cleaning steps on small tables, edge cases included."""

from tidyspark.operators import clean as c
from tidyspark.operators import quantiles as q
from tidyspark.plans import run
from tidyspark.plans.planner import build_plan, snapshot

SALES = [
    (1001, "2025/01/05", 10.0, " us "),
    (1002, "2025-01-06", None, "india"),
    (1003, "2025/01/07", 13.75, "US"),
    (1003, "2025/01/07", 13.75, "US"),
    (1004, "2025-01-08", 13.75, "uk"),
    (1005, "2025/01/09", 20.0, "canada"),
]


def operations(df, model=None):
    return [s.operation for s in build_plan(snapshot(df), model)]


def test_sales_in_four_steps(spark):
    df = spark.createDataFrame(SALES, "order_id long, order_date string, price double, region string")
    assert "standardize_dates" in operations(df)
    cleaned = c.standardise_dates(c.normalise_strings(c.fill_missing(c.remove_duplicates(df)))).orderBy("order_id")
    rows = cleaned.collect()
    assert len(rows) == 5
    assert rows[1]["price"] == 13.75
    assert [r["region"] for r in rows].count("US") == 2
    assert [r["order_date"] for r in rows] == [f"2025-01-0{d}" for d in range(5, 10)]


UNTIDY = [
    ("D-2001", "2025/02/01", 2, "$4.5", "yes", " us ", None),
    ("D-2002", "2025-02-02", 3, "$3.0", "no", "UK", None),
    ("D-2003", "2025/02/03", None, "$5.0", "TRUE", "us", None),
    ("D-2004", "2025-02-04", -2, "$4.0", "FALSE", " ca", None),
    ("D-2005", "March 5 2025", 4, None, "1", None, None),
    ("D-2006", "2025-02-06", 5, "$2.5", "0", "us", None),
    ("D-2006", "2025-02-06", 5, "$2.5", "0", "us", None),
    (None, None, None, None, None, None, None),
    ("D-2007", "2025-02-07", 6, "$1.5", "yes", "india", None),
    ("D-2008", "14-02-2025", 7, "$3.5", "no", "us", None),
    ("D-2009", "2025-02-09", 8, "$4,000.5", "yes", "us", None),
]
UNTIDY_SCHEMA = (
    "`Order ID` string, `Order Date` string, Quantity long, `Review Score` string, Approved string, Region string, "
    "`Unused Notes` string"
)


def test_whole_plan(spark):
    df = spark.createDataFrame(UNTIDY, UNTIDY_SCHEMA)
    assert operations(df) == [
        "remove_empty_rows", "remove_empty_columns", "remove_duplicates", "coerce_numeric_columns",
        "normalize_boolean_columns", "fill_missing", "correct_negative_values", "normalize_strings",
        "standardize_dates", "standardize_column_names", "validate", "store",
    ]
    result = run.run_table(df, "small")
    rows = {r["order_id"]: r for r in result.table.collect()}
    assert len(rows) == 9 and result.table.count() == 9
    assert rows["D-2004"]["quantity"] == 0
    assert "unused_notes" not in result.table.columns
    assert all(v is not None for r in rows.values() for v in r)
    assert dict(result.table.dtypes)["review_score"] == "double"
    assert {r["approved"] for r in rows.values()} == {"Yes", "No"}
    assert rows["D-2008"]["order_date"] == "2025-02-14" and rows["D-2005"]["order_date"] == "2025-03-05"
    assert result.validation["validated"] and result.validation["validity"] == 100.0
    log = {r["action"]: r for r in result.audit.collect()}
    assert log["remove_duplicates"]["output"] == "removed 1 rows"
    assert log["correct_negative_values"]["output"] == "corrected 1 values"
    assert {r["dataset_id"] for r in result.audit.collect()} == {"small"}
    lift = {r["metric"]: r["lift"] for r in result.quality.collect()}
    assert lift["overall"] > 0


def test_model_aware_run(spark, tmp_path):
    rows = [(i, f"2025-01-{i % 28 + 1:02d}", float(i % 7), "ab"[i % 2], ("yes", "no")[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "`Order ID` long, `Order Date` string, price double, kind string, `Is Return?` string")
    result = run.run_table(df, "returns", "logistic_regression", "Is Return?", audit_path=str(tmp_path / "audit"))
    assert {"clip_outliers", "scale_features", "encode_categoricals"} <= {r["operation"] for r in result.plan.collect()}
    # the target keeps its role under its new name: neither scaled nor encoded
    assert {r["is_return"] for r in result.table.collect()} == {"Yes", "No"}
    score = result.benchmark.first()
    assert score["target_column"] == "is_return" and score["model_aware_score"] == 100.0
    stages = {r["agent"]: r["status"] for r in result.audit.filter("kind = 'stage'").collect()}
    assert stages["Benchmark"] == "SUCCESS"
    stored = spark.read.parquet(str(tmp_path / "audit"))
    assert {r["run_id"] for r in stored.collect()} == {result.run_id}


def test_negative_money_text_is_planned(spark):
    df = spark.createDataFrame([("$-4.00",), ("$8.00",)], "adjustment string")
    assert {"coerce_numeric_columns", "correct_negative_values"} <= set(operations(df))


def test_model_steps(spark):
    df = spark.createDataFrame([(1, "a")], "x int, t string")
    assert operations(df, "knn")[-5:-2] == ["clip_outliers", "scale_features", "encode_categoricals"]
    assert operations(df, "xgboost")[-3] == "encode_categoricals"
    assert operations(df, "generic")[-2:] == ["validate", "store"]


def test_empty_columns_are_kept_when_there_is_nothing_else(spark):
    df = spark.createDataFrame([(None, None)], "a string, b int")
    assert c.remove_empty_columns(df).columns == ["a", "b"]


def test_coercion_is_all_or_nothing(spark):
    df = spark.createDataFrame([("1", "5d", "1", "2.5"), ("2", "6", "0", None)], "a string, b string, c string, d string")
    out = c.coerce_numeric(df)
    assert dict(out.dtypes) == {"a": "bigint", "b": "string", "c": "bigint", "d": "double"}


def test_fill(spark):
    rows = [(1, "b", None, None, True), (None, "a", None, None, None), (2, None, None, None, True), (5, "a", None, None, False), (6, "b", None, None, None)]
    df = spark.createDataFrame(rows, "n long, t string, empty_text string, empty_number double, flag boolean")
    out = c.fill_missing(df).collect()
    assert sorted(r["n"] for r in out) == [1.0, 2.0, 3.5, 5.0, 6.0]
    assert [r["t"] for r in out].count("a") == 3  # a tie goes to the smaller value
    assert {r["empty_text"] for r in out} == {"Unknown"}
    assert {r["empty_number"] for r in out} == {None}
    assert {r["flag"] for r in out} == {True, False} and all(r["flag"] is not None for r in out)


def test_negatives_keep_missing_and_types(spark):
    df = spark.createDataFrame([(-1, -2.5, None), (3, None, -7)], "a int, b double, c long")
    out = c.correct_negatives(df)
    assert out.dtypes == df.dtypes
    assert [tuple(r) for r in out.collect()] == [(0, 0.0, None), (3, None, 0)]


def test_strings_exclude(spark):
    df = spark.createDataFrame([(" ord-1 ", " us")], "code string, region string")
    assert tuple(c.normalise_strings(df, exclude=("code",)).first()) == (" ord-1 ", "US")
    assert tuple(c.normalise_strings(df, region_columns=("code",)).first()) == ("Ord-1", "Us")


def test_dates_need_every_value(spark):
    df = spark.createDataFrame([("2024/01/02", "x"), ("nope", "y")], "date_a string, updated string")
    assert c.standardise_dates(df).collect() == df.collect()
    stamped = df.selectExpr("timestamp'2024-05-06 07:08:09' AS ship_date")
    assert stamped.transform(c.standardise_dates).first()[0] == "2024-05-06"


def test_quantiles_by_bracketing_are_exact(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(size=4000), np.full(3000, 0.25), rng.integers(-5, 5, 3000).astype(float)])
    ties = np.where(np.arange(10000) < 6600, 1.0, np.arange(10000))
    rows = [(float(a), float(b), None) for a, b in zip(values, ties)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    points = [0.0, 0.01, 0.25, 0.5, 0.66, 0.99, 1.0]
    found = q.quantiles(df, {"a": points, "b": points, "c": [0.5]}, direct_cells=0, accuracy=100, max_candidates=50)
    assert np.allclose(found["a"], np.quantile(values, points), rtol=0, atol=1e-12)
    assert np.allclose(found["b"], np.quantile(ties, points), rtol=0, atol=1e-9)
    assert found["c"] == [None]


def test_mode_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("b", 1), ("a", 2), (None, None)], "t string, n int")
    assert q.modes(df, ["t", "n"]) == {"t": "a", "n": 1}


def test_run_scores_the_same_target_with_every_family(spark):
    from tidyspark.plans.run import run_table

    rows = [("ABC"[i % 3], float(i % 7), i % 11) for i in range(60)]
    df = spark.createDataFrame(rows, "status string, x double, amount int")
    for family in ("logistic_regression", "knn"):
        row = run_table(df, "orders", model=family).benchmark.first()
        assert row["task"] == "classification", family
