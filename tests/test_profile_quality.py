"""Profiles, scores and validation on small tables."""

import pytest

from tidyspark.operators import facts, profile, quality
from tidyspark.operators.duplicates import drop_duplicate_rows, duplicate_total


def scores(df):
    return quality.quality(df).first().asDict()


def test_table_profile_counts(spark):
    df = spark.createDataFrame([(10.0, " india "), (None, "US"), (10.0, "US")], "price double, region string")
    row = profile.table_profile(df).first()
    assert (row["rows"], row["columns"], row["missing_values"], row["duplicates"]) == (3, 2, 1, 0)
    assert row["empty_columns"] == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "name string")
    basics = profile.column_basics(df).collect()
    assert [(r["name"], r["nulls"], r["null_pct"], r["unique"]) for r in basics] == [("name", 0, 0.0, 0)]
    assert set(scores(df).values()) == {0.0}
    report = quality.validate(df).first()
    assert report["rows"] == 0 and "no_empty_columns" in report["issues"]


def test_quality_improves(spark):
    before = spark.createDataFrame([(1,), (None,), (1,)], "value int")
    after = spark.createDataFrame([(1,), (2,)], "value int")
    assert scores(after)["overall"] > scores(before)["overall"]
    lift = {r["metric"]: r["lift"] for r in quality.quality_lift(before, after).collect()}
    assert lift["completeness"] == pytest.approx(33.3)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    row = facts.column_facts(df, ["nulls", "low", "high", "mean"]).first()
    assert (row["nulls"], row["low"], row["high"], row["mean"]) == (2, 1.0, 1.0, 1.0)


def test_validity_is_not_clamped_and_skips_text_and_booleans(spark):
    columns = ", ".join(f"c{i} int" for i in range(6))
    df = spark.createDataFrame([(*[-1] * 6, "x", True)], f"{columns}, t string, b boolean")
    assert scores(df)["validity"] == -20.0


def test_consistency_counts_tabs_and_caps(spark):
    one = spark.createDataFrame([("x\t",), ("y",), ("z",), (None,), ("w",)], "t string")
    assert scores(one)["consistency"] == 80.0
    assert scores(spark.createDataFrame([(" x",)], "t string"))["consistency"] == 75.0


def test_like_flags(spark):
    rows = [("$-4.00", "yes", "1", "5d", None), ("$8.00", " NO ", "0", "6", None)]
    df = spark.createDataFrame(rows, "money string, flag string, bits string, size string, none string")
    numeric = {r["name"]: (r["numeric_like"], r["min"]) for r in profile.numeric_like_columns(df).collect()}
    assert numeric == {
        "money": (True, -4.0), "flag": (False, None), "bits": (False, None), "size": (False, None), "none": (False, None),
    }
    flags = {r["name"]: r["boolean_like"] for r in profile.boolean_like_columns(df).collect()}
    assert flags == {"money": False, "flag": True, "bits": True, "size": False, "none": False}


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccd"], "t string")
    row = profile.column_profile(df).first()
    assert [tuple(v) for v in row["top_values"]] == [("a", 2), ("b", 2), ("c", 2)]
    assert row["unique"] == 4


def test_wide_tables_are_cut_into_groups(spark):
    df = spark.range(3).selectExpr(*[f"id - {i} AS c{i}" for i in range(60)])
    found = facts.column_facts(df, ["nulls", "negatives", "low", "high", "mean", "deviation"], empty_rows=True).collect()
    assert len(facts._groups(list(enumerate(df.schema)), ["mean", "deviation"])) > 1
    assert [r["low"] for r in sorted(found, key=lambda r: r["ordinal"])] == [-float(i) for i in range(60)]
    assert {r["empty_rows"] for r in found} == {0, None}


def test_first_look_only_refutes(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "3")] * 20 + [("z", "4")], "a string, b string").coalesce(1)
    refuted = facts.first_look(df, ["all_numbers"], rows=10, smallest=0)
    assert "all_numbers" not in refuted["a"] and "all_numbers" in refuted["b"]
    found = {r["name"]: r["all_numbers"] for r in facts.column_facts(df, ["all_numbers"], disproved=refuted).collect()}
    assert found == {"a": False, "b": False}


@pytest.mark.parametrize("direct_rows", [0, 1000])
def test_duplicates_by_hash_and_directly(spark, direct_rows):
    rows = [(1, "a", None)] * 40 + [(i, "b", 0.0) for i in range(10)] + [(3, "b", -0.0), (None, None, None)] * 2
    df = spark.createDataFrame(rows, "i int, s string, d double").repartition(3)
    assert duplicate_total(df, direct_rows).first()["duplicates"] == len(rows) - df.distinct().count()
    kept = drop_duplicate_rows(df, direct_rows)
    assert kept.count() == df.distinct().count()
    assert kept.distinct().count() == kept.count()
