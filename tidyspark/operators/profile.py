"""Profiles: table totals and per-column descriptions, as lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.functions.numbers import percent, round_even
from tidyspark.operators import facts
from tidyspark.operators.duplicates import duplicate_total


def numeric_like() -> Column:
    """Text in which every value is a number and not every value a boolean word."""
    return F.coalesce(F.col("all_numbers") & ~F.col("all_booleans"), F.lit(False))


def boolean_like() -> Column:
    return F.coalesce(F.col("all_booleans"), F.lit(False))


def table_profile(df: DataFrame) -> DataFrame:
    """One row: ``rows, columns, missing_values, duplicates, empty_rows, empty_columns``."""
    per_column = facts.column_facts(df, ["nulls"], empty_rows=True)
    copies = duplicate_total(df)
    # one aggregation over the column rows and the duplicate count: no join
    return (
        per_column.unionByName(copies, allowMissingColumns=True)
        .agg(
            F.max("rows").alias("rows"),
            F.count("ordinal").alias("columns"),
            F.sum("nulls").alias("missing_values"),
            F.max("duplicates").alias("duplicates"),
            F.max("empty_rows").alias("empty_rows"),
            F.array_sort(F.collect_list(F.when(F.col("nulls") == F.col("rows"), F.struct("ordinal", "name"))))
            .getField("name")
            .alias("empty_columns"),
        )
    )


def column_basics(df: DataFrame) -> DataFrame:
    """``ordinal, name, dtype, nulls, null_pct, unique, empty`` per column."""
    described = F.array(
        *[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("dtype")) for f in df.schema]
    )
    missing = F.col("s").isNull() & F.col("n").isNull() & F.col("d").isNull()
    per_column = facts.value_counts(df).groupBy("ordinal").agg(
        F.sum("times").alias("rows"),
        F.coalesce(F.sum(F.when(missing, F.col("times"))), F.lit(0)).alias("nulls"),
        F.count_if(~missing).alias("unique"),
    )
    # A table without rows has its columns all the same.
    columns = df.limit(0).agg(F.count("*")).select(F.posexplode(described).alias("at", "column"))
    columns = columns.select((F.col("at") + 1).alias("at"), "column.*")
    nulls, rows = (F.coalesce(c, F.lit(0)).cast("bigint") for c in ("nulls", "rows"))
    return columns.join(per_column, F.col("at") == F.col("ordinal"), "left").select(
        F.col("at").alias("ordinal"),
        "name",
        "dtype",
        nulls.alias("nulls"),
        F.coalesce(round_even(percent(F.col("nulls"), F.col("rows")), 1), F.lit(0.0)).alias("null_pct"),
        F.coalesce("unique", F.lit(0)).cast("bigint").alias("unique"),
        (nulls == rows).alias("empty"),
    )


def numeric_profile(df: DataFrame) -> DataFrame:
    """``name, min, max, mean`` of number and boolean columns."""
    return (
        facts.column_facts(df, ["low", "high", "mean"])
        .filter(F.col("kind").isin(facts.NUMBER, facts.BOOLEAN))
        .select(
            "ordinal",
            "name",
            F.col("low").alias("min"),
            F.col("high").alias("max"),
            round_even(F.col("mean"), 2).alias("mean"),
            F.lit(False).alias("numeric_like"),
            F.lit(False).alias("boolean_like"),
        )
    )


def boolean_like_columns(df: DataFrame) -> DataFrame:
    """``name, boolean_like`` of every text column."""
    return (
        facts.column_facts(df, ["all_booleans"])
        .filter(F.col("kind") == facts.TEXT)
        .select("ordinal", "name", boolean_like().alias("boolean_like"))
    )


def numeric_like_columns(df: DataFrame) -> DataFrame:
    """``name, numeric_like, min, max, mean`` of every text column; the three
    statistics are given for numeric-like columns only."""
    found = facts.column_facts(df, ["all_booleans", "all_numbers", "text_low", "text_high", "text_mean"])
    return found.filter(F.col("kind") == facts.TEXT).select(
        "ordinal",
        "name",
        numeric_like().alias("numeric_like"),
        F.when(numeric_like(), F.col("text_low")).alias("min"),
        F.when(numeric_like(), F.col("text_high")).alias("max"),
        F.when(numeric_like(), round_even(F.col("text_mean"), 2)).alias("mean"),
    )


def _top_values(df: DataFrame, counts: DataFrame, limit: int) -> DataFrame:
    """``ordinal, rank, value, times``: the most frequent values per column.

    The rank filter becomes a per-task group limit, so at most ``limit`` rows
    per column and task reach the final sort.
    """
    order = Window.partitionBy("ordinal").orderBy(F.desc("times"), F.asc("s"))
    return (
        counts.filter(F.col("s").isNotNull())
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= limit)
        .select("ordinal", "rank", F.col("s").alias("value"), "times")
    )


def described_columns(df: DataFrame) -> list[str]:
    """Columns whose frequent values are listed: everything but numbers."""
    return [f.name for f in df.schema if facts.kind_of(f) in (facts.TEXT, facts.OTHER)]


def top_values(df: DataFrame, limit: int = 3) -> DataFrame:
    """``name, rank, value, times`` of the most frequent values of non-numeric columns."""
    name = F.array(*[F.lit(c) for c in df.columns])
    counts = facts.value_counts(df, described_columns(df))
    return _top_values(df, counts, limit).select(
        "ordinal", name[F.col("ordinal") - 1].alias("name"), "rank", "value", "times"
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Everything about each column in one row, ``top_values`` as an array.

    Three scans, one shuffle of (column, value) counts: basics and frequent
    values share the same exchange.
    """
    found = facts.column_facts(
        df, ["low", "high", "mean", "all_booleans", "all_numbers", "text_low", "text_high", "text_mean"]
    )
    stats = found.select(
        "ordinal",
        F.coalesce("low", F.when(numeric_like(), F.col("text_low"))).alias("min"),
        F.coalesce("high", F.when(numeric_like(), F.col("text_high"))).alias("max"),
        round_even(F.coalesce("mean", F.when(numeric_like(), F.col("text_mean"))), 2).alias("mean"),
        numeric_like().alias("numeric_like"),
        boolean_like().alias("boolean_like"),
    )
    frequent = (
        _top_values(df, facts.value_counts(df, described_columns(df)), 3)
        .groupBy("ordinal")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "value", "times"))).alias("top"))
        .select(
            "ordinal",
            F.transform("top", lambda t: F.struct(t["value"].alias("value"), t["times"].alias("count"))).alias(
                "top_values"
            ),
        )
    )
    # one row per column on every side
    return column_basics(df).join(stats, "ordinal").join(frequent, "ordinal", "left")
