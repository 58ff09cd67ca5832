"""Quality scores and the validation report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyspark.functions.numbers import percent, round_even
from tidyspark.operators import facts
from tidyspark.operators.duplicates import duplicate_total

# ---- fixed values ---------------------------------------------------------
WEIGHTS = {"completeness": 0.30, "consistency": 0.25, "validity": 0.25, "uniqueness": 0.20}
CONSISTENCY_CAP = 25.0
VALIDITY_CAP = 20.0
SCORES = ("overall", "completeness", "consistency", "validity", "uniqueness")
CHECKS = (
    "no_missing_values",
    "no_duplicate_rows",
    "no_negative_numeric_values",
    "no_empty_rows",
    "no_empty_columns",
    "date_values_parseable",
)
# ---------------------------------------------------------------------------


def _totals(df: DataFrame, want: list[str], duplicates: bool) -> DataFrame:
    """Column facts folded into one row of table totals."""
    found = facts.column_facts(df, want, empty_rows="all_dates" in want)
    if duplicates:
        found = found.unionByName(duplicate_total(df), allowMissingColumns=True)
    rows = F.col("rows")
    is_text = F.col("kind") == facts.TEXT
    folded = {
        "nulls": [
            F.sum("nulls").alias("missing"),
            F.count_if(F.col("nulls") == rows).alias("empty_columns"),
        ],
        "padded": [
            F.coalesce(F.sum("padded"), F.lit(0)).alias("padded"),
            F.coalesce(F.sum(F.when(is_text, rows)), F.lit(0)).alias("text_cells"),
        ],
        "negatives": [
            F.coalesce(F.sum("negatives"), F.lit(0)).alias("negatives"),
            # ``least`` skips NULL, so columns without the count must be left out first
            F.coalesce(
                F.sum(
                    F.when(
                        F.col("negatives").isNotNull(), F.least(F.lit(VALIDITY_CAP), percent(F.col("negatives"), rows))
                    )
                ),
                F.lit(0.0),
            ).alias("validity_loss"),
        ],
        "all_dates": [
            F.coalesce(F.bool_and("all_dates"), F.lit(True)).alias("dates_ok"),
            F.max("empty_rows").alias("empty_rows"),
        ],
    }
    return found.agg(
        F.max("rows").alias("rows"),
        F.count("ordinal").alias("columns"),
        *[agg for statistic in want for agg in folded[statistic]],
        *([F.max("duplicates").alias("duplicates")] if duplicates else []),
    )


def _completeness() -> Column:
    cells = F.col("rows") * F.col("columns")
    return round_even((F.lit(1.0) - F.col("missing") / cells) * 100.0, 1)


def _uniqueness() -> Column:
    return round_even((F.lit(1.0) - F.col("duplicates") / F.col("rows")) * 100.0, 1)


def _consistency() -> Column:
    return F.lit(100.0) - F.least(F.lit(CONSISTENCY_CAP), percent(F.col("padded"), F.col("text_cells")))


def _validity() -> Column:
    return F.lit(100.0) - F.col("validity_loss")


def _or_zero(score: Column) -> Column:
    """Scores of a table without rows are 0."""
    return F.when(F.col("rows") > 0, score).otherwise(F.lit(0.0))


def _score_columns() -> list[Column]:
    # the weighted sum takes completeness and uniqueness as rounded, the other two as they are
    overall = (
        F.lit(WEIGHTS["completeness"]) * _completeness()
        + F.lit(WEIGHTS["consistency"]) * _consistency()
        + F.lit(WEIGHTS["validity"]) * _validity()
        + F.lit(WEIGHTS["uniqueness"]) * _uniqueness()
    )
    values = (
        round_even(overall, 1),
        _completeness(),
        round_even(_consistency(), 1),
        round_even(_validity(), 1),
        _uniqueness(),
    )
    return [_or_zero(value).alias(name) for name, value in zip(SCORES, values)]


def completeness(df: DataFrame) -> DataFrame:
    """Share of cells that hold a value, in percent."""
    return _totals(df, ["nulls"], duplicates=False).select(_or_zero(_completeness()).alias("completeness"))


def uniqueness(df: DataFrame) -> DataFrame:
    """Share of rows left after removing copies, in percent."""
    totals = duplicate_total(df).unionByName(df.agg(F.count("*").alias("rows")), allowMissingColumns=True)
    return totals.agg(F.max("duplicates").alias("duplicates"), F.max("rows").alias("rows")).select(
        _or_zero(_uniqueness()).alias("uniqueness")
    )


def consistency(df: DataFrame) -> DataFrame:
    """100 less the share of padded text cells, at most 25 points less."""
    return _totals(df, ["padded"], duplicates=False).select(
        _or_zero(round_even(_consistency(), 1)).alias("consistency")
    )


def validity(df: DataFrame) -> DataFrame:
    """100 less, per numeric column, the share of negative values (20 points at most each)."""
    return _totals(df, ["negatives"], duplicates=False).select(_or_zero(round_even(_validity(), 1)).alias("validity"))


def quality(df: DataFrame) -> DataFrame:
    """One row: overall, completeness, consistency, validity, uniqueness."""
    return _totals(df, ["nulls", "padded", "negatives"], duplicates=True).select(*_score_columns())


def quality_lift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Scores of two states of a table in long form: ``metric, before, after, lift``."""

    def long(df: DataFrame, label: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(s).alias("metric"), F.col(s).alias(label)) for s in SCORES])
        return quality(df).select(F.inline(pairs))

    both = long(before, "before").unionByName(long(after, "after"), allowMissingColumns=True)
    scores = both.groupBy("metric").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    return scores.withColumn("lift", round_even(F.col("after") - F.col("before"), 1))


def validate(df: DataFrame) -> DataFrame:
    """One row: ``validated``, six checks, ``issues`` (names of failed checks),
    rows, columns and the five quality scores."""
    totals = _totals(df, ["nulls", "padded", "negatives", "all_dates"], duplicates=True)
    passed = {
        "no_missing_values": F.col("missing") == 0,
        "no_duplicate_rows": F.col("duplicates") == 0,
        "no_negative_numeric_values": F.col("negatives") == 0,
        "no_empty_rows": F.col("empty_rows") == 0,
        # a column of a table without rows counts as empty
        "no_empty_columns": F.col("empty_columns") == 0,
        "date_values_parseable": F.col("dates_ok"),
    }
    checked = totals.select("rows", "columns", *_score_columns(), *[passed[c].alias(c) for c in CHECKS])
    issues = F.array_compact(F.array(*[F.when(~F.col(c), F.lit(c)) for c in CHECKS]))
    return checked.withColumn("issues", issues).withColumn("validated", F.size("issues") == 0)


