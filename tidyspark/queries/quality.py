"""Queries over quality scores and validation."""

from __future__ import annotations

from tidyspark.functions.text import WHITESPACE
from tidyspark.operators import quality as q
from tidyspark.plans import run as cleaning
from tidyspark.queries.base import UNTIDY_COLUMNS, UNTIDY_CTE, UNTIDY_TEXT, query, sql_round, sql_text, table, untidy
from tidyspark.queries.clean import TIDY_CTE
from tidyspark.session import keep_table

_SPACE = sql_text(WHITESPACE)


def _score_ctes(source: str, prefix: str, columns, text_columns, numeric_columns) -> str:
    """CTEs ``<prefix>_scores`` with the five scores of a relation."""
    missing = " + ".join(f"count_if({c} IS NULL)" for c in columns)
    padded = " + ".join(f"coalesce(count_if({c} <> trim({c}, {_SPACE})), 0)" for c in text_columns) or "0"
    loss = " + ".join(f"least(20.0, coalesce(count_if({c} < 0), 0)::DOUBLE / count(*) * 100.0)" for c in numeric_columns) or "0.0"
    names = ", ".join(columns)
    consistency = f"100.0 - least(25.0, padded::DOUBLE / (n * {max(len(text_columns), 1)}) * 100.0)"
    return f"""
{prefix}_facts AS (
  SELECT count(*) AS n, {missing} AS missing, {padded} AS padded, {loss} AS loss FROM {source}),
{prefix}_distinct AS (SELECT count(*) AS kept FROM (SELECT DISTINCT {names} FROM {source})),
{prefix}_parts AS (
  SELECT {sql_round(f"(1.0 - missing / (n * {len(columns)})::DOUBLE) * 100.0", 1)} AS completeness,
    {sql_round("(1.0 - (n - kept) / n::DOUBLE) * 100.0", 1)} AS uniqueness,
    ({consistency})::DOUBLE AS consistency, (100.0 - loss)::DOUBLE AS validity
  FROM {prefix}_facts, {prefix}_distinct),
{prefix}_scores AS (
  SELECT {sql_round("0.30::DOUBLE * completeness + 0.25::DOUBLE * consistency + 0.25::DOUBLE * validity + 0.20::DOUBLE * uniqueness", 1)} AS overall,
    completeness, {sql_round("consistency", 1)} AS consistency, {sql_round("validity", 1)} AS validity, uniqueness
  FROM {prefix}_parts)"""


_UNTIDY_SCORES = UNTIDY_CTE + "," + _score_ctes("untidy", "raw", UNTIDY_COLUMNS, UNTIDY_TEXT, ("quantity",))


@query("quality_completeness", _UNTIDY_SCORES + " SELECT completeness FROM raw_scores")
def quality_completeness(spark, sf_dir):
    return q.completeness(untidy(spark, sf_dir))


@query("quality_uniqueness", _UNTIDY_SCORES + " SELECT uniqueness FROM raw_scores")
def quality_uniqueness(spark, sf_dir):
    return q.uniqueness(untidy(spark, sf_dir))


@query("quality_consistency", _UNTIDY_SCORES + " SELECT consistency FROM raw_scores")
def quality_consistency(spark, sf_dir):
    return q.consistency(untidy(spark, sf_dir))


@query("quality_validity", _UNTIDY_SCORES + " SELECT validity FROM raw_scores")
def quality_validity(spark, sf_dir):
    return q.validity(untidy(spark, sf_dir))


@query("quality_score", _UNTIDY_SCORES + " SELECT * FROM raw_scores")
def quality_score(spark, sf_dir):
    return q.quality(untidy(spark, sf_dir))


@query(
    "quality_score_customer",
    "WITH "
    + _score_ctes(
        "customer",
        "raw",
        ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
        ("c_name", "c_mktsegment"),
        ("c_custkey", "c_nationkey", "c_acctbal"),
    ).strip()
    + " SELECT * FROM raw_scores",
)
def quality_score_customer(spark, sf_dir):
    return q.quality(table(spark, sf_dir, "customer"))


_TIDY_COLUMNS = tuple(c for c in UNTIDY_COLUMNS if c != "unused_notes")
_TIDY_TEXT = ("order_id", "order_date", "approved", "region", "priority")


def score_ctes(opening: str) -> str:
    """Scores of the untidy and the cleaned table behind CTEs that define both."""
    raw = _score_ctes("untidy", "raw", UNTIDY_COLUMNS, UNTIDY_TEXT, ("quantity",))
    tidied = _score_ctes("tidy", "tidied", _TIDY_COLUMNS, _TIDY_TEXT, ("quantity", "total_price"))
    return f"{opening},{raw},{tidied}"


@query(
    "quality_lift",
    score_ctes(TIDY_CTE)
    + " "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS metric, r.{s} AS before, t.{s} AS after, {sql_round(f't.{s} - r.{s}', 1)} AS lift"
        " FROM raw_scores r, tidied_scores t"
        for s in q.SCORES
    ),
)
def quality_lift(spark, sf_dir):
    df = untidy(spark, sf_dir)
    return q.quality_lift(df, keep_table(cleaning.clean(df).table))


def _validate_sql(cte: str, source: str, columns, text_columns, numeric_columns, dates_ok: str) -> str:
    any_missing = " OR ".join(f"{c} IS NULL" for c in columns)
    all_missing = " AND ".join(f"{c} IS NULL" for c in columns)
    negative = " OR ".join(f"{c} < 0" for c in numeric_columns)
    empty = " OR ".join(f"count({c}) = 0" for c in columns)
    issues = ", ".join(f"CASE WHEN NOT {c} THEN '{c}' END" for c in q.CHECKS)
    return f"""{cte},{_score_ctes(source, "raw", columns, text_columns, numeric_columns)},
checks AS (
  SELECT count(*) AS rows, {len(columns)}::BIGINT AS columns,
    count_if({any_missing}) = 0 AS no_missing_values,
    count(*) = (SELECT kept FROM raw_distinct) AS no_duplicate_rows,
    count_if({negative}) = 0 AS no_negative_numeric_values,
    count_if({all_missing}) = 0 AS no_empty_rows,
    NOT ({empty}) AS no_empty_columns,
    {dates_ok} AS date_values_parseable
  FROM {source})
SELECT rows, columns, raw_scores.*, {", ".join(q.CHECKS)},
  list_filter([{issues}], lambda i: i IS NOT NULL) AS issues,
  len(list_filter([{issues}], lambda i: i IS NOT NULL)) = 0 AS validated
FROM checks, raw_scores"""


@query(
    "validate_report",
    _validate_sql(
        UNTIDY_CTE,
        "untidy",
        UNTIDY_COLUMNS,
        UNTIDY_TEXT,
        ("quantity",),
        "count_if(order_date IS NOT NULL AND coalesce("
        + ", ".join(f"try_strptime(order_date, '{f}')" for f in ("%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%B %-d %Y"))
        + ") IS NULL) = 0",
    ),
)
def validate_report(spark, sf_dir):
    return q.validate(untidy(spark, sf_dir))


@query(
    "validate_report_tidy",
    _validate_sql(
        TIDY_CTE,
        "tidy",
        _TIDY_COLUMNS,
        _TIDY_TEXT,
        ("quantity", "total_price"),
        "count_if(order_date IS NOT NULL AND try_strptime(order_date, '%Y-%m-%d') IS NULL) = 0",
    ),
)
def validate_report_tidy(spark, sf_dir):
    return q.validate(keep_table(cleaning.clean(untidy(spark, sf_dir)).table))
