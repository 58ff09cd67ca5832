"""Queries over profiles."""

from __future__ import annotations

from tidyspark.functions.text import FALSE_WORDS, NUMBER_PATTERN, TRUE_WORDS, WHITESPACE
from tidyspark.operators import profile as p
from tidyspark.queries.base import (
    UNTIDY_COLUMNS,
    UNTIDY_CTE,
    UNTIDY_TEXT,
    query,
    sql_list,
    sql_round,
    sql_text,
    table,
    untidy,
)

_SPACE = sql_text(WHITESPACE)


def number_sql(column: str) -> str:
    plain = f"trim(translate(trim({column}, {_SPACE}), '$,', ''), {_SPACE})"
    return f"CASE WHEN regexp_matches({plain}, {sql_text(NUMBER_PATTERN)}) THEN try_cast({plain} AS DOUBLE) END"


def boolean_sql(column: str) -> str:
    return f"lower(trim({column}, {_SPACE})) IN ({sql_list(TRUE_WORDS + FALSE_WORDS)})"


def _each(columns, select: str, source: str = "untidy", ordinals=None) -> str:
    """One SELECT per column, glued with UNION ALL; ``{c}`` and ``{i}`` are filled in."""
    ordinals = ordinals or {c: i for i, c in enumerate(UNTIDY_COLUMNS, start=1)}
    return " UNION ALL ".join(
        f"SELECT {ordinals[c]} AS ordinal, '{c}' AS name, {select.format(c=c)} FROM {source}" for c in columns
    )


@query(
    "profile_table",
    f"""{UNTIDY_CTE}
SELECT count(*) AS rows, 8::BIGINT AS columns,
  ({" + ".join(f"count_if({c} IS NULL)" for c in UNTIDY_COLUMNS)})::BIGINT AS missing_values,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM untidy)) AS duplicates,
  count_if({" AND ".join(f"{c} IS NULL" for c in UNTIDY_COLUMNS)})::BIGINT AS empty_rows,
  list_filter([{", ".join(f"CASE WHEN count({c}) = 0 THEN '{c}' END" for c in UNTIDY_COLUMNS)}],
    lambda n: n IS NOT NULL) AS empty_columns
FROM untidy""",
)
def profile_table(spark, sf_dir):
    return p.table_profile(untidy(spark, sf_dir))


_BASICS = (
    "{dtype} AS dtype, count_if({{c}} IS NULL)::BIGINT AS nulls, "
    + sql_round("count_if({{c}} IS NULL)::DOUBLE / count(*) * 100.0", 1)
    + " AS null_pct, count(DISTINCT {{c}}) AS unique, count({{c}}) = 0 AS empty"
)


@query(
    "profile_columns_basic",
    UNTIDY_CTE
    + " "
    + _each(UNTIDY_TEXT, _BASICS.format(dtype="'string'"))
    + " UNION ALL "
    + _each(("quantity",), _BASICS.format(dtype="'bigint'")),
)
def profile_columns_basic(spark, sf_dir):
    return p.column_basics(untidy(spark, sf_dir))


_LINEITEM = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


@query(
    "profile_columns_numeric",
    _each(
        _LINEITEM[:8],
        "min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, "
        + sql_round("avg({c}::DOUBLE)", 2)
        + " AS mean, false AS numeric_like, false AS boolean_like",
        "lineitem",
        {c: i for i, c in enumerate(_LINEITEM, start=1)},
    ),
)
def profile_columns_numeric(spark, sf_dir):
    return p.numeric_profile(table(spark, sf_dir, "lineitem"))


def _all(condition: str) -> str:
    return f"coalesce(bool_and({condition}), false)"


_NUMERIC_LIKE = f"({_all('(' + number_sql('{c}') + ') IS NOT NULL OR {c} IS NULL')} AND count({{c}}) > 0 AND NOT {_all(boolean_sql('{c}'))})"


@query("profile_boolean_like", f"{UNTIDY_CTE} {_each(UNTIDY_TEXT, _all(boolean_sql('{c}')) + ' AS boolean_like')}")
def profile_boolean_like(spark, sf_dir):
    return p.boolean_like_columns(untidy(spark, sf_dir))


@query(
    "profile_numeric_like",
    f"{UNTIDY_CTE} "
    + _each(
        UNTIDY_TEXT,
        f"{_NUMERIC_LIKE} AS numeric_like, "
        + ", ".join(
            f"CASE WHEN {_NUMERIC_LIKE} THEN {value} END AS {alias}"
            for value, alias in (
                (f"min({number_sql('{c}')})", "min"),
                (f"max({number_sql('{c}')})", "max"),
                (sql_round(f"avg({number_sql('{c}')})", 2), "mean"),
            )
        ),
    ),
)
def profile_numeric_like(spark, sf_dir):
    return p.numeric_like_columns(untidy(spark, sf_dir))


_TOP = """SELECT {i} AS ordinal, '{c}' AS name, rank, value, times FROM (
  SELECT {c} AS value, count(*) AS times, row_number() OVER (ORDER BY count(*) DESC, {c} ASC)::INTEGER AS rank
  FROM untidy WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= 3"""


@query(
    "profile_top_values",
    UNTIDY_CTE
    + " "
    + " UNION ALL ".join(_TOP.format(i=i, c=c) for i, c in enumerate(UNTIDY_COLUMNS, 1) if c != "quantity"),
)
def profile_top_values(spark, sf_dir):
    return p.top_values(untidy(spark, sf_dir))


_TOP_LIST = """(SELECT list({{'value': value, 'count': times}} ORDER BY rank) FROM (
  SELECT {c} AS value, count(*) AS times, row_number() OVER (ORDER BY count(*) DESC, {c} ASC) AS rank
  FROM untidy WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= 3)"""
_AS_NUMBERS = ", ".join(
    f"CASE WHEN {_NUMERIC_LIKE} THEN {value} END AS {alias}"
    for value, alias in (
        (f"min({number_sql('{c}')})", "min"),
        (f"max({number_sql('{c}')})", "max"),
        (sql_round(f"avg({number_sql('{c}')})", 2), "mean"),
    )
)


@query(
    "profile_columns",
    UNTIDY_CTE
    + " "
    + _each(
        UNTIDY_TEXT,
        _BASICS.format(dtype="'string'")
        + f", {_AS_NUMBERS}, {_NUMERIC_LIKE} AS numeric_like, {_all(boolean_sql('{c}'))} AS boolean_like, "
        + f"{_TOP_LIST} AS top_values",
    )
    + " UNION ALL "
    + _each(
        ("quantity",),
        _BASICS.format(dtype="'bigint'")
        + ", min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, "
        + sql_round("avg({c}::DOUBLE)", 2)
        + " AS mean, false AS numeric_like, false AS boolean_like, NULL AS top_values",
    ),
)
def profile_columns(spark, sf_dir):
    return p.column_profile(untidy(spark, sf_dir))


_ORDERS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


@query(
    "profile_columns_empty",
    " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS name, '{t}' AS dtype, count(*) - count({c}) AS nulls, "
        f"0.0::DOUBLE AS null_pct, count(DISTINCT {c}) AS unique, count({c}) = 0 AS empty FROM orders WHERE o_orderkey < 0"
        for i, (c, t) in enumerate(_ORDERS.items(), start=1)
    ),
)
def profile_columns_empty(spark, sf_dir):
    """A table that a filter has left without rows still has a line for every column."""
    return p.column_basics(table(spark, sf_dir, "orders").filter("o_orderkey < 0"))
