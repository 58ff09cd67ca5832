"""Queries over table questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyspark.functions.numbers import round_even
from tidyspark.functions.text import WHITESPACE
from tidyspark.operators import ask as a
from tidyspark.queries.base import query, sql_list, sql_round, sql_text, table

_SPACE = sql_text(WHITESPACE)
_PART = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query(
    "lookup_exact",
    f"""WITH found AS (SELECT * FROM part WHERE upper(trim(p_type, {_SPACE})) = 'ECONOMY')
SELECT *, (SELECT count(*) FROM found) AS total_matches FROM found ORDER BY p_partkey LIMIT 10""",
)
def lookup_exact(spark, sf_dir):
    return a.lookup_exact(table(spark, sf_dir, "part"), "p_type", "economy", ["p_partkey"])


@query(
    "lookup_exact_falls_back",
    """WITH found AS (SELECT * FROM part WHERE contains(lower(p_name), 'widg'))
SELECT *, (SELECT count(*) FROM found) AS total_matches FROM found ORDER BY p_partkey LIMIT 10""",
)
def lookup_exact_falls_back(spark, sf_dir):
    return a.lookup_exact(table(spark, sf_dir, "part"), "p_name", "Widg", ["p_partkey"])


@query(
    "lookup_contains",
    """WITH found AS (SELECT * FROM part WHERE contains(lower(p_brand), 'brand#1'))
SELECT *, (SELECT count(*) FROM found) AS total_matches FROM found ORDER BY p_partkey LIMIT 10""",
)
def lookup_contains(spark, sf_dir):
    return a.lookup_contains(table(spark, sf_dir, "part"), "p_brand", "BRAND#1", ["p_partkey"])


def _group_sql(direction: str, nulls: str) -> str:
    return (
        f"SELECT o_orderpriority, {sql_round('sum(o_totalprice)', 2)} AS total_o_totalprice FROM orders "
        f"GROUP BY o_orderpriority ORDER BY sum(o_totalprice) {direction} NULLS {nulls}, o_orderpriority LIMIT 5"
    )


def _rounded_total(df):
    return df.withColumn("total_o_totalprice", round_even(F.col("total_o_totalprice"), 2))


@query("group_total_top5", _group_sql("DESC", "LAST"))
def group_total_top5(spark, sf_dir):
    return _rounded_total(a.group_total(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice"))


@query("group_total_bottom5", _group_sql("ASC", "FIRST"))
def group_total_bottom5(spark, sf_dir):
    return _rounded_total(a.group_total(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", lowest=True))


@query(
    "group_total_guessed",
    f"""SELECT c_mktsegment, sum(c_custkey)::BIGINT AS total_c_custkey FROM customer
GROUP BY c_mktsegment ORDER BY 2 DESC NULLS LAST, 1 LIMIT 5""",
)
def group_total_guessed(spark, sf_dir):
    """Neither the group nor the metric is named: both come from the schema."""
    return a.group_total(table(spark, sf_dir, "customer"))


@query("extreme_rows_max", "SELECT * FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 5")
def extreme_rows_max(spark, sf_dir):
    return a.extreme_rows(table(spark, sf_dir, "customer"), ["c_custkey"], "c_acctbal")


@query("extreme_rows_min", "SELECT * FROM customer ORDER BY c_acctbal ASC NULLS FIRST, c_custkey LIMIT 5")
def extreme_rows_min(spark, sf_dir):
    return a.extreme_rows(table(spark, sf_dir, "customer"), ["c_custkey"], "c_acctbal", lowest=True)


@query("tail_rows", "SELECT * FROM events ORDER BY event_id DESC NULLS LAST LIMIT 7")
def tail_rows(spark, sf_dir):
    return a.tail_rows(table(spark, sf_dir, "events"), ["event_id"], 7)


@query("head_rows", "SELECT * FROM events ORDER BY event_id NULLS FIRST LIMIT 200")
def head_rows(spark, sf_dir):
    return a.head_rows(table(spark, sf_dir, "events"), ["event_id"], 200)


@query("avg_column", f"SELECT {sql_round('avg(value)', 6)} AS avg_value FROM events")
def avg_column(spark, sf_dir):
    return a.average(table(spark, sf_dir, "events"), "value").select(round_even(F.col("avg_value"), 6).alias("avg_value"))


_LINE_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)


@query(
    "numeric_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS metric_column, {sql_round(f'avg({c}::DOUBLE)', 2)} AS average_mean, "
        f"{sql_round(f'min({c})', 2)} AS minimum_value, {sql_round(f'max({c})', 2)} AS maximum_value, "
        f"{sql_round(f'quantile_cont({c}::DOUBLE, 0.5)', 2)} AS median_value FROM lineitem"
        for c in _LINE_NUMBERS
    ),
)
def numeric_summary(spark, sf_dir):
    return a.numeric_summary(table(spark, sf_dir, "lineitem"))


@query(
    "table_size",
    "SELECT count(*) AS total_rows, 6 AS total_columns, 3 AS numeric_columns_count, 3 AS dimension_columns_count FROM orders",
)
def table_size(spark, sf_dir):
    return a.table_size(table(spark, sf_dir, "orders"))


_ORDER_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


@query(
    "schema_report",
    " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null_count, "
        f"count(*) - count({c}) AS null_count FROM orders"
        for i, (c, t) in enumerate(_ORDER_TYPES.items(), start=1)
    ),
)
def schema_report(spark, sf_dir):
    return a.schema_report(table(spark, sf_dir, "orders"))


def _has(words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(asked, {sql_text(w)})" for w in words) + ")"


def _value_sql(columns) -> str:
    def extracted(pattern: str) -> str:
        asked = f"trim(regexp_extract(spoken, {sql_text(a.value_pattern(pattern, columns))}, 1), {_SPACE})"
        return f"trim(regexp_replace({asked}, {sql_text(a.VALUE_TAIL)}, ''), {_SPACE})"

    return " OR ".join(
        f"({extracted(p)} <> '' AND {extracted(p)} NOT IN ({sql_list(a.NO_VALUE)}))" for p in a.VALUE_QUESTIONS
    )


_ORDERS = tuple(_ORDER_TYPES)


@query(
    "question_intents",
    f"""WITH q AS (SELECT *, lower(trim(text, {_SPACE})) AS asked, replace(lower(trim(text, {_SPACE})), '_', ' ') AS spoken
  FROM conversations)
SELECT conv_id, turn, role, text, CASE
  WHEN {_value_sql(_ORDERS)} THEN 'value_lookup'
  WHEN {_has(a.GROUP_WORDS)} THEN 'group_total'
  WHEN {_has(a.EXTREME_WORDS)} THEN 'extreme_rows'
  WHEN {_has(a.TAIL_WORDS)} THEN 'tail_rows'
  WHEN ({_has(a.HEAD_WORDS)} AND {_has(a.HEAD_OBJECTS)}) OR asked IN ({sql_list(a.HEAD_QUESTIONS)}) THEN 'head_rows'
  WHEN {_has(a.AVERAGE_WORDS)} THEN 'average'
  WHEN {_has(a.SIZE_WORDS)} THEN 'table_size'
  WHEN {_has(a.SCHEMA_WORDS)} THEN 'schema_report'
  WHEN {_has(a.LINEAGE_WORDS)} THEN 'lineage_report'
  ELSE 'first_rows' END AS intent
FROM q""",
)
def question_intents(spark, sf_dir):
    return a.question_intents(table(spark, sf_dir, "conversations"), "text", table(spark, sf_dir, "orders"))
