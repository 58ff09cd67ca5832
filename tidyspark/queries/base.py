"""Registration of queries and the tables they read.

A query is a function ``(spark, sf_dir) -> DataFrame``; its check is the same
question as DuckDB SQL over views with the tables' names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# An untidy copy of ``orders``: mixed date formats, money as text, boolean words,
# padded and missing regions, negative and missing quantities, copies, empty rows
# and an empty column. Only the four date formats are spelled differently per engine.
_UNTIDY = """
base AS (
 SELECT 'D-' || CAST(o_orderkey AS STRING) AS order_id,
  CASE o_orderkey % 4
    WHEN 1 THEN {slash}
    WHEN 2 THEN CASE WHEN day(o_orderdate) > 12 THEN {dmy} ELSE {iso} END
    WHEN 3 THEN {long} ELSE {iso} END AS order_date,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL
       WHEN o_orderkey % 7 = 0 THEN -(o_orderkey % 5) - 1
       ELSE o_orderkey % 10 END AS quantity,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL
       ELSE '$' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS total_price,
  CASE o_orderkey % 8 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'TRUE'
    WHEN 3 THEN 'FALSE' WHEN 4 THEN '1' WHEN 5 THEN '0' WHEN 6 THEN ' Y '
    ELSE 'n' END AS approved,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'us'
    WHEN o_orderkey % 5 = 1 THEN ' US ' WHEN o_orderkey % 5 = 2 THEN 'uk'
    WHEN o_orderkey % 5 = 3 THEN 'ca' ELSE '  ind ' END AS region,
  ' ' || lower(o_orderpriority) || ' ' AS priority,
  CAST(NULL AS STRING) AS unused_notes, o_orderkey AS k
 FROM {orders}),
untidy AS (
 SELECT order_id, order_date, quantity, total_price, approved, region, priority, unused_notes FROM base
 UNION ALL
 SELECT order_id, order_date, quantity, total_price, approved, region, priority, unused_notes FROM base WHERE k % 97 = 0
 UNION ALL
 SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM {region})
"""
_SPARK_DATES = {
    "iso": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "slash": "date_format(o_orderdate, 'yyyy/MM/dd')",
    "dmy": "date_format(o_orderdate, 'dd-MM-yyyy')",
    "long": "date_format(o_orderdate, 'MMMM d yyyy')",
}
_DUCK_DATES = {
    "iso": "strftime(o_orderdate, '%Y-%m-%d')",
    "slash": "strftime(o_orderdate, '%Y/%m/%d')",
    "dmy": "strftime(o_orderdate, '%d-%m-%Y')",
    "long": "strftime(o_orderdate, '%B %-d %Y')",
}

# Common table expressions that open every check on the untidy table.
UNTIDY_CTE = "WITH " + _UNTIDY.format(**_DUCK_DATES, orders="orders", region="region").strip()

UNTIDY_COLUMNS = (
    "order_id", "order_date", "quantity", "total_price", "approved", "region", "priority", "unused_notes",
)
UNTIDY_TEXT = tuple(c for c in UNTIDY_COLUMNS if c != "quantity")


def untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "WITH " + _UNTIDY.format(**_SPARK_DATES, orders="{orders}", region="{region}") + "SELECT * FROM untidy"
    return spark.sql(text, orders=table(spark, sf_dir, "orders"), region=table(spark, sf_dir, "region"))


# ---- SQL fragments shared by the checks ------------------------------------


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values: tuple[str, ...] | list[str]) -> str:
    return ", ".join(sql_text(v) for v in values)


def sql_round(expression: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"(round_even(({expression})::DOUBLE * {scale}, 0) / {scale})"
