"""Queries over readers and writers. Files go to the session's shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyspark.plans import run as cleaning
from tidyspark.queries.base import UNTIDY_COLUMNS, UNTIDY_CTE, query, table, untidy
from tidyspark.queries.clean import TIDY_CTE
from tidyspark.session import scratch_path
from tidyspark.sources import readers, writers


@query("scan_csv_typed", f"{UNTIDY_CTE} SELECT * FROM untidy")
def scan_csv_typed(spark, sf_dir):
    path = writers.store(untidy(spark, sf_dir), scratch_path(spark, "untidy") + ".csv", "csv")
    return readers.read_table(spark, path)


@query(
    "scan_json",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders",
)
def scan_json(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    path = scratch_path(spark, "orders") + ".json"
    orders.write.json(path)
    return readers.read_table(spark, path).select(*orders.columns)


@query("require_rows", "SELECT count(*) AS rows FROM orders")
def require_rows(spark, sf_dir):
    return readers.require_rows(table(spark, sf_dir, "orders")).agg(F.count("*").alias("rows"))


@query(
    "preview_rows",
    f"""{UNTIDY_CTE} SELECT {", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in UNTIDY_COLUMNS)}
FROM (SELECT * FROM untidy ORDER BY {", ".join(f"{c} NULLS FIRST" for c in UNTIDY_COLUMNS)} LIMIT 8)""",
)
def preview_rows(spark, sf_dir):
    return readers.preview(untidy(spark, sf_dir), list(UNTIDY_COLUMNS))


@query("store_roundtrip", f"{TIDY_CTE} SELECT * FROM tidy")
def store_roundtrip(spark, sf_dir):
    cleaned = cleaning.clean(untidy(spark, sf_dir)).table
    return readers.read_table(spark, writers.store(cleaned, scratch_path(spark, "tidy") + ".parquet"))


@query("store_roundtrip_csv", f"{TIDY_CTE} SELECT * FROM tidy")
def store_roundtrip_csv(spark, sf_dir):
    cleaned = cleaning.clean(untidy(spark, sf_dir)).table
    return readers.read_table(spark, writers.store(cleaned, scratch_path(spark, "tidy") + ".csv", "csv"))


@query(
    "json_safe",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id,
  CASE WHEN event_id % 5 IN (0, 1, 2) THEN NULL ELSE value END AS value FROM events""",
)
def json_safe(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    odd = (
        F.when(F.col("event_id") % 5 == 0, float("nan"))
        .when(F.col("event_id") % 5 == 1, float("inf"))
        .when(F.col("event_id") % 5 == 2, float("-inf"))
        .otherwise(F.col("value"))
    )
    broken = events.select("event_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"), "user_id", odd.alias("value"))
    return writers.json_safe(broken)


@query(
    "column_list",
    f"{UNTIDY_CTE} "
    + " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS ordinal, '{c}' AS column_name, count({c}) AS filled FROM untidy"
        for i, c in enumerate(UNTIDY_COLUMNS, start=1)
    ),
)
def column_list(spark, sf_dir):
    """Every column, with the number of values it holds."""
    df = untidy(spark, sf_dir)
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "filled")
    return readers.column_list(df).join(filled, "column_name")
