"""Queries over model evaluation whose results SQL can recompute, and files read in blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyspark.functions import names
from tidyspark.functions.numbers import round_even
from tidyspark.operators import evaluation
from tidyspark.queries.base import query, sql_round, table
from tidyspark.session import scratch_path
from tidyspark.sources import readers, records


@query(
    "model_folds",
    """SELECT c_custkey, c_mktsegment, ((row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) % 5)::INTEGER AS fold
FROM customer""",
)
def model_folds(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return evaluation.deal_folds(customers, "c_mktsegment", ["c_custkey"])


_CENTRED = """WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice) AS my FROM lineitem),
s AS (SELECT sum((l_quantity - mx) * (l_quantity - mx)) + 1.0 AS xx, sum((l_discount - mz) * (l_discount - mz)) + 1.0 AS zz,
  sum((l_quantity - mx) * (l_discount - mz)) AS xz, sum((l_quantity - mx) * (l_extendedprice - my)) AS xy,
  sum((l_discount - mz) * (l_extendedprice - my)) AS zy FROM lineitem, m),
b AS (SELECT (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM s)"""


@query(
    "model_ridge",
    f"""{_CENTRED}
SELECT 'intercept' AS term, {sql_round("my - bx * mx - bz * mz", 4)} AS coefficient FROM b, m
UNION ALL SELECT 'l_quantity', {sql_round("bx", 4)} FROM b UNION ALL SELECT 'l_discount', {sql_round("bz", 4)} FROM b""",
)
def model_ridge(spark, sf_dir):
    fitted = evaluation.ridge(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice")
    return fitted.select("term", round_even(F.col("coefficient"), 4).alias("coefficient"))


@query(
    "model_features",
    """SELECT column_name AS feature, "rows" FROM (SELECT count(l_quantity) AS l_quantity, count(l_extendedprice) AS l_extendedprice,
  count(l_discount) AS l_discount, count(l_tax) AS l_tax, count(l_linestatus) AS l_linestatus FROM lineitem)
UNPIVOT ("rows" FOR column_name IN (l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus))""",
)
def model_features(spark, sf_dir):
    """The columns a model of the return flag is trained on, and how many rows have a value."""
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_returnflag"
    )
    chosen = names.model_features(lineitem.columns, "l_returnflag")
    counted = lineitem.agg(*[F.count(c).alias(c) for c in chosen])
    return counted.unpivot([], chosen, "feature", "rows")


@query(
    "scan_csv_broken_lines",
    "SELECT o_orderkey, o_orderstatus || chr(10) || '\"' || o_orderpriority || '\",' || chr(10) AS note, o_totalprice FROM orders",
)
def scan_csv_broken_lines(spark, sf_dir):
    """A file whose quoted values hold quotes, commas and line breaks, read in blocks."""
    note = F.concat("o_orderstatus", F.lit('\n"'), "o_orderpriority", F.lit('",\n'))
    path = scratch_path(spark, "notes") + ".csv"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", note.alias("note"), "o_totalprice")
    orders.write.options(header="true", escape='"', ignoreTrailingWhiteSpace="false").csv(path)
    return readers.promote_types(records.read_broken_csv(spark, path))


@query(
    "scan_json_array",
    """SELECT o_orderkey, o_orderstatus || '}' || chr(10) || '\"' || o_orderpriority || '[{' AS note, o_totalprice FROM orders""",
)
def scan_json_array(spark, sf_dir):
    """Files of one JSON array each, whose texts hold brackets, quotes and line breaks, read in blocks."""
    note = F.concat("o_orderstatus", F.lit('}\n"'), "o_orderpriority", F.lit("[{"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", note.alias("note"), "o_totalprice")
    # Ranges of keys are the files; a file ends with its range, so their number grows with the table.
    arrays = orders.groupBy(F.floor(F.col("o_orderkey") / 50_000).alias("range")).agg(
        F.to_json(F.collect_list(F.struct(*orders.columns))).alias("value")
    )
    path = scratch_path(spark, "array") + ".json"
    arrays.write.partitionBy("range").text(path)
    return readers.read_json(spark, path)
