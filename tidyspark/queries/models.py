"""Queries over model scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyspark.functions.numbers import round_even
from tidyspark.operators import features, knn
from tidyspark.operators import models as m
from tidyspark.queries.base import query, sql_round, table

_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus")


def _returns(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*_FEATURES, "l_returnflag")


def _customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal", "c_mktsegment")


@query(
    "model_task",
    """SELECT 'l_returnflag' AS target, 'classification' AS task
UNION ALL SELECT 'l_quantity', CASE WHEN count(DISTINCT l_quantity) <= 8 THEN 'classification' ELSE 'regression' END FROM lineitem
UNION ALL SELECT 'l_linenumber', CASE WHEN count(DISTINCT l_linenumber) <= 8 THEN 'classification' ELSE 'regression' END FROM lineitem
UNION ALL SELECT 'l_tax', CASE WHEN count(DISTINCT l_tax) <= 8 THEN 'classification' ELSE 'regression' END FROM lineitem
UNION ALL SELECT 'l_extendedprice', CASE WHEN count(DISTINCT l_extendedprice) <= 8 THEN 'classification' ELSE 'regression' END FROM lineitem""",
)
def model_task(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    targets = ("l_returnflag", "l_quantity", "l_linenumber", "l_tax", "l_extendedprice")
    return spark.createDataFrame([(t, m.model_task(lineitem, t)) for t in targets], "target string, task string")


@query("model_rf")
def model_rf(spark, sf_dir):
    return m.benchmark(_returns(spark, sf_dir), "l_returnflag", "random_forest")


@query("model_gbt")
def model_gbt(spark, sf_dir):
    return m.benchmark(_returns(spark, sf_dir), "l_linestatus", "xgboost")


@query("model_linear")
def model_linear(spark, sf_dir):
    return m.benchmark(_returns(spark, sf_dir), "l_extendedprice", "logistic_regression")


@query("model_knn")
def model_knn(spark, sf_dir):
    return m.benchmark(_customers(spark, sf_dir), "c_mktsegment", "knn")


@query(
    "knn_vote",
    """WITH codes AS (SELECT c_mktsegment, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::DOUBLE AS label
  FROM (SELECT DISTINCT c_mktsegment FROM customer)),
pairs AS (SELECT s_suppkey, label, row_number() OVER (PARTITION BY s_suppkey ORDER BY
    (c_acctbal - s_acctbal) * (c_acctbal - s_acctbal) + (c_nationkey - s_nationkey) * (c_nationkey - s_nationkey), label) AS place
  FROM supplier, customer JOIN codes USING (c_mktsegment)),
votes AS (SELECT s_suppkey, label, count(*) AS weight FROM pairs WHERE place <= 3 GROUP BY s_suppkey, label)
SELECT s_suppkey AS query, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY weight DESC, label) AS r FROM votes) WHERE r = 1""",
)
def knn_vote(spark, sf_dir):
    """The market segment most common among the three customers nearest to each supplier."""
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    segments = features.categories(customers, ["c_mktsegment"])["c_mktsegment"]
    label = F.array_position(F.array(*[F.lit(s) for s in segments]), F.col("c_mktsegment")).cast("double") - 1.0
    train = customers.select(F.array("c_acctbal", F.col("c_nationkey").cast("double")).alias("vector"), label.alias("label"))
    asked = suppliers.select(
        F.col("s_suppkey").alias("query"), F.array("s_acctbal", F.col("s_nationkey").cast("double")).alias("vector")
    )
    return knn.vote(knn.nearest(train, asked, m.NEIGHBOURS))


@query("model_lift")
def model_lift(spark, sf_dir):
    """Score and lift of every family on one target: the quality label of documents."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    df = documents.join(labels, "doc_id").drop("doc_id")
    return reduce(DataFrame.unionByName, [m.benchmark(df, "quality", family) for family in m.FAMILIES])


@query(
    "metric_macro_f1",
    f"""WITH scored AS (SELECT l_returnflag AS label, CASE WHEN l_linestatus = 'O' THEN 'N' WHEN l_quantity > 25 THEN 'R' ELSE 'A' END AS prediction FROM lineitem),
classes AS (SELECT label AS c FROM scored UNION SELECT prediction FROM scored),
f AS (SELECT c, 2.0::DOUBLE * count_if(label = c AND prediction = c) / (count_if(label = c) + count_if(prediction = c)) AS f1 FROM classes, scored GROUP BY c)
SELECT {sql_round("avg(f1)", 6)} AS macro_f1 FROM f""",
)
def metric_macro_f1(spark, sf_dir):
    guess = F.when(F.col("l_linestatus") == "O", "N").when(F.col("l_quantity") > 25, "R").otherwise("A")
    scored = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label"), guess.alias("prediction"))
    return m.macro_f1(scored).select(round_even(F.col("macro_f1"), 6).alias("macro_f1"))


@query(
    "metric_r2",
    f"""WITH scored AS (SELECT l_extendedprice AS y, l_quantity * 1500.0::DOUBLE AS p FROM lineitem)
SELECT {sql_round("1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(y))", 6)} AS r2 FROM scored""",
)
def metric_r2(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500.0).alias("prediction")
    )
    return m.r2(scored).select(round_even(F.col("r2"), 6).alias("r2"))
