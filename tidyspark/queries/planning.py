"""Queries over plans, the audit trail and run histories."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidyspark.operators.ask import lineage_report as lineage
from tidyspark.operators.quality import quality_lift
from tidyspark.plans import audit, planner, run
from tidyspark.queries.base import UNTIDY_COLUMNS, UNTIDY_CTE, UNTIDY_TEXT, query, sql_round, table, untidy
from tidyspark.queries.clean import TIDY_CTE
from tidyspark.queries.profile import boolean_sql, number_sql
from tidyspark.queries.quality import score_ctes
from tidyspark.session import keep_table


def _seen_cte(opening: str = UNTIDY_CTE) -> str:
    """One row with everything the plan depends on, worked out by SQL."""
    boolean = {c: f"coalesce(bool_and({boolean_sql(c)}), false)" for c in UNTIDY_TEXT}
    numeric = {
        c: f"(count({c}) > 0 AND coalesce(bool_and(({number_sql(c)}) IS NOT NULL OR {c} IS NULL), false) AND NOT {boolean[c]})"
        for c in UNTIDY_TEXT
    }
    lows = [f"CASE WHEN {numeric[c]} AND min({number_sql(c)}) < 0 THEN '{c}' END" for c in UNTIDY_TEXT]
    lows.insert(2, "CASE WHEN min(quantity) < 0 THEN 'quantity' END")

    def listed(entries: list[str]) -> str:
        return f"array_to_string(list_filter([{', '.join(entries)}], lambda n: n IS NOT NULL), ', ')"

    return f"""{opening},
seen AS (SELECT
  count_if({" AND ".join(f"{c} IS NULL" for c in UNTIDY_COLUMNS)}) AS empty_rows,
  {listed([f"CASE WHEN count({c}) = 0 THEN '{c}' END" for c in UNTIDY_COLUMNS])} AS empty_columns,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM untidy)) AS duplicates,
  {listed([f"CASE WHEN {numeric[c]} THEN '{c}' END" for c in UNTIDY_TEXT])} AS numbers,
  {listed([f"CASE WHEN {boolean[c]} THEN '{c}' END" for c in UNTIDY_TEXT])} AS booleans,
  {" + ".join(f"count_if({c} IS NULL)" for c in UNTIDY_COLUMNS)} AS missing,
  {listed(lows)} AS negatives
FROM untidy),
"""


_CLEANING = (
    ("empty_rows > 0", "remove_empty_rows", "NULL", "empty_rows || ' rows hold no value'"),
    ("empty_columns <> ''", "remove_empty_columns", "NULL", "'no values in ' || empty_columns"),
    ("duplicates > 0", "remove_duplicates", "NULL", "duplicates || ' rows repeat another row'"),
    ("numbers <> ''", "coerce_numeric_columns", "NULL", "'numbers held as text in ' || numbers"),
    ("booleans <> ''", "normalize_boolean_columns", "NULL", "'boolean words in ' || booleans"),
    ("missing > 0", "fill_missing", "'median/mode'", "missing || ' cells hold no value'"),
    ("negatives <> ''", "correct_negative_values", "NULL", "'negative numbers in ' || negatives"),
    ("true", "normalize_strings", "NULL", "'padding and letter case may differ in text columns'"),
    ("true", "standardize_dates", "NULL", "'dates in order_date'"),
)
_CLOSING = (
    ("true", "validate", "NULL", "'check the result'"),
    ("true", "store", "NULL", "'keep the result'"),
)


def _plan_sql(extra: tuple = (), model: str | None = None) -> str:
    rules = _CLEANING + extra + _CLOSING
    picked = " UNION ALL ".join(
        f"SELECT {i} AS place, '{name}' AS operation, {method}::VARCHAR AS method, {reason} AS reason FROM seen WHERE {needed}"
        for i, (needed, name, method, reason) in enumerate(rules)
    )
    label = f"'{model}' AS model, " if model else ""
    return (
        f"picked_{model} AS ({picked}), plan_{model} AS (SELECT {label}row_number() OVER (ORDER BY place)::INTEGER AS step, "
        f"operation, method, reason FROM picked_{model})"
    )


@query("plan_steps", _seen_cte() + _plan_sql() + " SELECT * FROM plan_None")
def plan_steps(spark, sf_dir):
    return planner.plan_frame(spark, planner.build_plan(planner.snapshot(untidy(spark, sf_dir))))


def _scaled(family: str, scaling: str) -> tuple:
    return (
        ("true", "clip_outliers", "NULL", f"'extreme values distort {family}'"),
        ("true", "scale_features", f"'{scaling}'", f"'{family} compares columns by size'"),
        ("true", "encode_categoricals", "'onehot'", f"'{family} needs numbers without an order'"),
    )


_FAMILIES = {
    "logistic_regression": _scaled("logistic_regression", "standard"),
    "linear_regression": _scaled("linear_regression", "standard"),
    "knn": _scaled("knn", "minmax"),
    "random_forest": (("true", "encode_categoricals", "'ordinal'", "'random_forest splits on codes'"),),
    "xgboost": (("true", "encode_categoricals", "'ordinal'", "'xgboost splits on codes'"),),
    "generic": (),
}


@query(
    "plan_steps_model_aware",
    _seen_cte()
    + ", ".join(_plan_sql(extra, family) for family, extra in _FAMILIES.items())
    + " "
    + " UNION ALL ".join(f"SELECT * FROM plan_{family}" for family in _FAMILIES),
)
def plan_steps_model_aware(spark, sf_dir):
    seen = planner.snapshot(untidy(spark, sf_dir))
    frames = [
        planner.plan_frame(spark, planner.build_plan(seen, family)).withColumn("model", F.lit(family))
        for family in _FAMILIES
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _counted(names: str) -> str:
    return f"(CASE WHEN {names} = '' THEN 0 ELSE len(string_split({names}, ', ')) END)"


@query(
    "plan_summary",
    _seen_cte().rstrip().rstrip(",")
    + f""" SELECT '8 columns, ' || missing || ' missing values, ' || duplicates || ' duplicate rows, '
  || {_counted("numbers")} || ' numeric-like, ' || {_counted("booleans")} || ' boolean-like and 1 date-like columns; '
  || 'model random forest, target approved' AS summary FROM seen""",
)
def plan_summary(spark, sf_dir):
    seen = planner.snapshot(untidy(spark, sf_dir))
    return spark.createDataFrame([(planner.plan_summary(seen, "random_forest", "approved"),)], "summary string")


_AUDIT = """
SELECT 0 AS place, 'Source Analyzer' AS agent, 'Inspected source' AS action, (SELECT count(*) FROM untidy) || ' rows, 8 columns' AS reason,
  'read_table' AS tool, 'SUCCESS' AS status FROM seen
UNION ALL SELECT 1, 'Profiler', 'Profiled table', missing || ' missing values, ' || duplicates || ' duplicate rows', 'table_profile', 'SUCCESS' FROM seen
UNION ALL SELECT 2, 'Planner', 'Built plan', (SELECT count(*) FROM plan_None) || ' steps', 'build_plan', 'SUCCESS' FROM seen
UNION ALL SELECT 2 + step, CASE operation WHEN 'validate' THEN 'Validation' WHEN 'store' THEN 'Storage' ELSE 'Cleaning' END,
  operation, reason, operation, 'SUCCESS' FROM plan_None
UNION ALL SELECT 100, 'Benchmark', 'Skipped benchmark', 'no model or no target column', 'benchmark', 'SUCCESS' FROM seen"""


@query(
    "audit_log",
    _seen_cte()
    + _plan_sql()
    + f" SELECT (row_number() OVER (ORDER BY place))::INTEGER AS entry, agent, action, reason, tool, status FROM ({_AUDIT})",
)
def audit_log(spark, sf_dir):
    """Decisions of a whole run, without the ids, times and paths that differ per run."""
    result = run.run_table(untidy(spark, sf_dir), "untidy_orders")
    log = audit.run_log(result.audit, result.run_id)
    # decisions and stages share one numbering: renumber the few decisions
    entry = F.row_number().over(Window.partitionBy("run_id").orderBy("entry"))
    return log.select(entry.alias("entry"), "agent", "action", "reason", "tool", "status")


@query(
    "lineage_report",
    _seen_cte(score_ctes(TIDY_CTE))
    + _plan_sql()
    + """ SELECT 'operations' AS topic, count(*) || ' operations: ' || string_agg(replace(operation, '_', ' '), ', ' ORDER BY step) AS answer
FROM plan_None
UNION ALL SELECT 'quality', 'overall quality went from ' || r.overall || '% to ' || t.overall || '%' FROM raw_scores r, tidied_scores t""",
)
def lineage_report(spark, sf_dir):
    raw = untidy(spark, sf_dir)
    cleaned = run.clean(raw)
    return lineage(planner.plan_frame(spark, cleaned.steps), quality_lift(raw, keep_table(cleaned.table)))


_HISTORY = """SELECT o_orderkey AS run_id, o_custkey AS dataset_id,
  CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'STARTED' ELSE 'FAILED' END AS status,
  (o_orderkey % 1000)::BIGINT AS rows, o_totalprice AS quality, o_orderdate AS finished_at FROM orders"""


@query(
    "run_summary",
    f"""WITH runs AS ({_HISTORY}),
latest AS (SELECT * FROM runs WHERE status = 'SUCCESS' ORDER BY finished_at DESC, run_id DESC LIMIT 5)
SELECT count(DISTINCT dataset_id) AS total_datasets, sum(rows)::BIGINT AS total_records,
  count_if(status = 'SUCCESS')::BIGINT AS successful_runs, count_if(status = 'FAILED')::BIGINT AS failed_runs,
  {sql_round("avg(CASE WHEN status = 'SUCCESS' THEN quality END)", 1)} AS average_quality,
  (SELECT list(run_id ORDER BY finished_at DESC, run_id DESC) FROM latest) AS recent_runs
FROM runs""",
)
def run_summary(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "O", "STARTED").otherwise("FAILED")
    )
    history = orders.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_custkey").alias("dataset_id"),
        status.alias("status"),
        (F.col("o_orderkey") % 1000).alias("rows"),
        F.col("o_totalprice").alias("quality"),
        F.col("o_orderdate").alias("finished_at"),
    )
    return audit.run_summary(history)
