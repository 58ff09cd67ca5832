"""Queries over the cleaning operators, each on the untidy table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyspark.functions.text import FALSE_WORDS, TRUE_WORDS, WHITESPACE
from tidyspark.operators import clean as c
from tidyspark.plans import run as cleaning
from tidyspark.queries.base import UNTIDY_COLUMNS, UNTIDY_CTE, UNTIDY_TEXT, query, sql_list, sql_text, table, untidy

_SPACE = sql_text(WHITESPACE)


def strip_sql(column: str) -> str:
    return f"trim({column}, {_SPACE})"


def money_sql(column: str) -> str:
    return f"CAST(translate({strip_sql(column)}, '$,', '') AS DOUBLE)"


def yes_no_sql(column: str) -> str:
    word = f"lower({strip_sql(column)})"
    return (
        f"CASE WHEN {word} IN ({sql_list(TRUE_WORDS)}) THEN 'Yes' "
        f"WHEN {word} IN ({sql_list(FALSE_WORDS)}) THEN 'No' ELSE {column} END"
    )


def title_sql(value: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({value}), '\\p{{L}}+|[^\\p{{L}}]+'), "
        "lambda r: (CASE r[1] WHEN 'ß' THEN 'Ss' ELSE upper(r[1]) END) || r[2:]), '')"
    )


def words_sql(column: str, region: bool = False) -> str:
    value = strip_sql(column)
    titled = f"CASE WHEN {value} = '' THEN '' ELSE {title_sql(value)} END"
    if region:
        titled = f"CASE WHEN regexp_matches({value}, '^\\p{{L}}{{1,3}}$') THEN upper({value}) ELSE {titled} END"
    return f"CASE WHEN {column} IS NOT NULL THEN {titled} END"


def date_sql(column: str) -> str:
    value = strip_sql(column)
    formats = ("%Y-%m-%d", "%Y/%m/%d", "%m-%d-%Y", "%m/%d/%Y", "%d-%m-%Y", "%d/%m/%Y", "%B %-d %Y")
    tries = ", ".join(f"try_strptime({value}, '{f}')" for f in formats)
    return f"strftime(coalesce({tries}), '%Y-%m-%d')"


def _swap(changes: dict[str, str], columns=UNTIDY_COLUMNS) -> str:
    return ", ".join(f"{changes[col]} AS {col}" if col in changes else col for col in columns)


def _mode_sql(column: str, source: str) -> str:
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} ASC LIMIT 1)"
    )


def _fill_sql(source: str, numeric: tuple[str, ...], text: tuple[str, ...]) -> dict[str, str]:
    changes = {n: f"coalesce({n}::DOUBLE, (SELECT quantile_cont({n}::DOUBLE, 0.5) FROM {source}))" for n in numeric}
    changes.update({t: f"coalesce({t}, {_mode_sql(t, source)}, 'Unknown')" for t in text})
    return changes


_TIDY_COLUMNS = tuple(col for col in UNTIDY_COLUMNS if col != "unused_notes")
_TIDY_TEXT = tuple(col for col in UNTIDY_TEXT if col != "unused_notes")
_ANY_VALUE = " OR ".join(f"{col} IS NOT NULL" for col in UNTIDY_COLUMNS)

# The whole cleaning as common table expressions, one per step.
TIDY_CTE = f"""{UNTIDY_CTE},
kept AS MATERIALIZED (SELECT DISTINCT {", ".join(_TIDY_COLUMNS)} FROM untidy WHERE {_ANY_VALUE}),
coerced AS (
  SELECT {_swap({"total_price": money_sql("total_price"), "approved": yes_no_sql("approved")}, _TIDY_COLUMNS)} FROM kept),
filled AS (
  SELECT {_swap(_fill_sql("coerced", ("quantity", "total_price"), ("order_id", "order_date", "approved", "region", "priority")), _TIDY_COLUMNS)}
  FROM coerced),
floored AS (
  SELECT {_swap({n: f"CASE WHEN {n} < 0 THEN 0 ELSE {n} END" for n in ("quantity", "total_price")}, _TIDY_COLUMNS)} FROM filled),
worded AS (
  SELECT {_swap({t: words_sql(t, t == "region") for t in ("order_id", "order_date", "approved", "region", "priority")}, _TIDY_COLUMNS)}
  FROM floored),
tidy AS (SELECT {_swap({"order_date": date_sql("order_date")}, _TIDY_COLUMNS)} FROM worded)"""


def _select(changes: dict[str, str]) -> str:
    return f"{UNTIDY_CTE} SELECT {_swap(changes)} FROM untidy"


@query("clean_empty_rows", f"{UNTIDY_CTE} SELECT * FROM untidy WHERE {_ANY_VALUE}")
def clean_empty_rows(spark, sf_dir):
    return c.remove_empty_rows(untidy(spark, sf_dir))


@query("clean_empty_columns", f"{UNTIDY_CTE} SELECT {', '.join(_TIDY_COLUMNS)} FROM untidy")
def clean_empty_columns(spark, sf_dir):
    return c.remove_empty_columns(untidy(spark, sf_dir))


@query("clean_duplicates", f"{UNTIDY_CTE} SELECT DISTINCT * FROM untidy")
def clean_duplicates(spark, sf_dir):
    return c.remove_duplicates(untidy(spark, sf_dir))


@query("clean_coerce_numeric", _select({"total_price": money_sql("total_price")}))
def clean_coerce_numeric(spark, sf_dir):
    return c.coerce_numeric(untidy(spark, sf_dir))


@query("clean_booleans", _select({"approved": yes_no_sql("approved")}))
def clean_booleans(spark, sf_dir):
    return c.normalise_booleans(untidy(spark, sf_dir))


_HOLED = "untidy_priced AS (SELECT " + _swap({"total_price": money_sql("total_price")}) + " FROM untidy)"


@query(
    "clean_fill_median",
    f"{UNTIDY_CTE}, {_HOLED} SELECT {_swap(_fill_sql('untidy_priced', ('quantity', 'total_price'), ()), ('quantity', 'total_price'))} FROM untidy_priced",
)
def clean_fill_median(spark, sf_dir):
    return c.fill_missing(c.coerce_numeric(untidy(spark, sf_dir).select("quantity", "total_price")))


@query(
    "clean_fill_mode",
    f"{UNTIDY_CTE} SELECT {_swap(_fill_sql('untidy', (), UNTIDY_TEXT), UNTIDY_TEXT)} FROM untidy",
)
def clean_fill_mode(spark, sf_dir):
    return c.fill_missing(untidy(spark, sf_dir).select(*UNTIDY_TEXT))


@query(
    "clean_negatives",
    "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer",
)
def clean_negatives(spark, sf_dir):
    return c.correct_negatives(table(spark, sf_dir, "customer"))


@query("clean_strings", _select({t: words_sql(t, t == "region") for t in UNTIDY_TEXT}))
def clean_strings(spark, sf_dir):
    return c.normalise_strings(untidy(spark, sf_dir))


@query("clean_strings_documents", f"SELECT doc_id, {words_sql('text')} AS text, {words_sql('lang')} AS lang, {words_sql('source')} AS source, n_chars FROM documents")
def clean_strings_documents(spark, sf_dir):
    return c.normalise_strings(table(spark, sf_dir, "documents"))


@query("clean_dates", _select({"order_date": date_sql("order_date")}))
def clean_dates(spark, sf_dir):
    return c.standardise_dates(untidy(spark, sf_dir))


_TIMED_SHAPES = (
    "MM/dd/yyyy HH:mm", "d MMM yyyy HH:mm", "MM/dd/yy", "MM.dd.yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'", "MM/dd/yyyy hh:mm a",
    "dd-MMM-yyyy",
)


@query("clean_dates_timed", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders")
def clean_dates_timed(spark, sf_dir):
    """Dates with times, two-digit years and dots, written from the orders' dates."""
    orders = table(spark, sf_dir, "orders")
    shape = F.pmod("o_orderkey", F.lit(len(_TIMED_SHAPES)))
    written = F.coalesce(*[F.when(shape == i, F.date_format("o_orderdate", s)) for i, s in enumerate(_TIMED_SHAPES)])
    return c.standardise_dates(orders.select("o_orderkey", written.alias("order_date")))


@query(
    "clean_column_names",
    "SELECT p_partkey AS part_key, p_name AS name, p_brand AS brand_type, p_type AS brand_type_2, p_size AS column, "
    "p_retailprice AS retail_price, p_retailprice AS retail_price_2 FROM part",
)
def clean_column_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    named = part.select(
        F.col("p_partkey").alias("Part Key #"),
        F.col("p_name").alias(" Name "),
        F.col("p_brand").alias("Brand/Type"),
        F.col("p_type").alias("brand type"),
        F.col("p_size").alias("??"),
        F.col("p_retailprice").alias("Retail Price ($)"),
        F.col("p_retailprice").alias("retail price"),
    )
    return c.standardise_names(named)


_SHORT = f"""{UNTIDY_CTE},
deduplicated AS MATERIALIZED (SELECT DISTINCT * FROM untidy),
filled AS (SELECT {_swap(_fill_sql("deduplicated", ("quantity",), UNTIDY_TEXT))} FROM deduplicated)
SELECT {_swap({t: words_sql(t, t == "region") for t in UNTIDY_TEXT})} FROM filled"""


@query("clean_short", _SHORT)
def clean_short(spark, sf_dir):
    """Duplicates, gaps and text only."""
    return cleaning.clean(untidy(spark, sf_dir), only=cleaning.SHORT_CLEANING).table


@query("clean_run", f"{TIDY_CTE} SELECT * FROM tidy")
def clean_run(spark, sf_dir):
    return cleaning.clean(untidy(spark, sf_dir)).table
