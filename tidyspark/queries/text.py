"""Queries over passages, knowledge rows and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyspark.functions.numbers import round_even
from tidyspark.functions.stopwords import ENGLISH
from tidyspark.functions.text import WHITESPACE
from tidyspark.operators import retrieval as r
from tidyspark.queries.base import ORACLES, query, sql_list, sql_round, sql_text, table

_SPACE = sql_text(WHITESPACE)


@query(
    "text_passages",
    f"""WITH body AS (SELECT doc_id, trim(text, {_SPACE}) AS body FROM documents WHERE length(trim(text, {_SPACE})) > 0),
cut AS (SELECT doc_id, body, list_filter(list_transform(string_split(body, chr(10)), lambda p: trim(p, {_SPACE})),
  lambda p: length(p) > 30) AS pieces FROM body),
chosen AS (SELECT doc_id, CASE WHEN len(pieces) > 0 THEN pieces ELSE list_transform(range(0, (length(body) + 599) // 600), lambda i: substring(body, i * 600 + 1, 600)) END AS pieces FROM cut),
flat AS (SELECT doc_id, unnest(pieces) AS full_text, generate_subscripts(pieces, 1) - 1 AS passage_no FROM chosen)
SELECT doc_id, passage_no::INTEGER AS passage_no, full_text,
  substring(full_text, 1, 400) || CASE WHEN length(full_text) > 400 THEN '...' ELSE '' END AS snippet FROM flat""",
)
def text_passages(spark, sf_dir):
    return r.passages(table(spark, sf_dir, "documents"), "doc_id", "text", "\n")


def _grouped(value: str) -> str:
    return f"regexp_replace(format('{{:,.2f}}', {sql_round(value, 2)}), '0$', '')"


def _plain(value: str) -> str:
    return f"regexp_replace(format('{{:.2f}}', {sql_round(value, 2)}), '0$', '')"


def _numeric_words(c: str) -> str:
    low, high, mean = f"min({c}::DOUBLE)", f"max({c}::DOUBLE)", f"avg({c}::DOUBLE)"
    return f"""SELECT 'statistics' AS kind, 'Column Statistics: {c}' AS title,
  'Numeric field ''{c}'': minimum ' || {_grouped(low)} || ', maximum ' || {_grouped(high)} || ', mean ' || {_grouped(mean)}
    || ' over ' || format('{{:,}}', count({c})) || ' values.' AS snippet,
  'Column {c} numeric distribution: min=' || {_plain(low)} || ', max=' || {_plain(high)} || ', mean=' || {_plain(mean)} AS full_text
FROM customer"""


def _text_words(c: str) -> str:
    return f"""SELECT 'statistics' AS kind, 'Categorical Distribution: {c}' AS title,
  'Categorical field ''{c}'' has ' || max(n) || ' distinct values. Frequent values: ' || string_agg(entry, ', ' ORDER BY rank) || '.' AS snippet,
  'Column {c} categorical values: ' || string_agg(entry, ', ' ORDER BY rank) AS full_text
FROM (SELECT '''' || {c} || ''' (' || count(*) || ')' AS entry, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rank,
  (SELECT count(DISTINCT {c}) FROM customer) AS n FROM customer WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= 4"""


_CUSTOMER = "c_custkey (bigint), c_name (string), c_nationkey (int), c_acctbal (double), c_mktsegment (string)"
_POLICY = " UNION ALL ".join("SELECT " + ", ".join(sql_text(v) for v in row) for row in r.POLICY_ROWS)


@query(
    "knowledge_rows",
    f"""SELECT 'schema' AS kind, 'Dataset Schema: customer' AS title,
  'Dataset ''customer'' has ' || format('{{:,}}', count(*)) || ' rows and 5 columns: {_CUSTOMER}.' AS snippet,
  'Schema for customer: ' || count(*) || ' rows, 5 columns. Column types: {_CUSTOMER}' AS full_text FROM customer
UNION ALL {" UNION ALL ".join(_numeric_words(c) for c in ("c_custkey", "c_nationkey", "c_acctbal"))}
UNION ALL {" UNION ALL ".join(_text_words(c) for c in ("c_name", "c_mktsegment"))}
UNION ALL {_POLICY}""",
)
def knowledge_rows(spark, sf_dir):
    return r.knowledge_rows(table(spark, sf_dir, "customer"), "customer")


def _terms(source: str, key: str, name: str) -> str:
    return f"""{name}_terms AS (SELECT {key}, term, count(*) AS times FROM (
  SELECT {key}, unnest(regexp_extract_all(lower(text), '{r.TOKEN_PATTERN}')) AS term FROM {source})
  WHERE term NOT IN ({sql_list(ENGLISH)}) GROUP BY {key}, term)"""


def _weights(key: str, name: str) -> str:
    return f"""{name}_raw AS (SELECT {key}, term, times * idf AS raw FROM {name}_terms JOIN idf USING (term)),
{name}_norm AS (SELECT {key}, sqrt(sum(raw * raw)) AS norm FROM {name}_raw GROUP BY {key}),
{name}_weights AS (SELECT {key}, term, raw / norm AS weight FROM {name}_raw JOIN {name}_norm USING ({key}))"""


_TFIDF = f"""WITH {_terms("documents", "doc_id", "doc")},
idf AS (SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf
  FROM doc_terms GROUP BY term),
{_weights("doc_id", "doc")}"""


@query("tfidf_weights", f"{_TFIDF} SELECT doc_id, term, {sql_round('weight', 6)} AS weight FROM doc_weights")
def tfidf_weights(spark, sf_dir):
    weights = r.tfidf(table(spark, sf_dir, "documents"), "doc_id", "text")
    return weights.withColumn("weight", round_even(F.col("weight"), 6))


@query(
    "tfidf_topk",
    f"""{_TFIDF}, {_terms("benchmark", "item_id", "ask")}, {_weights("item_id", "ask")},
scores AS (SELECT item_id, doc_id, {sql_round("sum(d.weight * q.weight)", 6)} AS score
  FROM doc_weights d JOIN ask_weights q USING (term) GROUP BY item_id, doc_id),
filled AS (SELECT item_id, doc_id, max(score) AS score FROM (
  SELECT * FROM scores WHERE score > 0
  UNION ALL SELECT item_id, doc_id, 0.0::DOUBLE FROM benchmark, (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 3))
  GROUP BY item_id, doc_id),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank FROM filled)
SELECT item_id, doc_id, score, rank, floor(score * 100)::INTEGER AS relevance FROM ranked WHERE rank <= 3""",
)
def tfidf_topk(spark, sf_dir):
    return r.retrieve(
        table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text"
    )


_KNOWLEDGE = f"""WITH knowledge AS ({ORACLES["knowledge_rows"]}),
bodies AS (SELECT title, title || ' ' || full_text AS text FROM knowledge),
asked AS (SELECT conv_id || '-' || turn AS question_id, text FROM conversations),
{_terms("bodies", "title", "doc")},
idf AS (SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM bodies)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf
  FROM doc_terms GROUP BY term),
{_weights("title", "doc")}, {_terms("asked", "question_id", "ask")}, {_weights("question_id", "ask")},
scores AS (SELECT question_id, title, {sql_round("sum(d.weight * q.weight)", 6)} AS score
  FROM doc_weights d JOIN ask_weights q USING (term) GROUP BY question_id, title),
filled AS (SELECT question_id, title, max(score) AS score FROM (
  SELECT * FROM scores WHERE score > 0
  UNION ALL SELECT question_id, title, 0.0::DOUBLE FROM asked, (SELECT title FROM bodies ORDER BY title LIMIT 3))
  GROUP BY question_id, title),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY question_id ORDER BY score DESC, title))::INTEGER AS rank,
  floor(score * 100)::INTEGER AS relevance FROM filled)
SELECT question_id, rank, kind, '[' || upper(kind) || ' · ' || relevance || '% MATCH] ' || title AS title, snippet, relevance
FROM ranked JOIN knowledge USING (title) WHERE rank <= 3"""


@query("knowledge_sources", _KNOWLEDGE)
def knowledge_sources(spark, sf_dir):
    """Knowledge rows about customers that fit each conversation turn of a user best."""
    turns = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("question_id"), "text"
    )
    return r.sources(table(spark, sf_dir, "customer"), "customer", turns, "question_id", "text")
