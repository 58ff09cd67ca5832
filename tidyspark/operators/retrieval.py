"""Text passages, knowledge rows, TF-IDF weights and top-k retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.functions import text
from tidyspark.functions.numbers import round_even
from tidyspark.functions.stopwords import ENGLISH
from tidyspark.operators import facts, profile
from tidyspark.operators.keyed import BROADCAST_ROWS, fits_broadcast, look_up
from tidyspark.session import cut_lineage

# ---- fixed values ---------------------------------------------------------
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
MIN_PASSAGE = 30
FALLBACK_PASSAGE = 600
SNIPPET = 400
SCHEMA_COLUMNS = 10
FREQUENT_VALUES = 4
# Characters of text in a task while its words are counted, weighed and scored: what these rows need fits its memory.
TASK_CHARACTERS = 8_000_000
# ---------------------------------------------------------------------------


def passages(
    docs: DataFrame, id_column: str, text_column: str, separator: str = r"\n\n", longer_than: int = MIN_PASSAGE
) -> DataFrame:
    """``id, passage_no, full_text, snippet``: the pieces of a text longer than ``longer_than``
    characters; a text without such a piece is cut into passages of 600 characters."""
    body = text.strip(F.col(text_column))
    pieces = F.filter(
        F.transform(F.split(body, separator), lambda p: text.strip(p)), lambda p: F.length(p) > longer_than
    )
    last = F.floor((F.length(body) - 1) / FALLBACK_PASSAGE)
    whole = F.transform(F.sequence(F.lit(0), last.cast("int")), lambda i: body.substr(i * FALLBACK_PASSAGE + 1, F.lit(FALLBACK_PASSAGE)))
    chosen = F.when(F.size(pieces) > 0, pieces).otherwise(whole)
    full = F.col("full_text")
    return (
        docs.filter(F.length(body) > 0)
        .select(id_column, F.posexplode(chosen).alias("passage_no", "full_text"))
        .withColumn(
            "snippet",
            F.concat(F.substring(full, 1, SNIPPET), F.when(F.length(full) > SNIPPET, "...").otherwise("")),
        )
    )


def _words(value: Column) -> Column:
    return F.regexp_extract_all(F.lower(value), F.lit(f"({TOKEN_PATTERN})"), F.lit(0))


def _distinct_words(value: Column, stop_words: tuple[str, ...]) -> Column:
    """Each word of a text once, stop words left out."""
    return F.array_except(_words(value), F.array(*[F.lit(w) for w in stop_words]))


def _tasks(docs: DataFrame, text_column: str) -> int:
    """Tasks to deal texts over, by their length."""
    length = docs.agg(F.sum(F.length(text_column))).first()[0] or 0
    return max(-(-length // TASK_CHARACTERS), docs.sparkSession.sparkContext.defaultParallelism)


def term_counts(
    docs: DataFrame, id_column: str, text_column: str, stop_words: tuple[str, ...] = ENGLISH
) -> DataFrame:
    """``id, term, times`` per document, laid out by document.

    Texts are shuffled by document once; counting terms, norms and scores per
    document afterwards needs no further shuffle.
    """
    spread = docs.select(id_column, text_column).repartition(_tasks(docs, text_column), id_column)
    return (
        spread.select(id_column, F.explode(_words(F.col(text_column))).alias("term"))
        .filter(~F.col("term").isin(*stop_words))
        .groupBy(id_column, "term")
        .agg(F.count("*").alias("times"))
    )


def _idf(n: int, df: Column) -> Column:
    return F.log(F.lit(1.0 + n) / (1.0 + df)) + 1.0


def _document_frequency(docs: DataFrame, text_column: str, stop_words: tuple[str, ...]) -> DataFrame:
    """``term, df``: documents are counted per task first, so a term found in a third of them is no larger a group
    than any other."""
    terms = F.explode(_distinct_words(F.col(text_column), stop_words))
    return docs.select(terms.alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def inverse_frequency(
    docs: DataFrame, id_column: str, text_column: str, stop_words: tuple[str, ...] = ENGLISH
) -> DataFrame:
    """``term, idf`` with idf = ln((1 + n) / (1 + documents with the term)) + 1.

    Each document names a term once before anything is shuffled.
    """
    n = docs.count()
    found = _document_frequency(docs, text_column, stop_words)
    return found.select("term", _idf(n, F.col("df")).alias("idf"))


def _frequent_from(found: DataFrame, limit: int) -> int:
    """The least power of two such that at most ``limit`` terms are in so many documents."""
    power = F.floor(F.log2("df")).cast("int").alias("power")
    sizes = {r["power"]: r["count"] for r in found.groupBy(power).count().collect()}  # 63 rows at most
    least = max(sizes, default=0) + 1
    held = 0
    while least > 0 and held + sizes.get(least - 1, 0) <= limit:
        least -= 1
        held += sizes.get(least, 0)
    return 1 << least


def _weighted(
    docs: DataFrame, id_column: str, text_column: str, stop_words: tuple[str, ...], limit: int = BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(weights of all documents, idf table).

    Texts are cut into words once for the idf table and once for the counts: writing, reading and shuffling
    the counts would move several times the volume of the texts.

    The idf of the most frequent terms, up to ``limit`` of them, is broadcast. Terms of one document share one
    idf, a literal. Only what lies between, words of few documents, is shuffled: its documents are told the idf, as
    rows that travel beside their texts.
    """
    n = docs.count()
    found = cut_lineage(_document_frequency(docs, text_column, stop_words))
    idf = found.select("term", _idf(n, F.col("df")).alias("idf"))
    least = _frequent_from(found, limit)
    frequent = F.broadcast(found.filter(F.col("df") >= least).select("term", _idf(n, F.col("df")).alias("common")))
    texts = docs.select(id_column, text_column, F.lit(None).cast("double").alias("told"))
    if least > 2:
        terms = docs.select(id_column, F.explode(_distinct_words(F.col(text_column), stop_words)).alias("term"))
        rare = terms.join(frequent, "term", "left_anti").groupBy("term").agg(
            # a null id is a document too; fewer than ``least`` entries
            F.collect_list(F.struct(F.col(id_column).alias("id"))).alias("holders"), F.count("*").alias("df")
        )
        told = rare.filter("df > 1").select(F.explode("holders").alias("holder"), "term", _idf(n, F.col("df")).alias("told"))
        texts = texts.unionByName(
            told.select(F.col("holder.id").alias(id_column), F.col("term").alias(text_column), "told")
        )
    spread = texts.repartition(_tasks(docs, text_column), id_column)
    is_text = F.col("told").isNull()
    words = F.when(is_text, _words(F.col(text_column))).otherwise(F.array(text_column))
    counts = (
        spread.select(id_column, "told", F.explode(words).alias("term"))
        .filter(~F.col("term").isin(*stop_words))
        .groupBy(id_column, "term")
        .agg(F.count_if(is_text).alias("times"), F.max("told").alias("told"))
    )
    known = F.coalesce("common", "told", _idf(n, F.lit(1)))
    raw = counts.join(frequent, "term", "left").select(id_column, "term", (F.col("times") * known).alias("raw"))
    return _normed(raw, id_column), idf


def _normed(raw: DataFrame, id_column: str) -> DataFrame:
    """``id, term, weight``: raw weights scaled to length 1 per document."""
    # the window groups by document: bounded by the words of one text
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_column)))
    return raw.select(id_column, "term", (F.col("raw") / norm).alias("weight"))


def _weigh(counts: DataFrame, id_column: str, idf: DataFrame) -> DataFrame:
    """``id, term, weight``: counts times idf, scaled to length 1 per document."""
    asked = counts.select("term").distinct()
    if fits_broadcast(asked):
        # no more of a long dictionary than is asked for
        idf = cut_lineage(idf.join(F.broadcast(asked), "term", "left_semi"))
    raw = look_up(counts, idf, "term", spread_by=[id_column], how="inner").select(
        id_column, "term", (F.col("times") * F.col("idf")).alias("raw")
    )
    return _normed(raw, id_column)


def tfidf(docs: DataFrame, id_column: str, text_column: str, stop_words: tuple[str, ...] = ENGLISH) -> DataFrame:
    """``id, term, weight`` of every document."""
    return _weighted(docs, id_column, text_column, stop_words)[0]


def retrieve(
    corpus: DataFrame,
    id_column: str,
    text_column: str,
    queries: DataFrame,
    query_id: str,
    query_text: str,
    k: int = 3,
    stop_words: tuple[str, ...] = ENGLISH,
) -> DataFrame:
    """The k documents closest to each query: ``query_id, rank, id, score, relevance``.

    Scores are cosines of TF-IDF vectors over the corpus's vocabulary. Queries of
    checked size are broadcast to the documents' tasks, where each document's
    scores are summed without a shuffle and only the k best per query leave a
    task. Fewer than k documents may share a word with a query; the rest of its
    places go to the first documents, with score 0.
    """
    weights, idf = _weighted(corpus, id_column, text_column, stop_words)
    asked = term_counts(queries.select(query_id, query_text), query_id, query_text, stop_words)
    query_weights = cut_lineage(_weigh(asked, query_id, idf).withColumnRenamed("weight", "query_weight"))

    if fits_broadcast(query_weights):
        pairs = weights.join(F.broadcast(query_weights), "term")
    else:
        # too many queries for one task: spread both sides of a frequent word
        salts = 32
        left = weights.withColumn("salt", F.pmod(F.xxhash64(id_column), F.lit(salts)))
        right = query_weights.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        pairs = left.join(right, ["term", "salt"])
    scores = pairs.groupBy(id_column, query_id).agg(F.sum(F.col("weight") * F.col("query_weight")).alias("score"))
    # scores are compared as reported, so that equal ones fall back to the id
    scores = scores.withColumn("score", round_even(F.col("score"), 6)).filter("score > 0")
    # the first k documents fill the places of a query with fewer hits
    filler = corpus.select(id_column).orderBy(id_column).limit(k).agg(F.collect_list(id_column).alias("ids"))
    rest = queries.select(query_id, F.explode(filler.scalar()).alias(id_column), F.lit(0.0).alias("score"))
    best = Window.partitionBy(query_id).orderBy(F.desc("score"), F.asc(id_column))
    top = scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank")
    merged = top.unionByName(rest).groupBy(query_id, id_column).agg(F.max("score").alias("score"))
    return (
        merged.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .withColumn("relevance", F.floor(F.col("score") * 100).cast("int"))
    )


def badge(kind: Column, relevance: Column, title: Column) -> Column:
    """``[KIND · n% MATCH] title``."""
    return F.concat(F.lit("["), F.upper(kind), F.lit(" · "), relevance.cast("string"), F.lit("% MATCH] "), title)


def _grouped(value: Column) -> Column:
    """A number with thousands separators and one or two decimals."""
    return F.call_function("format_number", round_even(value, 2), F.lit("#,##0.0#"))


def _plain(value: Column) -> Column:
    return F.call_function("format_number", round_even(value, 2), F.lit("0.0#"))


_KNOWLEDGE = ("kind", "title", "snippet", "full_text")


def statistics_rows(df: DataFrame) -> DataFrame:
    """One row of words per column: range and mean, or distinct and frequent values."""
    numeric = (
        facts.column_facts(df, ["nulls", "low", "high", "mean"])
        .filter(F.col("kind").isin(facts.NUMBER, facts.BOOLEAN))
        .select(
            "name",
            F.coalesce("low", F.lit(0.0)).alias("low"),
            F.coalesce("high", F.lit(0.0)).alias("high"),
            F.coalesce("mean", F.lit(0.0)).alias("mean"),
            (F.col("rows") - F.col("nulls")).alias("valid"),
        )
        .select(
            F.lit("statistics").alias("kind"),
            F.concat(F.lit("Column Statistics: "), "name").alias("title"),
            F.concat(
                F.lit("Numeric field '"), "name", F.lit("': minimum "), _grouped(F.col("low")), F.lit(", maximum "),
                _grouped(F.col("high")), F.lit(", mean "), _grouped(F.col("mean")), F.lit(" over "),
                F.format_number("valid", 0), F.lit(" values."),
            ).alias("snippet"),
            F.concat(
                F.lit("Column "), "name", F.lit(" numeric distribution: min="), _plain(F.col("low")), F.lit(", max="),
                _plain(F.col("high")), F.lit(", mean="), _plain(F.col("mean")),
            ).alias("full_text"),
        )
    )
    described = profile.described_columns(df)
    if not described:
        return numeric
    counts = facts.value_counts(df, described)
    distinct = counts.groupBy("ordinal").agg(F.count_if(F.col("s").isNotNull()).alias("distinct"))
    order = Window.partitionBy("ordinal").orderBy(F.desc("times"), F.asc("s"))
    frequent = (
        counts.filter(F.col("s").isNotNull())
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= FREQUENT_VALUES)
        .select(
            "ordinal", "rank",
            F.concat(F.lit("'"), "s", F.lit("' ("), F.col("times").cast("string"), F.lit(")")).alias("entry"),
        )
        .groupBy("ordinal")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "entry"))).getField("entry").alias("entries"))
    )
    label = F.array(*[F.lit(c) for c in df.columns])
    listed = F.coalesce(F.array_join("entries", ", "), F.lit(""))
    textual = (
        distinct.join(frequent, "ordinal", "left")
        .withColumn("name", label[F.col("ordinal") - 1])
        .select(
            F.lit("statistics").alias("kind"),
            F.concat(F.lit("Categorical Distribution: "), "name").alias("title"),
            F.concat(
                F.lit("Categorical field '"), "name", F.lit("' has "), F.col("distinct").cast("string"),
                F.lit(" distinct values. Frequent values: "), listed, F.lit("."),
            ).alias("snippet"),
            F.concat(F.lit("Column "), "name", F.lit(" categorical values: "), listed).alias("full_text"),
        )
    )
    return numeric.unionByName(textual)


def schema_row(df: DataFrame, dataset: str) -> DataFrame:
    every = ", ".join(f"{n} ({t})" for n, t in df.dtypes)  # searched: no column may be missing
    shown = ", ".join(f"{n} ({t})" for n, t in df.dtypes[:SCHEMA_COLUMNS])
    more = len(df.columns) - SCHEMA_COLUMNS
    shown += f", ... (+{more} more)" if more > 0 else ""
    return df.agg(F.count("*").alias("n")).select(
        F.lit("schema").alias("kind"),
        F.lit(f"Dataset Schema: {dataset}").alias("title"),
        F.concat(
            F.lit(f"Dataset '{dataset}' has "), F.format_number("n", 0),
            F.lit(f" rows and {len(df.columns)} columns: {shown}."),
        ).alias("snippet"),
        F.concat(
            F.lit(f"Schema for {dataset}: "), F.col("n").cast("string"),
            F.lit(f" rows, {len(df.columns)} columns. Column types: {every}"),
        ).alias("full_text"),
    )


POLICY_ROWS = (
    (
        "policy",
        "Model-Aware Feature Preparation Policy",
        "Linear models: clip to the 1st and 99th percentile, then scale to zero mean and unit variance. "
        "Distance models: clip, then scale to the range 0 to 1. Tree models: keep values as they are, ordinal codes.",
        "feature preparation policy: linear and logistic regression outlier clipping standard scaling, "
        "nearest neighbours min-max scaling, tree models raw distribution ordinal encoding",
    ),
    (
        "knowledge",
        "Table Preparation Workflow",
        "A run inspects, profiles, plans, cleans, transforms, validates and stores a table, then scores a model.",
        "workflow of a run: source analysis, profile, plan, ingestion, cleaning, transformation, validation, "
        "storage, model benchmark",
    ),
)


def knowledge_rows(df: DataFrame, dataset: str, lineage: DataFrame | None = None) -> DataFrame:
    """``kind, title, snippet, full_text``: schema, one row per column, lineage
    answers (``topic, answer``) if given, and the fixed policy rows."""
    spark = df.sparkSession
    rows = schema_row(df, dataset).unionByName(statistics_rows(df))
    if lineage is not None:
        kind = F.when(F.col("topic") == "benchmark", "benchmark").otherwise("lineage")
        title = F.concat(F.lit("Run Report: "), "topic")
        rows = rows.unionByName(
            lineage.select(
                kind.alias("kind"), title.alias("title"), F.col("answer").alias("snippet"),
                F.concat(F.lit(f"{dataset} "), "topic", F.lit(": "), "answer").alias("full_text"),
            )
        )
    return rows.unionByName(spark.createDataFrame(list(POLICY_ROWS), ", ".join(f"{c} string" for c in _KNOWLEDGE)))


def sources(df: DataFrame, dataset: str, questions: DataFrame, query_id: str, query_text: str, k: int = 3,
            lineage: DataFrame | None = None) -> DataFrame:
    """The k knowledge rows closest to each question, with badge and relevance.
    Rows are told apart by their title; equal scores go in title order."""
    rows = cut_lineage(knowledge_rows(df, dataset, lineage))
    corpus = rows.select("title", F.concat_ws(" ", "title", "full_text").alias("body"))
    found = retrieve(corpus, "title", "body", questions, query_id, query_text, k)
    # a handful of rows per column of one table
    return found.join(F.broadcast(rows.select("title", "kind", "snippet")), "title").select(
        query_id, "rank", "kind", badge(F.col("kind"), F.col("relevance"), F.col("title")).alias("title"), "snippet",
        "relevance",
    )
