"""A training corpus from raw documents: five stages, each written and read back by the next.

Every stage is a function of (spark, docs, sf_dir) and returns the columns of ``documents``, but for the last,
which returns token ids. Extra columns pass through all but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyspark.llm import bagminhash, bpe, content_sort, mixing, toxicity
from tidyspark.llm.queries import ranks_path
from tidyspark.session import keep_table

#: Name of the score while it decides; no table should have it.
SCORE = "__toxicity_score"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a model that is learned from the labels of these documents; all of
    them if the labels do not hold both classes."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, name=SCORE).filter(~toxicity.is_toxic(SCORE, model)).drop(SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return content_sort.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return bagminhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that the mixing weights ask for: none less than once, small sources up to
    twice. A document used twice is two rows."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every row: its token ids, and whether they decode to its text."""
    named = docs.select(F.struct("doc_id", F.sha2("text", 256).alias("sha")).alias("doc_id"), "text")
    return bpe.round_trip(named, ranks_path()).select(
        F.col("doc_id.doc_id").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        (F.coalesce("doc_id.sha", F.sha2(F.lit(""), 256)) == F.sha2("decoded", 256)).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", encode),
]

#: Training, Poisson processes and merges by rank have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = keep_table(docs)
    return docs
