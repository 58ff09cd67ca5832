"""Exact duplicates by sorting contents.

Rows are dealt out by range over their normalised bytes (sampled splitters: the
leading characters, then a hash of the whole), every task sorts its range with
Spark's external sort, equal texts become neighbours, and comparing whole
neighbouring texts forms the groups. Texts carried by very many rows are cut into
slices of about ``slice_rows`` rows, each of which is a key of its own in the sort;
the slices' best rows, few by construction, are then sorted and compared again.
Only DataFrame operations: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.llm.common import stored

BLANKS = " \t\n\x0b\x0c\r"
#: At least so many rows carry a text before it is sliced, and at most so many texts are sliced.
SLICE_ROWS, MOST_SLICED = 2_000, 50_000
#: Leading characters that the splitters compare before the hash; bounds what sampling sends to the driver.
SPLITTER_CHARS = 24

_KEY = ("__head", "__hash")


def normal_text(text: Column | str) -> Column:
    """The text without ASCII blanks; a null text is empty."""
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), BLANKS, "")


def _slices(keyed: DataFrame, slice_rows: int) -> DataFrame:
    """Hashes carried by so many rows that they are sliced: at most ``MOST_SLICED`` of them,
    since each has more than that part of all rows."""
    counts = stored(keyed.groupBy("__hash").agg(F.count("*").alias("__times")), "hash-counts")
    rows = counts.agg(F.coalesce(F.sum("__times"), F.lit(0))).first()[0]
    size = max(slice_rows, -(-rows // MOST_SLICED))
    return counts.filter(F.col("__times") > size).select(
        "__hash", F.ceil(F.col("__times") / size).cast("int").alias("__slices")
    )


def _sorted(df: DataFrame, id_col: str, text_col: str, carry: list[Column], slice_rows: int) -> tuple[DataFrame, Window]:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(
        F.col(f"`{id_col}`").alias("__id"), F.length(text).cast("bigint").alias("__points"),
        normal_text(text).alias("__norm"), *carry,
    ).withColumn("__hash", F.xxhash64("__norm"))
    hot = _slices(rows.select("__hash"), slice_rows)
    rows = rows.join(F.broadcast(hot), "__hash", "left")
    # A row's slice depends on the row alone, so a repeated task deals it out the same way.
    sliced = F.when(F.col("__slices").isNotNull(), F.pmod(F.xxhash64("__id", F.lit(7)), F.col("__slices")).cast("int"))
    rows = rows.withColumn("__slice", F.coalesce(sliced, F.lit(-1)))
    rows = rows.withColumn("__head", F.substring("__norm", 1, SPLITTER_CHARS)).drop("__slices")
    dealt = rows.repartitionByRange(*_KEY, "__slice")
    # Head, hash and slice come first: equal ones lie in one range already, so the sort needs no second exchange.
    return dealt, Window.partitionBy(*_KEY, "__slice", "__norm")


def _best_first() -> list[Column]:
    return [F.col("__points").desc(), F.col("__id").asc_nulls_last()]


def content_sort(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when equal without ASCII blanks. The row with the most code points
    in the original text, then the smallest id, stays. A null text equals an empty one;
    empty texts form one group. Null ids come last; of rows that tie in everything one
    stays, the others have the same ``keep_id`` and ``kept`` false. An empty table gives no
    rows. Other columns are ignored.
    """
    dealt, same = _sorted(docs, id_col, text_col, [], slice_rows)
    ranked = dealt.select(
        "__id", "__points", "__slice", F.sha2("__norm", 256).alias("__sha"),
        F.row_number().over(same.orderBy(*_best_first())).alias("__rank"),
        F.first("__id").over(same.orderBy(*_best_first())).alias("__keep"),
        F.count("*").over(same).alias("__size"),
        F.when(F.col("__slice") >= 0, F.col("__norm")).alias("__norm"),
    )
    head = (F.col("__rank") == 1) & (F.col("__slice") >= 0)
    table = stored(ranked.withColumn("__norm", F.when(head, F.col("__norm"))), "content-sort")
    merged = _merge_slices(table.filter(head)).select(
        "__sha", F.col("__best").alias("__group_keep"), F.col("__total").alias("__group_size"),
        F.col("__best_slice").alias("__group_slice"),
    ).distinct()
    joined = table.drop("__norm").join(F.broadcast(merged), "__sha", "left")
    single = F.col("__group_size").isNull()
    return joined.select(
        F.col("__id").alias("doc_id"),
        F.when(single, F.col("__keep")).otherwise(F.col("__group_keep")).alias("keep_id"),
        F.coalesce("__group_size", "__size").alias("group_size"),
        ((F.col("__rank") == 1) & (single | (F.col("__slice") == F.col("__group_slice")))).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def _merge_slices(heads: DataFrame) -> DataFrame:
    """The slices' best rows, sorted and compared as whole texts once more. There are at
    most two times ``MOST_SLICED`` of them, whatever the table's size."""
    same = Window.partitionBy("__norm")
    best = same.orderBy(*_best_first(), F.col("__slice"))
    return heads.select(
        "*", F.first("__id").over(best).alias("__best"), F.first("__slice").over(best).alias("__best_slice"),
        F.sum("__size").over(same).alias("__total"), F.row_number().over(best).alias("__place"),
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The rows of ``docs`` that ``content_sort`` keeps, with all their columns; the rows
    travel through the sort itself, so no join brings the columns back."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    dealt, same = _sorted(docs, id_col, text_col, [whole], slice_rows)
    first = dealt.withColumn("__rank", F.row_number().over(same.orderBy(*_best_first()))).filter("__rank = 1")
    kept = stored(first.select(
        "__row", "__id", "__points", "__slice", F.lit(1).cast("bigint").alias("__size"),
        F.when(F.col("__slice") >= 0, F.col("__norm")).alias("__norm"),
    ), "content-sort")
    alone, heads = kept.filter("__slice < 0"), kept.filter("__slice >= 0")
    return alone.select("__row.*").unionByName(_merge_slices(heads).filter("__place = 1").select("__row.*"))
