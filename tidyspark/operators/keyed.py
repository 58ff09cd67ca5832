"""Joins with a dictionary and row numbering that hold up under hot keys."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.session import cut_lineage

BROADCAST_ROWS = 1_000_000
SALTS = 32


def fits_broadcast(dictionary: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``limit`` rows; reads no more than it must."""
    return dictionary.limit(limit + 1).count() <= limit


def look_up(
    df: DataFrame,
    dictionary: DataFrame,
    key: str,
    spread_by: list[str],
    how: str = "left",
    limit: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``df`` with a dictionary that has one row per key.

    A dictionary of checked size is broadcast. A larger one is joined by shuffle
    with a salted key: rows of a key are spread over ``salts`` tasks by a hash of
    ``spread_by`` (deterministic, so a retried task lands where it did before) and
    each dictionary row is sent to all of them.
    """
    if fits_broadcast(dictionary, limit):
        return df.join(F.broadcast(dictionary), key, how)
    salt = "__salt"
    salted = df.withColumn(salt, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = dictionary.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, salt], how).drop(salt)


def number_rows(df: DataFrame, order: list[Column], name: str, slices: int = 200) -> DataFrame:
    """Zero-based position of each row in the sorted table, without a single-task sort.

    Rows are range-partitioned and the slice each row fell into is written down
    with it, so numbering inside the slices and the offsets of the slices agree
    even when tasks are retried.
    """
    part = "__slice"
    sliced = cut_lineage(df.repartitionByRange(slices, *order).withColumn(part, F.spark_partition_id()))
    sizes = {row[part]: row["count"] for row in sliced.groupBy(part).count().collect()}
    ends = list(accumulate(sizes.get(i, 0) for i in range(slices)))
    starts = F.array(*[F.lit(v).cast("bigint") for v in [0, *ends[:-1]]])
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return sliced.withColumn(name, starts[F.col(part)] + inside - 1).drop(part)
