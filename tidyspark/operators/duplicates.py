"""Exact duplicate rows: counting them and dropping them.

Small tables are grouped by all their columns. For large ones the whole-row
shuffle is avoided: rows are first reduced to an 8-byte hash, the hashes seen
more than once are collected into a broadcast set (its size is checked), and only
rows carrying such a hash are compared in full. A hash collision merely adds a
row to the comparison, so the result is exact either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyspark.session import cut_lineage

# Above this many rows the hash pass pays for its second scan.
DIRECT_ROWS = 20_000_000
# 8 bytes each: at most 32 MB of keys are broadcast.
BROADCAST_HASHES = 4_000_000

_HASH = "__row_hash"


def _keys(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def _repeated_hashes(df: DataFrame) -> DataFrame | None:
    """Hashes of rows that may be duplicates, None when too many to broadcast."""
    hashes = df.select(F.xxhash64(*_keys(df)).alias(_HASH)).groupBy(_HASH).agg(F.count("*").alias("times"))
    repeated = cut_lineage(hashes.filter("times > 1").select(_HASH))
    return repeated if repeated.limit(BROADCAST_HASHES + 1).count() <= BROADCAST_HASHES else None


def _suspects(df: DataFrame, direct_rows: int, rows: int | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows that need a full comparison, rows known to be unique)."""
    if (df.count() if rows is None else rows) <= direct_rows:
        return df, None
    repeated = _repeated_hashes(df)
    if repeated is None:
        return df, None
    hashed = df.withColumn(_HASH, F.xxhash64(*_keys(df)))
    keys = F.broadcast(repeated)
    return (
        hashed.join(keys, _HASH, "left_semi").drop(_HASH),
        hashed.join(keys, _HASH, "left_anti").drop(_HASH),
    )


def duplicate_total(df: DataFrame, direct_rows: int = DIRECT_ROWS, rows: int | None = None) -> DataFrame:
    """One row: ``duplicates`` = rows minus distinct rows (missing equals missing).
    ``rows`` is the row count where it is known already."""
    suspects, _ = _suspects(df, direct_rows, rows)
    copies = suspects.groupBy(*_keys(suspects)).agg(F.count("*").alias("__times"))
    return copies.agg(F.coalesce(F.sum(F.col("__times") - 1), F.lit(0)).alias("duplicates"))


def drop_duplicate_rows(df: DataFrame, direct_rows: int = DIRECT_ROWS, rows: int | None = None) -> DataFrame:
    """Each distinct row once. Copies are equal in every column, so which one is
    kept cannot be told."""
    suspects, unique = _suspects(df, direct_rows, rows)
    kept = suspects.dropDuplicates()
    return kept if unique is None else kept.unionByName(unique)
