"""Small helpers shared by the operators: inputs, batches, digests, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyspark.session import scratch_path


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) alone, so that no other column's name can clash; a null text is empty."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: later jobs agree on its
    rows, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def digest16(text: Column | str) -> Column:
    """The first 16 bytes of SHA-256: a key for whole texts that holds at any number of them."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``most_bytes``; a longer row comes alone."""
    for batch in batches:
        start = total = 0
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        for row, size in enumerate(sizes):
            if total and total + size > most_bytes:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def list_array(values, offsets, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


class Bitmap:
    """Hashes as single bits: a test may say yes to a hash that was not put in, never no to one that was. It takes
    ``MOST_BITS`` bits at most, whatever the number of hashes, and is built by Spark in slices."""

    LEAST_BITS, MOST_BITS, EACH = 1 << 20, 1 << 30, 16

    def __init__(self, shared: Broadcast, mask: int):
        self.shared, self.mask = shared, mask

    @classmethod
    def of(cls, df: DataFrame, hashed: Column) -> Bitmap:
        """The bitmap of a column of longs; negative ones count by their lower bits."""
        rows = df.select(hashed.alias("h"))
        bits = min(cls.MOST_BITS, max(cls.LEAST_BITS, 1 << (cls.EACH * rows.count()).bit_length()))
        place = F.col("h").bitwiseAND(F.lit(bits - 1)) + 1
        slices = rows.groupBy(F.bitmap_bucket_number(place).alias("slice")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
        )
        held = np.zeros(bits // 8, np.uint8)
        for row in slices.collect():  # an eighth of MOST_BITS bytes in all
            part = np.frombuffer(row["bits"], np.uint8)
            held[(row["slice"] - 1) * len(part) :][: len(part)] = part
        return cls(df.sparkSession.sparkContext.broadcast(held), bits - 1)

    def holds(self, hashed: np.ndarray) -> np.ndarray:
        place = hashed.view(np.int64) & np.int64(self.mask)
        return (self.shared.value[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


#: Keys with more than this share of all rows are joined by broadcast; there can be no more of them than its inverse.
HOT_SHARE = 1_000


def join_with_hot(rows: DataFrame, told: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join of ``rows`` with one row per key. The entries of frequent keys are broadcast, and their rows are not shuffled."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).count()
    total = rows.count()
    frequent = stored(counts.filter(F.col("count") * HOT_SHARE > total).select(key), "frequent")
    hot = told.join(F.broadcast(frequent), key, "left_semi")
    near = rows.join(F.broadcast(hot), key)
    # Frequent keys without an entry go the other way, where they meet nothing.
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(told, key, how)
    return near.unionByName(far)
