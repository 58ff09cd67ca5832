"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent and normalised. The exponent is found by
bisection: the smallest one at which no source is repeated more often than allowed under the token
budget, or the one at which the weights reach a target entropy. The weights are realised as
budgeted block permutations: every source is dealt into blocks of about ``block_rows`` documents
by a hash, each block has its part of the source's budget, and goes through whole permutations
(epochs) of its documents, each in another pseudo-random order, until the budget is spent.

Only DataFrame operations. The table of sources stays distributed: bisection looks at it through
sums, for a grid of exponents at a time, and a source of any size is many blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.llm.common import stored

BLOCK_ROWS = 2_000
GRID, ROUNDS = 16, 8


def token_count(text: Column) -> Column:
    """Tokens of a text: its words, runs of anything but blanks."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("bigint")


def source_tokens(docs: DataFrame, source: Column, tokens: Column) -> DataFrame:
    """(source, rows, tokens): counted per task first, so a hot source is no hot key."""
    return docs.groupBy(source.alias("source")).agg(F.count("*").alias("rows"), F.sum(tokens).alias("tokens"))


@dataclass(frozen=True)
class Mix:
    exponent: float
    budget: float
    norm: float  # sum of the shares raised to the exponent
    total: float

    def weight(self, tokens: Column) -> Column:
        return F.when(tokens > 0, F.pow(tokens / F.lit(self.total), F.lit(self.exponent)) / F.lit(self.norm)).otherwise(0.0)

    def repeats(self, tokens: Column) -> Column:
        """How often a source's tokens are used."""
        return F.when(tokens > 0, self.weight(tokens) * F.lit(self.budget) / tokens).otherwise(0.0)


def fit_mix(
    sources: DataFrame, max_repeats: float | None = 2.0, target_entropy: float | None = None,
    budget: float | None = None, rounds: int = ROUNDS,
) -> Mix:
    """Bisect the exponent in [0, 1] (1: as found, 0: all sources alike).

    With ``max_repeats`` the smallest exponent at which no source is used more often than that; with
    ``target_entropy`` (nats) the one whose weights have it. A target out of reach gives the nearest end.
    ``budget`` is in tokens; without it, it is just enough for the largest source to be used once, so
    that no source loses documents. Without any tokens the exponent is 1 and the budget 0.
    """
    filled = sources.filter("tokens > 0")
    total, largest, smallest = (float(v or 0) for v in filled.agg(F.sum("tokens"), F.max("tokens"), F.min("tokens")).first())
    if not total:
        return Mix(1.0, 0.0, 1.0, 1.0)
    share = F.col("tokens") / F.lit(total)

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        """(sum of share^a, sum of share^a * log share) for every exponent, in one job."""
        row = filled.agg(*[
            f for a in exponents for f in (F.sum(F.pow(share, F.lit(a))), F.sum(F.pow(share, F.lit(a)) * F.log(share)))
        ]).first()
        return [(row[2 * i], row[2 * i + 1]) for i in range(len(exponents))]

    def mix(a: float, norm: float) -> Mix:
        enough = largest / ((largest / total) ** a / norm)
        return Mix(a, enough if budget is None else float(budget), norm, total)

    def too_flat(a: float, norm: float, weighted_log: float) -> bool:
        if target_entropy is not None:
            return math.log(norm) - a * weighted_log / norm > target_entropy
        found = mix(a, norm)
        # Repeats fall with a source's tokens for exponents up to 1: the smallest source has the most.
        return ((smallest / total) ** a / norm) * found.budget / smallest > max_repeats * (1 + 1e-12)

    low, high = 0.0, 1.0
    for _ in range(rounds):
        grid = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        flat = [too_flat(a, *s) for a, s in zip(grid, sums(grid))]
        if not flat[0]:
            high = low
            break
        if all(flat):
            low = high
            break
        first = flat.index(False)
        low, high = grid[first - 1], grid[first]
    return mix(high, sums([high])[0][0])


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    max_repeats: float | None = 2.0, target_entropy: float | None = None, budget: float | None = None,
    block_rows: int = BLOCK_ROWS, seed: int = 0, keep: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, n_tokens, weight, block, place, copies.

    ``weight`` is the source's weight, ``block`` the document's block in it, ``place`` its place in the
    last, partial epoch's order, ``copies`` how often the document is used: the whole epochs, and one
    more if the partial epoch's budget still has room when its turn comes (the document that crosses the
    budget is still used). Null sources form a source of their own; documents without tokens (null or
    empty texts) cost nothing: they are used as often as their source's epochs begin, and in a
    source without any tokens once. Orders depend on id, text and seed alone; rows equal in both follow
    each other. An empty table gives no rows. ``keep`` is carried along as ``row``.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        token_count(text).alias("n_tokens"), F.xxhash64(text, F.lit(seed)).alias("__text"),
        *([] if keep is None else [keep.alias("row")]),
    )
    counted = rows if keep is not None else stored(rows, "mix-rows")
    sources = stored(source_tokens(counted, F.col("source"), F.col("n_tokens")), "mix-sources")
    mix = fit_mix(sources, max_repeats, target_entropy, budget)
    plan = sources.select(
        F.col("source").alias("__source"), mix.weight(F.col("tokens")).alias("weight"),
        F.when(F.col("tokens") > 0, mix.repeats(F.col("tokens"))).otherwise(1.0).alias("__repeats"),
        F.ceil(F.col("rows") / block_rows).cast("int").alias("__blocks"),
    )
    key = F.xxhash64("doc_id", "__text")
    dealt = counted.join(plan, F.col("source").eqNullSafe(F.col("__source"))).withColumn(
        "block", F.pmod(F.xxhash64(key, F.lit(seed)), F.col("__blocks")).cast("int")
    )
    epochs = F.floor("__repeats")
    block = Window.partitionBy("__source", "block")
    order = block.orderBy(F.xxhash64(key, epochs, F.lit(seed + 1)), F.col("doc_id").asc_nulls_first(), "__text")
    before = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n_tokens")
    room = (F.col("__repeats") - epochs) * F.sum("n_tokens").over(block)
    return dealt.select(
        "doc_id", "source", "n_tokens", "weight", "block", F.row_number().over(order).cast("bigint").alias("place"),
        (epochs + F.when(before < room, 1).otherwise(0)).cast("bigint").alias("copies"),
        *([] if keep is None else ["row"]),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in their numbers of copies, all columns kept."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    mixed = mix_sources(docs, keep=whole, **options)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.filter("copies > 0").select("row", copies.alias("__copy")).select("row.*")
