"""Exact k nearest neighbours without comparing everything with everything.

Training rows are reduced to distinct (vector, label) pairs with a count, then
assigned to the nearest of a bounded set of pivots. For a query the triangle
inequality rules out every cell that cannot hold one of its k nearest rows, so
it visits only the cells left. Crowded cells are cut into blocks on both sides;
a task therefore never holds more than one block of queries and one of training
rows, however many rows a cell has. Only the k best of a block leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.session import cut_lineage

CELL_ROWS = 2048
MAX_PIVOTS = 4096
BLOCK_ROWS = 2048
STRIP_ROWS = 32


def _vectors(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy())


def _squared_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    total = np.zeros((len(left), len(right)))
    columns = np.ascontiguousarray(right.T)
    # strips of rows small enough to stay in a core's cache
    for start in range(0, len(left), STRIP_ROWS):
        strip = total[start : start + STRIP_ROWS]
        gap = np.empty_like(strip)
        for axis, column in enumerate(columns):
            np.subtract(left[start : start + STRIP_ROWS, axis, None], column, out=gap)
            gap *= gap
            strip += gap
    return total


def _chunks(vectors: np.ndarray, size: int = 2048) -> Iterator[np.ndarray]:
    for start in range(0, len(vectors), size):
        yield vectors[start : start + size]


def _assign_cell(pivots: np.ndarray):
    @F.pandas_udf("struct<cell:int, gap:double>")
    def assign(vectors: pd.Series) -> pd.DataFrame:
        if not len(vectors):
            return pd.DataFrame({"cell": pd.Series(dtype="int32"), "gap": pd.Series(dtype="float64")})
        parts = []
        for chunk in _chunks(_vectors(vectors)):
            distances = np.sqrt(_squared_distances(chunk, pivots))
            cell = distances.argmin(axis=1)
            parts.append(pd.DataFrame({"cell": cell.astype("int32"), "gap": distances[np.arange(len(chunk)), cell]}))
        return pd.concat(parts, ignore_index=True)

    return assign


def _cells_to_visit(pivots: np.ndarray, cells: np.ndarray, radius: np.ndarray, reach: np.ndarray):
    """Cells that may hold one of the k nearest rows. ``reach`` is, per cell, a
    distance from the pivot within which k rows lie (infinite if it has fewer)."""
    centres = pivots[cells]

    @F.pandas_udf("array<int>")
    def visit(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        found = []
        for chunk in _chunks(_vectors(vectors)):
            distances = np.sqrt(_squared_distances(chunk, centres))
            bound = (distances + reach).min(axis=1)
            # a hair of slack keeps rounding from ruling out a cell that touches the bound
            near = distances - radius <= (bound + 1e-9 * (1.0 + bound))[:, None]
            found += [cells[row].astype("int32").tolist() for row in near]
        return pd.Series(found)

    return visit


def _nearest_places(squared: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k smallest of each row, smallest first, equal ones by column: only what reaches the k-th
    smallest is sorted."""
    width = min(k, squared.shape[1])
    limit = np.partition(squared, width - 1, axis=1)[:, width - 1]
    rows, columns = np.nonzero(squared <= limit[:, None])
    order = np.lexsort((columns, squared[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < width], columns[place < width]


def _best_of_block(k: int):
    def best(train: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "squared": [], "label": [], "times": []}).astype(
            {"query": "int64", "squared": "float64", "label": "float64", "times": "int64"}
        )
        if train.empty or queries.empty:
            return empty
        # rows in label order, so that distance ties are broken by label
        train = train.sort_values("label", kind="stable")
        labels, times = train["label"].to_numpy(), train["times"].to_numpy()
        squared = _squared_distances(_vectors(queries["point"]), _vectors(train["vector"]))
        rows, picked = _nearest_places(squared, k)
        return pd.DataFrame(
            {
                "query": queries["query"].to_numpy()[rows],
                "squared": squared[rows, picked],
                "label": labels[picked],
                "times": times[picked],
            }
        )

    return best


def nearest(train: DataFrame, queries: DataFrame, k: int, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k nearest training rows of each query: ``query, label, weight``.

    ``train`` has ``vector, label``; ``queries`` has ``query, vector``. Equal
    distances are settled by the smaller label. ``weight`` says how many of the k
    neighbours the line stands for.
    """
    train = cut_lineage(train.groupBy("vector", "label").agg(F.count("*").alias("times")))
    distinct = train.count()
    wanted = min(max(-(-distinct // cell_rows), 1), MAX_PIVOTS)
    # distinct vectors in hash order: a spread-out choice that a retry repeats
    chosen = train.select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(wanted).collect()
    pivots = np.array([row["vector"] for row in chosen], dtype=float)

    placed = train.withColumn("place", _assign_cell(pivots)("vector")).select("*", "place.*").drop("place")
    placed = cut_lineage(placed)
    closest = Window.partitionBy("cell").orderBy("gap")
    reach = (
        placed.withColumn("r", F.row_number().over(closest))
        .filter(F.col("r") <= k)
        .groupBy("cell")
        .agg(F.sum("times").alias("near"), F.max("gap").alias("reach"))
    )
    sizes = placed.groupBy("cell").agg(F.count("*").alias("rows"), F.max("gap").alias("radius"))
    # at most MAX_PIVOTS rows
    cells = sizes.join(reach, "cell").orderBy("cell").collect()
    visit = _cells_to_visit(
        pivots,
        np.array([c["cell"] for c in cells]),
        np.array([c["radius"] for c in cells]),
        np.array([c["reach"] if c["near"] >= k else np.inf for c in cells]),
    )
    # queries may stem from the same table as the training rows: rename to tell them apart
    asked = queries.select("query", F.col("vector").alias("point"))
    routed = cut_lineage(asked.select("query", "point", F.explode(visit("point")).alias("cell")))

    spark = train.sparkSession
    visits = {row["cell"]: row["count"] for row in routed.groupBy("cell").count().collect()}
    plan = [(c["cell"], -(-c["rows"] // block_rows), -(-visits.get(c["cell"], 0) // block_rows)) for c in cells]

    def blocks() -> DataFrame:
        return F.broadcast(spark.createDataFrame(plan, "cell int, train_blocks int, query_blocks int"))

    def spread(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = (
        placed.join(blocks(), "cell")
        .filter("query_blocks > 0")
        .withColumn("tb", F.pmod(F.xxhash64("vector", "label"), F.col("train_blocks")).cast("int"))
        .withColumn("qb", spread("query_blocks"))
        .select("cell", "tb", "qb", "vector", "label", "times")
    )
    right = (
        routed.join(blocks(), "cell")
        .withColumn("qb", F.pmod(F.xxhash64("query"), F.col("query_blocks")).cast("int"))
        .withColumn("tb", spread("train_blocks"))
        .select("cell", "tb", "qb", "query", "point")
    )
    keys = ["cell", "tb", "qb"]
    candidates = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(_best_of_block(k), "query bigint, squared double, label double, times bigint")
    )
    order = Window.partitionBy("query").orderBy("squared", "label")
    ranked = candidates.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)
    before = F.coalesce(F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weighted = ranked.withColumn("weight", F.least(F.col("times"), F.lit(k) - before))
    return weighted.filter("weight > 0").select("query", "label", "weight")


def vote(neighbours: DataFrame) -> DataFrame:
    """``query, prediction``: the label with most weight, the smaller one if equal."""
    counted = neighbours.groupBy("query", "label").agg(F.sum("weight").alias("weight"))
    return counted.groupBy("query").agg(F.min_by("label", F.struct(-F.col("weight"), F.col("label"))).alias("prediction"))


def average(neighbours: DataFrame) -> DataFrame:
    """``query, prediction``: the weighted mean of the neighbours' values."""
    mean = F.sum(F.col("label") * F.col("weight")) / F.sum("weight")
    return neighbours.groupBy("query").agg(mean.alias("prediction"))
