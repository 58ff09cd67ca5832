"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors get one more component that turns the largest inner product into the smallest distance.
A bounded sample is split in halves until its leaves are small, so lists are balanced; the leaves'
means are the centroids, held in every task with a neighbour graph that is searched
from a few entry points. A vector is put into its nearest list and, near a border, into others
about as near. A query visits every list whose distance is within a ratio of the nearest, and
more until they hold enough different vectors; where the graph's beam ends before that, all centroids
are measured. Of the rows that share a vector only as many ids as can be among the best are searched.
Lists are cut into blocks of bounded size, blocks of vectors and of queries meet in one
task each, and every block gives its best exactly, on the original vectors in double precision.
The lists of a query are visited in rounds, its nearest ones first and each time four times as many; what does not reach
the worst of the best ``k`` of the rounds before cannot be in the result and is not given.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.llm.common import stored

#: The centroids are fitted on at most so many vectors, and there are at most so many centroids.
SAMPLE_ROWS, MOST_LISTS = 20_000, 4_096
LIST_ROWS, COPIES = 400, 4
BORDER_RATIO, SEARCH_RATIO = 1.10, 1.35
#: Different vectors that the visited lists hold at least; more where lists are longer than LIST_ROWS.
LEAST_VISITED = 2_000
#: Parts that the rows of one vector are dealt to before their smallest ids are taken.
SALTS = 16
BLOCK_ROWS, QUERY_ROWS = 2_048, 512
GRAPH_DEGREE, BEAM = 16, 32
#: Lists that a query visits in its first round; by the end of each further round it has visited so many times as many.
ROUND_LISTS = 4


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector of doubles) of the rows that take part."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), vector.alias("vector"))
    some = F.exists("vector", lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine & some)


def _foremost(base: DataFrame, k: int) -> DataFrame:
    """(vec_id, vector): of each vector's different ids the ``k + 1`` smallest. Equal vectors have equal scores and
    ties go to the smaller id, so no other id can be among the ``k`` best besides the query's own."""
    dealt = base.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for keys in (("vector", "salt"), ("vector",)):  # twice, so that a frequent vector does not meet in one task
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))
        dealt = dealt.withColumn("place", place).filter(F.col("place") <= k + 1).drop("place")
    return dealt.drop("salt")


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] + (y**2).sum(1) - 2 * x @ y.T, 0)


def balanced_centroids(sample: np.ndarray, lists: int, seed: int = 3) -> np.ndarray:
    """Means of the leaves of a tree that splits the sample in equal halves along its two-means axis."""
    random = np.random.default_rng(seed)
    leaves = [sample]
    while len(leaves) < lists and max(map(len, leaves)) > 1:
        leaves.sort(key=len)
        leaf = leaves.pop()
        ends = leaf[random.choice(len(leaf), 2, replace=False)]
        for _ in range(8):
            near = _distances(leaf, ends).argmin(1)
            ends = np.stack([leaf[near == i].mean(0) if (near == i).any() else ends[i] for i in (0, 1)])
        order = np.argsort(leaf @ (ends[1] - ends[0]), kind="stable")
        leaves += [leaf[order[: len(leaf) // 2]], leaf[order[len(leaf) // 2 :]]]
    centroids = np.stack([leaf.mean(0) for leaf in leaves])
    for _ in range(3):  # a few steps of k-means keep the lists near balance and the borders short
        near = np.concatenate([_distances(part, centroids).argmin(1) for part in np.array_split(sample, 1 + len(sample) // 4096)])
        sums, counts = np.zeros_like(centroids), np.bincount(near, minlength=len(centroids))
        np.add.at(sums, near, sample)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


class Graph:
    """Centroids and their nearest others; a beam search visits few of them."""

    def __init__(self, centroids: np.ndarray, degree: int = GRAPH_DEGREE, seed: int = 5):
        self.centroids = centroids
        n = len(centroids)
        links = []
        for part in np.array_split(np.arange(n), 1 + n // 1024):
            distance = _distances(centroids[part], centroids)
            distance[np.arange(len(part)), part] = np.inf
            links.append(np.argsort(distance, axis=1, kind="stable")[:, : min(degree, n - 1)])
        near = np.concatenate(links)
        far = np.random.default_rng(seed).integers(0, n, (n, 4))  # long links keep the graph connected
        self.links = np.concatenate([near, far], axis=1)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 2 * BEAM)).astype(int))

    def search(self, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroids found and their squared distances, nearest first; -1 where there are fewer."""
        n, many = len(self.centroids), len(queries)
        beam = min(beam, n)
        norms = (self.centroids**2).sum(1)
        own = (queries**2).sum(1)
        found = np.broadcast_to(self.entries, (many, len(self.entries))).copy()
        distance = own[:, None] + norms[found] - 2 * queries @ self.centroids[self.entries].T
        open_ = np.ones(found.shape, bool)
        active = np.arange(many)
        best, best_distance = np.full((many, beam), -1), np.full((many, beam), np.inf)
        while len(active):
            order = np.argsort(distance, axis=1, kind="stable")[:, :beam]
            rows = np.arange(len(active))[:, None]
            found, distance, open_ = found[rows, order], distance[rows, order], open_[rows, order]
            done = ~open_.any(axis=1)
            width = found.shape[1]
            best[active[done], :width], best_distance[active[done], :width] = found[done], distance[done]
            active, found, distance, open_ = active[~done], found[~done], distance[~done], open_[~done]
            if not len(active):
                break
            rows = np.arange(len(active))
            place = open_.argmax(axis=1)  # the nearest that was not expanded yet
            open_[rows, place] = False
            new = np.sort(self.links[found[rows, place]], axis=1)
            known = (new[:, :, None] == found[:, None, :]).any(axis=2)
            known[:, 1:] |= new[:, 1:] == new[:, :-1]
            step = own[active][:, None] + norms[new] - 2 * np.einsum("nkd,nd->nk", self.centroids[new], queries[active])
            step[known] = np.inf
            fresh = ~known
            found, distance, open_ = np.hstack([found, np.where(known, -1, new)]), np.hstack([distance, step]), np.hstack([open_, fresh])
        best_distance[best < 0] = np.inf
        return best, np.maximum(best_distance, 0)


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    scaled = vectors / longest
    return np.hstack([scaled, np.sqrt(np.maximum(0, 1 - (scaled**2).sum(1, keepdims=True)))])


def _pointed(queries: np.ndarray) -> np.ndarray:
    return np.hstack([queries / np.linalg.norm(queries, axis=1, keepdims=True), np.zeros((len(queries), 1))])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width)


def _postings(vectors: DataFrame, graph, width: int, longest: float, copies: int) -> DataFrame:
    """(list, home, vec_id, vector): every vector in its nearest list (its home), near a border in others too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lifted = _lifted(_matrix(batch.column("vector"), width), longest)
            for part in np.array_split(np.arange(len(lifted)), 1 + len(lifted) // 1024):
                lists, distance = graph.value.search(lifted[part])
                centroids = graph.value.centroids
                taken = np.zeros(lists.shape, bool)
                taken[:, 0] = True
                for k in range(1, lists.shape[1]):
                    near = (lists[:, k] >= 0) & (distance[:, k] <= BORDER_RATIO**2 * distance[:, 0]) & (taken.sum(1) < copies)
                    # Not beside a list already taken that lies nearer to this one than the vector does.
                    for j in range(k):
                        gap = ((centroids[lists[:, k]] - centroids[lists[:, j]]) ** 2).sum(1)
                        near &= ~taken[:, j] | (gap > distance[:, k])
                    taken[:, k] = near
                    if not near.any() and k >= 8:
                        break
                row, k = np.nonzero(taken)
                at = pa.array(part[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists[row, k], pa.int32()), pa.array(k == 0), batch.column("vec_id").take(at), batch.column("vector").take(at)],
                    ["list", "home", "vec_id", "vector"],
                )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"list int, home boolean, vec_id {kind}, vector array<double>")


def chosen_lists(graph: Graph, sizes: np.ndarray, vectors: np.ndarray, ratio: float, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, lists) to visit, some rows at a time: all lists within ``ratio`` of a row's nearest one, and the next ones
    until they are the home of ``least`` vectors."""

    def rule(lists: np.ndarray, distance: np.ndarray) -> np.ndarray:
        held = np.where(lists >= 0, sizes[lists], 0)
        before = np.cumsum(held, axis=1) - held
        return (lists >= 0) & ((distance <= ratio**2 * distance[:, :1]) | (before < least))

    n = len(graph.centroids)
    for part in np.array_split(np.arange(len(vectors)), 1 + len(vectors) // 1024):
        lists, distance = graph.search(vectors[part])
        visit = rule(lists, distance)
        # The beam ends on a list to visit: there may be more, so every centroid is measured.
        open_ = visit[:, -1] | (lists < 0).any(axis=1) if len(part) else np.zeros(0, bool)
        row, k = np.nonzero(visit & ~open_[:, None])
        yield part[row], lists[row, k]
        rest = part[open_]
        for some in np.array_split(rest, -(-len(rest) * n // (1 << 16))) if len(rest) else ():
            distance = _distances(vectors[some], graph.centroids)
            lists = np.argsort(distance, axis=1, kind="stable")
            row, k = np.nonzero(rule(lists, np.take_along_axis(distance, lists, axis=1)))
            yield some[row], lists[row, k]


def rounds_of(row: np.ndarray) -> np.ndarray:
    """The round of every visit; ``row`` holds the visits' queries in ascending order, each query's nearest list first."""
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return np.searchsorted(ROUND_LISTS ** np.arange(1, 16), place, side="right")


def _visits(queries: DataFrame, graph, sizes, width: int, ratio: float, least: int) -> DataFrame:
    """(list, round, query_id, vector): the lists that each query visits, and in which round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _pointed(_matrix(batch.column("vector"), width))
            for row, chosen in chosen_lists(graph.value, sizes.value, vectors, ratio, least):
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chosen, pa.int32()), pa.array(rounds_of(row), pa.int32()), batch.column("query_id").take(at), batch.column("vector").take(at)],
                    ["list", "round", "query_id", "vector"],
                )

    kind = queries.schema["query_id"].dataType.simpleString()
    return queries.mapInArrow(run, f"list int, round int, query_id {kind}, vector array<double>")


def _best_of_block(k: int):
    """Of a block's vectors the ``k`` best for each of its queries that reach the query's ``floor``."""

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(vectors) or not len(queries):
            return pd.DataFrame({c: [] for c in columns})
        ids, x = vectors["vec_id"].to_numpy(), np.stack(vectors["vector"].to_numpy())
        asked, longest = np.stack(queries["vector"].to_numpy()), np.sqrt((x**2).sum(1).max())
        found: list[tuple] = []
        for query, known, vector, rough in zip(queries["query_id"], queries["floor"], asked, asked @ x.T):
            other, floor = ids != query, known
            if other.sum() > k:
                kept = rough[other]
                floor = max(floor, np.partition(kept, len(kept) - k)[len(kept) - k])
            floor -= 1e-9 * (np.abs(floor) + np.linalg.norm(vector) * longest)
            at = np.flatnonzero(other & (rough >= floor))
            # Equal vectors get equal scores: each row's sum is taken alone, in one order.
            exact = (x[at] * vector).sum(axis=1)
            order = np.lexsort((ids[at], -exact))[:k]
            order = order[exact[order] >= known]
            found.append((np.repeat(query, len(order)), ids[at][order], exact[order]))
        return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*found)))))

    return run


def _found(posted: DataFrame, visits: DataFrame, k: int, block_rows: int, query_rows: int) -> DataFrame:
    """(query_id, vec_id, score): what the blocks of one round give; ``visits`` has (list, query_id, vector, floor).

    Blocks: of vectors by a hash of the row, of queries likewise; every pair of blocks of a list meets once."""
    by_list = posted.groupBy("list").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("v_blocks"))
    asked_of = visits.groupBy("list").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("q_blocks"))
    plan = F.broadcast(by_list.join(asked_of, "list"))
    left = posted.join(plan, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), F.col("v_blocks")).cast("int").alias("v"),
        F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("q"), "vec_id", "vector",
    )
    right = visits.join(plan, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("v_blocks") - 1)).alias("v"),
        F.pmod(F.xxhash64("query_id"), F.col("q_blocks")).cast("int").alias("q"), "query_id", "vector", "floor",
    )
    keys = ("list", "v", "q")
    kinds = f"query_id {visits.schema['query_id'].dataType.simpleString()}, vec_id {posted.schema['vec_id'].dataType.simpleString()}"
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_best_of_block(k), f"{kinds}, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best of all that was found."""
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    list_rows: int = LIST_ROWS, copies: int = COPIES, ratio: float = SEARCH_RATIO, least: int = LEAST_VISITED,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` rows of largest inner product found,
    without rows that carry the query's own id; ties go to the smaller id; all candidates if there are
    no more than that.

    Vectors that are null, empty or zero, or hold null or non-finite components, take no part, nor do
    null ids and vectors of another length than the most frequent one (the longer, if two are as
    frequent). Of repeated rows with equal id and vector one counts; of an id with several vectors the
    best one. Empty tables give no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    base = stored(usable(vectors, id_col, vector_col), "vectors")
    sized = base.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("rows"))
    modal = sized.orderBy(F.desc("rows"), F.desc("width")).first()
    kind = base.schema["vec_id"].dataType.simpleString()
    schema = f"query_id {kind}, rank int, vec_id {kind}, score double"
    if modal is None:
        return spark.createDataFrame([], schema)
    width = modal["width"]
    base = stored(_foremost(base.filter(F.size("vector") == width), k), "foremost")
    rows = base.count()
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    longest = base.agg(F.max(norm)).first()[0]
    # One sample row per distinct vector at most, so that many equal ones do not use it up.
    sample = base.withColumn("__h", F.xxhash64("vector")).groupBy("__h").agg(F.min("vector").alias("vector"))
    drawn = sample.orderBy("__h").limit(SAMPLE_ROWS).select("vector").toArrow()
    points = _lifted(_matrix(drawn.column("vector").combine_chunks(), width), longest)
    lists = int(min(MOST_LISTS, max(1, -(-rows // list_rows)), max(1, len(points) // 4)))
    graph = spark.sparkContext.broadcast(Graph(balanced_centroids(points, lists)))  # at most MOST_LISTS centroids
    posted = stored(_postings(base, graph, width, longest, copies), "postings")
    # Different vectors at home: neither border copies nor repeated vectors count. A row per list.
    homes = posted.filter("home").select("list", F.xxhash64("vector").alias("h")).distinct()
    counts = homes.groupBy("list").agg(F.count("*").alias("rows")).toArrow()
    sizes = np.zeros(len(graph.value.centroids), np.int64)
    sizes[counts.column("list").to_numpy()] = counts.column("rows").to_numpy()
    # Beyond MOST_LISTS lists grow with the table, and so does what is visited: always as many lists.
    least = max(least, math.ceil(least * int(sizes.sum()) / (len(sizes) * list_rows)))
    asked = usable(queries, id_col, vector_col).filter(F.size("vector") == width).withColumnRenamed("vec_id", "query_id")
    visits = _visits(asked, graph, spark.sparkContext.broadcast(sizes), width, ratio, least)
    visits = stored(visits.sortWithinPartitions("round"), "visits")  # a round reads its own row groups
    last = visits.agg(F.max("round")).first()[0]
    if last is None:
        return spark.createDataFrame([], schema)
    posted, best = posted.select("list", "vec_id", "vector"), None
    for step in range(last + 1):
        now = visits.filter(F.col("round") == step).drop("round")
        if best is None:
            now = now.withColumn("floor", F.lit(float("-inf")))
        else:
            floors = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
            now = now.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        found = _found(posted, now, k, block_rows, query_rows)
        best = _ranked(found if best is None else found.unionByName(best.drop("rank")), k)
        if step < last:
            best = stored(best, "best")
    return best
