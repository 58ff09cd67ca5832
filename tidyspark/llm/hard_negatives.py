"""Hard negatives by slots of scores.

Every anchor has a few positives, the best other rows of its label, and each positive opens a window of
scores below its own. The windows of an anchor overlap; their upper limits, in falling order, split the
scores into disjoint slots, from one upper limit down to the next. A scan keeps, per anchor and slot, the
best rows of other labels: within every block in numpy, then over the blocks by a window. As all rows of a
slot are worth less than those of the slots above, the best rows under a limit are those of its own slot
followed by those below: one merge from the lowest slot upwards answers all windows of the anchor, and a
window's lower limit only cuts the end of its list.

Scores are integers: components are scaled and floored. Rows and anchors are dealt to blocks of bounded
size, and each block of rows meets each block of anchors in one task, once for the positives and once for
the slots.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive's score that a negative reaches at least and at most.
LOWEST, HIGHEST = 50, 95
BLOCK_ROWS, ANCHOR_ROWS, TILE = 8_192, 2_048, 256
LONG = 2**63 - 1


def taking_part(df: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(vec_id, label, vector): one row per id, the smallest label and then vector of an id that has several."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), label.alias("label"), vector.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").filter(fine)
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("best")).select("vec_id", "best.*")


def whole_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers (held as doubles); beyond 64 bits the largest or smallest long."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    if np.abs(left).max() * np.abs(right).max() * left.shape[1] < 2.0**53:
        return (left @ right.T).astype(np.int64)  # every partial sum is a whole double
    exact = [[int(x) for x in row] for row in left], [[int(x) for x in row] for row in right]
    products = np.array([[sum(map(int.__mul__, x, y)) for y in exact[1]] for x in exact[0]], object)
    return np.clip(products, -LONG - 1, LONG).astype(np.int64)


def _scaled(vectors: pd.Series) -> np.ndarray:
    return np.floor(SCALE * np.stack(vectors.to_numpy()))


def _first(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of the places ``at`` with the highest scores, ties by the smaller id."""
    if len(at) > 4 * k:
        floor = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= floor]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _met(rows: DataFrame, anchors: DataFrame, run: Callable, schema: str, block_rows: int, anchor_rows: int) -> DataFrame:
    """``run`` on every pair of a block of rows and a block of anchors of equally long vectors."""
    sizes = rows.groupBy(F.size("vector").alias("wide")).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("v_blocks"))
    asked = anchors.groupBy(F.size("question").alias("wide")).agg(F.ceil(F.count("*") / anchor_rows).cast("int").alias("a_blocks"))
    plan = sizes.join(asked, "wide")
    left = rows.withColumn("wide", F.size("vector")).join(plan, "wide").select(
        "wide", F.pmod(F.xxhash64("vec_id"), F.col("v_blocks")).cast("int").alias("v"),
        F.explode(F.sequence(F.lit(0), F.col("a_blocks") - 1)).alias("a"), *rows.columns,
    )
    right = anchors.withColumn("wide", F.size("question")).join(plan, "wide").select(
        "wide", F.explode(F.sequence(F.lit(0), F.col("v_blocks") - 1)).alias("v"),
        F.pmod(F.xxhash64("anchor_id"), F.col("a_blocks")).cast("int").alias("a"), *anchors.columns,
    )
    keys = ("wide", "v", "a")
    columns = [field.split()[0] for field in schema.split(", ")]

    def meet(block: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(block) and len(questions):
            ids, labels, vectors = block["vec_id"].to_numpy(), block["label"].to_numpy(), _scaled(block["vector"])
            for start in range(0, len(questions), TILE):
                some = questions.iloc[start : start + TILE]
                scores = whole_scores(_scaled(some["question"]), vectors)
                same = some["own"].to_numpy()[:, None] == labels
                parts += [part for part in map(run, some.to_dict("records"), scores, same, [ids] * len(some)) if part is not None]
        if not parts:
            return pd.DataFrame({c: [] for c in columns})
        return pd.DataFrame(dict(zip(columns, (np.concatenate(c) for c in zip(*parts)))))

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, schema)


def positives(rows: DataFrame, anchors: DataFrame, many: int, block_rows: int, anchor_rows: int) -> DataFrame:
    """(anchor_id, place, vec_id, score): the best ``many`` other rows of each anchor's label."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(anchor: dict, scores: np.ndarray, same: np.ndarray, ids: np.ndarray):
        at = _first(scores, ids, np.flatnonzero(same & (ids != anchor["anchor_id"])), many)
        return np.repeat(anchor["anchor_id"], len(at)), ids[at], scores[at]

    found = _met(rows, anchors, run, f"anchor_id {kind}, vec_id {kind}, score bigint", block_rows, anchor_rows)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= many)


def score_limits(score: int, lowest: int, highest: int) -> tuple[int, int]:
    """Least and greatest whole negative score of a positive's window."""
    return -(-lowest * score // 100), highest * score // 100


def _slots(rows: DataFrame, asked: DataFrame, k: int, block_rows: int, anchor_rows: int) -> DataFrame:
    """(anchor_id, slot, vec_id, score): the best ``k`` rows of other labels of each slot of each anchor. ``asked``
    carries ``uppers`` in falling order and ``lowers``; a slot holds the scores from its upper limit down to
    above the next one, or to the least score that a window above it still takes."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(anchor: dict, scores: np.ndarray, same: np.ndarray, ids: np.ndarray):
        uppers, lowers = anchor["uppers"], np.minimum.accumulate(anchor["lowers"])
        other = np.flatnonzero(~same & (scores <= uppers[0]) & (scores >= lowers[-1]))
        if not len(other):
            return None
        # The slot of a score is the last one whose upper limit reaches it.
        slot = len(uppers) - 1 - np.searchsorted(uppers[::-1], scores[other], side="left")
        kept = scores[other] >= lowers[slot]
        other, slot = other[kept], slot[kept]
        best = [_first(scores, ids, other[slot == s], k) for s in range(len(uppers))]
        at = np.concatenate(best)
        slots = np.repeat(np.arange(len(uppers), dtype=np.int32), list(map(len, best)))
        return np.repeat(anchor["anchor_id"], len(at)), slots, ids[at], scores[at]

    found = _met(rows, asked, run, f"anchor_id {kind}, slot int, vec_id {kind}, score bigint", block_rows, anchor_rows)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def hard_negatives(
    df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label",
    many: int = POSITIVES, k: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST,
    block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id (column ``vec_id`` in the condition) fulfils ``is_anchor``; positives are an anchor's ``many`` best
    other rows of its label, negatives the ``k`` best rows of other labels that score between ``lowest`` and
    ``highest`` percent of the positive. The score is the inner product of components floored after scaling;
    beyond 64 bits it is the nearest long. Higher scores come first, ties go to the smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take no part; of an id's several
    rows the one with the smallest label, then vector counts, so repeated rows count once. Rows meet
    anchors of their own length only. A positive without negatives in its window gives no row (nor does a negative
    score: its window is empty), neither does an empty table; other columns are ignored.
    """
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = stored(taking_part(df, id_col, vector_col, label), "rows")
    anchors = rows.filter(is_anchor).select(
        F.col("vec_id").alias("anchor_id"), F.col("label").alias("own"), F.col("vector").alias("question")
    )
    paired = stored(positives(rows, anchors, many, block_rows, anchor_rows), "positives")
    # Negative scores have empty windows and would not keep the limits in order.
    lower = F.ceil(F.col("score").cast("decimal(38,0)") * lowest / 100)
    upper = F.floor(F.col("score").cast("decimal(38,0)") * highest / 100)
    windows = paired.filter("score >= 0").select(
        "anchor_id", "place", "vec_id", "score", lower.cast("bigint").alias("lower"), upper.cast("bigint").alias("upper")
    )
    by_anchor = windows.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score", "lower", "upper"))).alias("p"))
    asked = anchors.join(by_anchor.select("anchor_id", F.col("p.upper").alias("uppers"), F.col("p.lower").alias("lowers")), "anchor_id")
    held = _slots(rows, asked, k, block_rows, anchor_rows)
    entry = F.struct(F.col("place"), F.col("vec_id"), F.col("score"))
    lists = held.groupBy("anchor_id").pivot("slot", list(range(many))).agg(F.array_sort(F.collect_list(entry)))
    merged = by_anchor.join(lists, "anchor_id")
    none = F.array().cast(f"array<struct<place:int,vec_id:{rows.schema['vec_id'].dataType.simpleString()},score:bigint>>")
    running, answers = none, []
    for slot in reversed(range(many)):
        # The running list is complete below the slot's upper limit; a window cuts it at its own lower limit.
        merged = merged.withColumn(f"best{slot}", F.slice(F.concat(F.coalesce(F.col(f"`{slot}`"), none), running), 1, k))
        running = F.col(f"best{slot}")
        answers.append(F.struct(F.get("p", F.lit(slot)).alias("positive"), running.alias("best")))
    found = merged.select("anchor_id", F.inline(F.array(*answers))).filter("positive IS NOT NULL")
    found = found.select("anchor_id", "positive", F.posexplode("best").alias("rank", "n"))
    return found.filter("n.score >= positive.lower").select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), (F.col("rank") + 1).alias("rank"),
        F.col("n.vec_id").alias("negative_id"), F.col("positive.score").alias("positive_score"), F.col("n.score").alias("negative_score"),
    )
