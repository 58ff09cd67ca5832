"""Exact quantiles and modes that never gather a whole column in one place.

Small inputs use the built-in ``percentile``. It keeps a map of every distinct
value of a column in one task, so above a number of cells quantiles are selected
by bracketing instead: an approximate sketch proposes a narrow value range around
each wanted rank, an exact count of the rows below and inside the range proves
that the rank lies in it, and only the distinct values inside the range (a few
ten-thousandths of the rows) are counted and read. A range that turns out too
wide is narrowed again, one that misses its rank is widened; the answer is exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyspark.operators import facts

DIRECT_CELLS = 4_000_000
ACCURACY = 10_000
# Rows of (value, count) read by the driver for all brackets together.
MAX_CANDIDATES = 200_000


def _number(df: DataFrame, column: str) -> Column:
    return facts.value_of(df.schema[column]).cast("double")


def quantiles(
    df: DataFrame,
    wanted: dict[str, list[float]],
    direct_cells: int = DIRECT_CELLS,
    accuracy: int = ACCURACY,
    max_candidates: int = MAX_CANDIDATES,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, None for a column without values."""
    if not wanted:
        return {}
    if df.count() * len(wanted) <= direct_cells:
        row = df.agg(
            *[
                F.percentile(_number(df, c), F.array(*[F.lit(p) for p in ps])).alias(f"q{i}")
                for i, (c, ps) in enumerate(wanted.items())
            ]
        ).first()
        return {c: list(row[i]) if row[i] is not None else [None] * len(ps) for i, (c, ps) in enumerate(wanted.items())}
    return _by_bracketing(df, wanted, accuracy, max_candidates)


@dataclass
class _Slot:
    """One wanted quantile and the value range known to hold it."""

    column: str
    position: float  # rank among the non-missing values, fractional, from 0
    low: float = -math.inf
    high: float = math.inf
    below: int = 0  # rows with a value under ``low``
    within: int = 0  # rows with a value in the range
    answer: float | None = None

    def holds(self, value: Column) -> Column:
        return (value >= self.low) & (value <= self.high)

    def covers(self, below: int, within: int) -> bool:
        return below <= math.floor(self.position) and math.ceil(self.position) < below + within


def _by_bracketing(
    df: DataFrame, wanted: dict[str, list[float]], accuracy: int, max_candidates: int
) -> dict[str, list[float | None]]:
    columns = {c: _number(df, c) for c in wanted}
    counted = df.agg(*[F.count(v).alias(c) for c, v in columns.items()]).first()
    slots = {
        (c, p): _Slot(c, p * (counted[c] - 1), within=counted[c]) for c, ps in wanted.items() for p in ps if counted[c]
    }
    open_slots = list(slots.values())
    while open_slots:
        _narrow(df, columns, open_slots, accuracy)
        budget = max(max_candidates // len(open_slots), 2)
        unresolved = _read_candidates(df, columns, open_slots, budget)
        # a range that is still too wide is cut finer next time
        accuracy = accuracy * 10 if len(unresolved) == len(open_slots) else accuracy
        open_slots = unresolved
    return {c: [slots[c, p].answer if (c, p) in slots else None for p in ps] for c, ps in wanted.items()}


def _narrow(df: DataFrame, columns: dict[str, Column], slots: list[_Slot], accuracy: int) -> None:
    """Replace each slot's range by a narrower one that provably holds its rank."""
    margin = 2.0 / accuracy
    # slots of a column that still share a range share a sketch
    shared: dict[tuple[str, float, float], list[_Slot]] = {}
    for s in slots:
        shared.setdefault((s.column, s.low, s.high), []).append(s)
    sketches = []
    for i, ((column, _, _), group) in enumerate(shared.items()):
        centres = [(s.position - s.below) / max(s.within - 1, 1) for s in group]
        ranks = [rank for c in centres for rank in (max(0.0, c - margin), min(1.0, c + margin))]
        inside = F.when(group[0].holds(columns[column]), columns[column])
        sketches.append(F.percentile_approx(inside, ranks, accuracy).alias(f"r{i}"))
    row = df.agg(*sketches).first()
    bounds = {}
    for i, group in enumerate(shared.values()):
        for j, s in enumerate(group):
            bounds[id(s)] = (row[i][2 * j], row[i][2 * j + 1])
    proposals = [bounds[id(s)] for s in slots]
    counts = []
    for i, s in enumerate(slots):
        low, high = proposals[i]
        value = columns[s.column]
        counts += [
            F.count_if(value < low).alias(f"b{i}"),
            F.count_if((value >= low) & (value <= high)).alias(f"w{i}"),
        ]
    found = df.agg(*counts).first()
    for i, s in enumerate(slots):
        below, within = found[f"b{i}"], found[f"w{i}"]
        if s.covers(below, within):
            (s.low, s.high), s.below, s.within = proposals[i], below, within


def _read_candidates(df: DataFrame, columns: dict[str, Column], slots: list[_Slot], budget: int) -> list[_Slot]:
    """Resolve the slots whose range holds at most ``budget`` distinct values."""
    cells = F.array_compact(
        F.array(
            *[
                F.when(s.holds(columns[s.column]), F.struct(F.lit(i).alias("slot"), columns[s.column].alias("value")))
                for i, s in enumerate(slots)
            ]
        )
    )
    counted = df.select(F.inline(cells)).groupBy("slot", "value").agg(F.count("*").alias("times"))
    rows = counted.limit(budget * len(slots) + 1).collect()
    if len(rows) > budget * len(slots):
        # too many for one read: settle the ranges that shrank to one value, cut the rest again
        for s in slots:
            if s.low == s.high:
                s.answer = s.low
        return [s for s in slots if s.answer is None]
    per_slot: dict[int, list[tuple[float, int]]] = {}
    for row in rows:
        per_slot.setdefault(row["slot"], []).append((row["value"], row["times"]))
    for i, s in enumerate(slots):
        s.answer = _interpolate(sorted(per_slot[i]), s.position - s.below)
    return []


def _interpolate(pairs: list[tuple[float, int]], position: float) -> float:
    lower, upper = math.floor(position), math.ceil(position)
    seen, ends = 0, {}
    for value, times in pairs:
        for rank in (lower, upper):
            if seen <= rank < seen + times:
                ends[rank] = value
        seen += times
    return ends[lower] + (position - lower) * (ends[upper] - ends[lower])


def medians(df: DataFrame, columns: list[str], **limits: int) -> dict[str, float | None]:
    found = quantiles(df, {c: [0.5] for c in columns}, **limits)
    return {c: values[0] for c, values in found.items()}


def modes(df: DataFrame, columns: list[str]) -> dict[str, str | int | float | None]:
    """The most frequent value per column, the smallest one among equals.

    Values are counted per task first; the winner is an aggregate, not a sort.
    """
    if not columns:
        return {}
    counted = facts.value_counts(df, columns).filter("s IS NOT NULL OR n IS NOT NULL OR d IS NOT NULL")
    value = F.struct("s", "n", "d")
    winners = counted.groupBy("ordinal").agg(F.min_by(value, F.struct(-F.col("times"), value)).alias("mode"))
    found = {row["ordinal"]: row["mode"] for row in winners.collect()}
    position = {c: i for i, c in enumerate(df.columns, start=1)}
    return {
        c: next((v for v in found[position[c]] if v is not None), None) if position[c] in found else None
        for c in columns
    }
