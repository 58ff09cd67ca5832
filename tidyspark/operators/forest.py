"""Random forests that are grown and asked in one go, so that nobody ever holds a whole forest.

The rules are those of MLlib's forests: every tree counts a row as often as a Poisson draw says, every node looks at
features drawn for it, cuts lie between ranges of values, a cut must lower the Gini impurity (regression: the variance),
sibling leaves that say the same are one leaf, and the trees' class shares (regression: means) are added up. Nodes of
many rows are cut by counts that Spark sums over the cluster. Nodes of at most ``NODE_ROWS`` rows are finished by one task
each, which gets the training rows and the rows asked about alike and gives the votes only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyspark.session import keep_table

# Rows of a node that one task finishes, counting those asked about.
NODE_ROWS = 200_000
# Rows of a task that are looked at together, and cells of a working table.
BATCH_ROWS = 100_000
TABLE_CELLS = 4_000_000
# Levels of a feature, and the feature of the counts of a whole node.
LEVELS = 32
WHOLE = -1
# Class shares are rounded to this part, so that their sums are exact in any order.
SHARE = 2.0**40


@dataclass(frozen=True)
class Shape:
    """What all trees have in common; no ``classes`` means regression."""

    classes: int
    width: int
    trees: int
    depth: int
    seed: int

    @property
    def drawn(self) -> int:
        few = math.ceil(math.sqrt(self.width)) if self.classes else math.ceil(self.width / 3)
        return self.width if self.trees == 1 else few


@dataclass
class Top:
    """The nodes that were cut by counts. A node is (tree, place): the root is 1, below n are 2n and 2n + 1."""

    cuts: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)
    leaves: dict[tuple[int, int], tuple[list[int], list[float]]] = field(default_factory=dict)

    def route(self, tree: int, rows: Entries, count: int) -> np.ndarray:
        """The place each row has reached in one tree."""
        place = np.ones(count, np.int64)
        known = sorted((n, *cut) for (t, n), cut in self.cuts.items() if t == tree)
        if not known:
            return place
        nodes, features, levels = np.array(known, np.int64).T
        moving = np.arange(count)
        while len(moving):
            at = np.minimum(np.searchsorted(nodes, place[moving]), len(nodes) - 1)
            found = nodes[at] == place[moving]
            moving, at = moving[found], at[found]
            place[moving] = 2 * place[moving] + rows.reach(moving, features[at], levels[at])
        return place


class Entries:
    """Rows as entries (row, feature, level) of all levels above 0, in order of row and feature."""

    def __init__(self, numbers: pa.ListArray, slots: pa.ListArray, width: int):
        count, self.width = len(numbers), max(width, 1)
        levels = numbers.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        each = len(levels) // count if count else 0
        ones = slots.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = slots.value_lengths().to_numpy(zero_copy_only=False)
        some = levels > 0
        key = np.concatenate([
            (np.repeat(np.arange(count), each) * self.width + np.tile(np.arange(each), count))[some],
            np.repeat(np.arange(count), sizes) * self.width + ones,
        ])
        order = np.argsort(key, kind="stable")
        self.key, self.level = key[order], np.concatenate([levels[some], np.ones(len(ones), np.int64)])[order]
        self.row, self.feature = self.key // self.width, self.key % self.width

    def reach(self, row: np.ndarray, feature: np.ndarray, level: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.zeros(len(row), np.int64)
        key = row * self.width + feature
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return ((self.key[at] == key) & (self.level[at] >= level)).astype(np.int64)


def _mixed(*parts) -> np.ndarray:
    """A 64-bit hash of numbers, elementwise."""
    held = np.zeros(1, np.uint64)
    for part in parts:
        held = (held ^ np.asarray(part).astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
        held = (held ^ (held >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        held = (held ^ (held >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        held = held ^ (held >> np.uint64(31))
    return held


def _is_drawn(tree: int, nodes: np.ndarray, which: np.ndarray, feature: np.ndarray, shape: Shape) -> np.ndarray:
    """Whether ``feature`` is drawn for the node number ``which`` of ``nodes``, which are places in the tree."""
    if shape.drawn >= shape.width:
        return np.ones(len(which), bool)
    result, step = np.zeros(len(which), bool), max(1, TABLE_CELLS // shape.width)
    features = np.arange(shape.width)
    for start in range(0, len(nodes), step):
        marks = _mixed(shape.seed, tree, nodes[start : start + step, None], features)
        drawn = np.zeros(marks.shape, bool)
        np.put_along_axis(drawn, np.argpartition(marks, shape.drawn - 1, axis=1)[:, : shape.drawn], True, axis=1)
        inside = np.flatnonzero((which >= start) & (which < start + step)) if len(nodes) > step else slice(None)
        result[inside] = drawn[which[inside] - start, feature[inside]]
    return result


class Totals:
    """Weights of nodes 0, 1, ... as a whole and by class, or their means. Each node has a row of some weight."""

    def __init__(self, node: np.ndarray, label: np.ndarray, weight: np.ndarray, value, square, shape: Shape):
        if shape.classes:
            self.keys, inverse = np.unique(node * shape.classes + label, return_inverse=True)
            self.counts = np.bincount(inverse, weights=weight).astype(np.int64)
            self.node, self.label = self.keys // shape.classes, self.keys % shape.classes
            first = np.flatnonzero(np.diff(self.node, prepend=-1))
            self.weight = np.add.reduceat(self.counts, first)
            self.norm = np.add.reduceat(self.counts * self.counts, first)
            self.mixed = np.diff(first, append=len(self.keys)) > 1
            most = np.flatnonzero(self.counts == np.maximum.reduceat(self.counts, first)[self.node])[::-1]
            self.says = np.zeros(len(first), np.int64)
            self.says[self.node[most]] = self.label[most]  # the smallest of several comes last
        else:
            self.weight = np.bincount(node, weights=weight)
            self.mean = np.bincount(node, weights=value) / self.weight
            raw = np.bincount(node, weights=square)
            # of single rows the squares are taken around the mean, which is exact; of sums they cannot be
            lone = np.divide(value, weight, out=np.zeros(len(value)), where=weight > 0)
            around = weight * (lone - self.mean[node]) ** 2 + np.maximum(square - lone * value, 0.0)
            self.spread = np.bincount(node, weights=around)
            self.mixed = self.spread > 1e-24 * raw


def _best_cuts(node, feature, level, label, weight, value, totals: Totals, shape: Shape):
    """The best cut of each node: whether there is one, its feature, and the least level on its right side. Given are
    entries of some weight. Ties go to the first feature and the lowest level."""
    count = len(totals.weight)
    found, features, levels = np.zeros(count, bool), np.zeros(count, np.int64), np.zeros(count, np.int64)
    if not len(node):
        return found, features, levels
    key = (node * shape.width + (shape.width - 1 - feature)) * LEVELS + (LEVELS - 1 - level)
    order = np.argsort(key)
    key, node, feature, level, weight = key[order], node[order], feature[order], level[order], weight[order]
    fresh = np.diff(key // LEVELS, prepend=-1) != 0
    group, first = np.cumsum(fresh) - 1, np.flatnonzero(fresh)

    def running(values: np.ndarray) -> np.ndarray:
        sums = np.cumsum(values)
        return sums - (sums[first] - values[first])[group]

    right = running(weight)
    left = totals.weight[node] - right
    if shape.classes:
        # sums of squared class weights on both sides, kept up entry by entry, for any number of classes
        label = label[order]
        own = group * shape.classes + label
        by = np.argsort(own * len(own) + np.arange(len(own)))
        sums, own = np.cumsum(weight[by]), own[by]
        start = np.flatnonzero(np.diff(own, prepend=-1))
        before = sums - weight[by]
        before -= np.repeat(before[start], np.diff(start, append=len(own)))
        prior = np.empty_like(before)
        prior[by] = before
        squares = running(weight * (2 * prior + weight))
        whole = totals.counts[np.searchsorted(totals.keys, node * shape.classes + label)]
        rest = totals.norm[node] - 2 * running(whole * weight) + squares
        least = totals.norm / totals.weight * (1 + 1e-14)
    else:
        sums = running(value[order] - totals.mean[node] * weight)
        squares = rest = sums * sums
        least = totals.spread * 1e-12
    follower = np.append(np.where(fresh[1:], 0, level[1:]), 0)
    ends = (np.append(fresh[1:], True) | (follower != level)) & (left > 0) & (right > 0)
    at = np.flatnonzero(ends)
    gain = rest[at] / left[at] + squares[at] / right[at]
    best = least.astype(float)
    np.maximum.at(best, node[at], gain)
    near = best if shape.classes else best * (1 - 1e-9)  # sums of numbers differ by the order they are added in
    hits = at[(gain >= near[node[at]]) & (gain > least[node[at]])]
    found[node[hits]] = True
    features[node[hits]], levels[node[hits]] = feature[hits], follower[hits] + 1  # the last hit of a node stays
    return found, features, levels


def _finished(tree: int, root: int, rows: Entries, label: np.ndarray, weight: np.ndarray, shape: Shape):
    """Grow the tree below one node and ask it. Gives positions of rows of no weight, classes and votes, and what the
    node says if all below it became one leaf, else None."""
    count = len(weight)
    node, number, right = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count, np.int64)
    if shape.classes:
        label = label.astype(np.int64)
    value = label * weight
    square = label * value
    row, feature, level, learns = rows.row, rows.feature, rows.level, weight[rows.row] > 0
    places, live, base, layers = np.array([root], np.int64), np.arange(count), 0, []
    while True:
        learn = live[weight[live] > 0]
        totals = Totals(node[learn], label[learn], weight[learn], value[learn], square[learn], shape)
        number[live] = base + node[live]
        below = np.full(len(places), -1)
        layers.append((base, totals, below))
        if int(places[0]).bit_length() > shape.depth:
            break
        owner = node[row]
        use = np.flatnonzero(learns & totals.mixed[owner])
        use = use[_is_drawn(tree, places, owner[use], feature[use], shape)]
        some = row[use]
        found, features, levels = _best_cuts(
            owner[use], feature[use], level[use], label[some], weight[some], value[some], totals, shape
        )
        if not found.any():
            break
        base += len(places)
        below[found] = base + 2 * np.arange(found.sum())
        keep = np.flatnonzero(found[owner])
        row, feature, level, learns, owner = row[keep], feature[keep], level[keep], learns[keep], owner[keep]
        hit = (feature == features[owner]) & (level >= levels[owner])
        right[live] = 0
        right[row[hit]] = 1
        live = live[found[node[live]]]
        node[live] = 2 * (np.cumsum(found) - 1)[node[live]] + right[live]
        places = np.repeat(2 * places[found], 2)
        places[1::2] += 1

    below = np.concatenate([b for _, _, b in layers])
    leaf, stays = below < 0, np.arange(len(below))
    says = np.concatenate([t.says for _, t, _ in layers]) if shape.classes else np.arange(len(below))
    for base, _, children in reversed(layers):
        inner = base + np.flatnonzero(children >= 0)
        low = below[inner]
        leaf[inner] = leaf[low] & leaf[low + 1] & (says[low] == says[low + 1])
        same = inner[leaf[inner]]
        says[same] = says[below[same]]
    for base, _, children in layers:
        inner = base + np.flatnonzero(children >= 0)
        inner = inner[leaf[inner] | (stays[inner] != inner)]
        stays[below[inner]] = stays[below[inner] + 1] = stays[inner]

    asked = np.flatnonzero(weight == 0)
    ends = stays[number[asked]]
    said = int(says[0]) if shape.classes and leaf[0] else None
    if not shape.classes:
        return asked, np.zeros(len(asked), np.int64), np.concatenate([t.mean for _, t, _ in layers])[ends], said
    owner = np.concatenate([base + t.node for base, t, _ in layers])
    classes = np.concatenate([t.label for _, t, _ in layers])
    shares = np.concatenate([np.rint(t.counts / t.weight[t.node] * SHARE) for _, t, _ in layers])
    first, last = np.searchsorted(owner, ends), np.searchsorted(owner, ends, side="right")
    which, sizes = np.repeat(np.arange(len(asked)), last - first), last - first
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[which]
    return asked[which], classes[at], shares[at], said


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fewer, larger batches."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BATCH_ROWS:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def _column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _entries(batch: pa.RecordBatch, shape: Shape) -> Entries:
    return Entries(batch.column("numbers"), batch.column("slots"), shape.width)


def _times(batch: pa.RecordBatch, shape: Shape) -> np.ndarray:
    return batch.column("weights").flatten().to_numpy(zero_copy_only=False).reshape(-1, shape.trees).astype(np.int64)


def _weighted(cells: DataFrame, shape: Shape) -> DataFrame:
    """Cells with the weight each tree gives them: equal rows are drawn together, as the sum of draws of Poisson(1) is
    one of Poisson(their number); a single tree takes every row once. Draws hang on the cell alone, so they are the same wherever it lies. Cells asked
    about have weight 0."""

    def run(batches):
        for batch in batches:
            weights = np.zeros((batch.num_rows, shape.trees), np.int32)
            times, keys = _column(batch, "times"), _column(batch, "key").view(np.uint64)
            for row in np.flatnonzero(_column(batch, "training")):
                draw = np.random.Generator(np.random.Philox(key=int(keys[row])))
                weights[row] = draw.poisson(times[row], shape.trees) if shape.trees > 1 else times[row]
            offsets = pa.array(np.arange(batch.num_rows + 1) * shape.trees, pa.int32())
            yield batch.append_column("weights", pa.ListArray.from_arrays(offsets, pa.array(weights.ravel(), pa.int32())))

    rows = cells.select(
        F.monotonically_increasing_id().alias("id"), F.xxhash64(F.lit(shape.seed), "numbers", "slots", "label").alias("key"),
        F.col("numbers").cast("array<tinyint>").alias("numbers"), "slots", "label", "training", "times",
    )
    return keep_table(rows.mapInArrow(run, rows.schema.simpleString()[7:-1] + ",weights:array<int>"))


ITEMS = "tree int, node bigint, feature int, level int, label int, weight bigint, value double, square double, number bigint"
FOUND = (
    "tree int, node bigint, feature int, level int, number bigint, right bigint, classes array<int>, votes array<double>, "
    "says int"
)


def _counted(rows: DataFrame, top: Top, nodes: list[tuple[int, int]], shape: Shape) -> DataFrame:
    """For the given nodes, counts by feature drawn, level and class, and of whole nodes."""
    wanted = {t: np.array(sorted(n for u, n in nodes if u == t)) for t in {t for t, _ in nodes}}

    def run(batches):
        for batch in _joined(batches):
            data, weights, asked = _entries(batch, shape), _times(batch, shape), ~_column(batch, "training")
            y = _column(batch, "label")
            label = y.astype(np.int64) if shape.classes else np.zeros(len(y), np.int64)
            classes = max(shape.classes, 1)
            for tree, places in wanted.items():
                weight = weights[:, tree]
                place = top.route(tree, data, batch.num_rows)
                node = np.minimum(np.searchsorted(places, place), len(places) - 1)
                inside = (places[node] == place) & ((weight > 0) | asked)
                use = inside[data.row]
                use[use] = _is_drawn(tree, places, node[data.row[use]], data.feature[use], shape)
                row = np.concatenate([np.flatnonzero(inside), data.row[use]])
                if not len(row):
                    continue
                whole = np.zeros(inside.sum(), np.int64)
                feature = np.concatenate([whole + WHOLE, data.feature[use]])
                key = (node[row] * (shape.width + 1) + feature + 1) * LEVELS + np.concatenate([whole, data.level[use]])
                key = key * classes + label[row]
                if len(places) * (shape.width + 1) * LEVELS * classes <= TABLE_CELLS:
                    keys = np.flatnonzero(np.bincount(key))
                    total = lambda x: np.bincount(key, weights=x)[keys]  # noqa: E731, B023
                else:
                    keys, inverse = np.unique(key, return_inverse=True)
                    total = lambda x: np.bincount(inverse, weights=x)  # noqa: E731, B023
                cell, level = keys // classes // LEVELS, keys // classes % LEVELS
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(keys), tree), pa.int32()), pa.array(places[cell // (shape.width + 1)], pa.int64()),
                        pa.array(cell % (shape.width + 1) - 1, pa.int32()), pa.array(level, pa.int32()),
                        pa.array(keys % classes, pa.int32()), pa.array(total(weight[row]).astype(np.int64), pa.int64()),
                        pa.array(total((weight * y)[row])), pa.array(total((weight * y * y)[row])),
                        pa.array(total(np.ones(len(row))).astype(np.int64), pa.int64()),
                    ],
                    names=["tree", "node", "feature", "level", "label", "weight", "value", "square", "number"],
                )

    sums = [F.sum(c).alias(c) for c in ("weight", "value", "square", "number")]
    return rows.mapInArrow(run, ITEMS).groupBy("tree", "node", "feature", "level", "label").agg(*sums)


def _cut(counts: DataFrame, shape: Shape) -> DataFrame:
    """One row per node: the best cut if there is one, rows in all and on its right side, and the node's own vote."""

    def run(table: pa.Table) -> pa.Table:
        feature, level, label, weight, value, square, number = (
            _column(table, c) for c in ("feature", "level", "label", "weight", "value", "square", "number")
        )
        label, level, feature = label.astype(np.int64), level.astype(np.int64), feature.astype(np.int64)
        whole = feature == WHOLE
        own = whole & (weight > 0)
        zeros = np.zeros(len(feature), np.int64)
        totals = Totals(zeros[own], label[own], weight[own], value[own], square[own], shape)
        use = ~whole & (weight > 0)
        found, features, levels = _best_cuts(
            zeros[use], feature[use], level[use], label[use], weight[use], value[use], totals, shape
        )
        cut = bool(found[0]) and bool(totals.mixed[0])
        votes = np.rint(totals.counts / totals.weight[0] * SHARE) if shape.classes else totals.mean
        row = {
            "tree": table["tree"][0].as_py(), "node": table["node"][0].as_py(),
            "feature": int(features[0]) if cut else None, "level": int(levels[0]) if cut else None,
            "number": int(number[whole].sum()), "right": int(number[(feature == features[0]) & (level >= levels[0])].sum()) if cut else None,
            "classes": (totals.label if shape.classes else np.zeros(1, int)).tolist(), "votes": votes.tolist(),
            "says": int(totals.says[0]) if shape.classes else None,
        }
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int32()]
        return pa.Table.from_pylist([row], pa.schema(list(zip(row, kinds))))

    return counts.groupBy("tree", "node").applyInArrow(run, FOUND)


def _top(rows: DataFrame, shape: Shape) -> tuple[Top, dict]:
    """Cut nodes by counts, a level in each pass, until those left have at most ``NODE_ROWS`` rows. Also gives what was
    found at each of these nodes."""
    top, nodes = Top(), {}
    large = [(t, 1) for t in range(shape.trees)] if rows.count() > NODE_ROWS else []
    while large:
        found, large = _cut(_counted(rows, top, large, shape), shape).collect(), []
        for r in found:
            at = r["tree"], r["node"]
            nodes[at] = r
            if r["feature"] is None or r["node"].bit_length() > shape.depth:
                top.leaves[at] = r["classes"], r["votes"]
                continue
            top.cuts[at] = r["feature"], r["level"]
            sides = (r["node"] * 2, r["number"] - r["right"]), (r["node"] * 2 + 1, r["right"])
            large += [(r["tree"], place) for place, number in sides if number > NODE_ROWS]
    return top, nodes


VOTES = "tree int, node bigint, id bigint, label int, vote double"


def _votes(tree: int, node, ids, classes, votes) -> dict[str, pa.Array]:
    return {
        "tree": pa.array(np.full(len(ids), tree), pa.int32()), "node": pa.array(np.broadcast_to(node, len(ids)), pa.int64()),
        "id": pa.array(ids, pa.int64()), "label": pa.array(classes, pa.int32()), "vote": pa.array(votes, pa.float64()),
    }


def _below(rows: DataFrame, top: Top, shape: Shape) -> DataFrame:
    """The votes of all nodes below the top; a row without ``id`` names a node that became one leaf."""

    def spread(batches):
        for batch in _joined(batches):
            data, weights, asked = _entries(batch, shape), _times(batch, shape), ~_column(batch, "training")
            for tree in range(shape.trees):
                place, weight = top.route(tree, data, batch.num_rows), weights[:, tree]
                done = np.isin(place, [n for t, n in top.leaves if t == tree])
                use = np.flatnonzero(((weight > 0) | asked) & ~done)
                part = batch.select(["id", "numbers", "slots", "label"]).take(pa.array(use))
                part = part.add_column(0, "weight", pa.array(weight[use], pa.int64()))
                part = part.add_column(0, "node", pa.array(place[use], pa.int64()))
                yield part.add_column(0, "tree", pa.array(np.full(len(use), tree), pa.int32()))

    def finish(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        batch = table.to_batches()[0]
        tree, node, weight = batch["tree"][0].as_py(), batch["node"][0].as_py(), _column(batch, "weight")
        asked, classes, votes, said = _finished(tree, node, _entries(batch, shape), _column(batch, "label"), weight, shape)
        result = pa.table(_votes(tree, node, _column(batch, "id")[asked], classes, votes))
        if said is None:
            return result
        mark = pa.table({**_votes(tree, node, [0], [said], [0.0]), "id": pa.array([None], pa.int64())})
        return pa.concat_tables([result, mark])

    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(8 * cores, shape.trees + len(top.cuts))
    kinds = "tree int, node bigint, weight bigint, id bigint, numbers array<tinyint>, slots array<int>, label double"
    groups = rows.mapInArrow(spread, kinds).repartition(parts, "tree", "node").groupBy("tree", "node")
    return keep_table(groups.applyInArrow(finish, VOTES))


def _at_leaves(rows: DataFrame, top: Top, shape: Shape) -> DataFrame:
    """The votes of the leaves in the top."""

    def run(batches):
        for batch in _joined(batches):
            data, ids = _entries(batch, shape), _column(batch, "id")
            for tree in {t for t, _ in top.leaves}:
                place = top.route(tree, data, batch.num_rows)
                for node in set(place.tolist()):
                    if (tree, node) in top.leaves:
                        classes, votes = top.leaves[tree, node]
                        here = ids[place == node]
                        columns = _votes(tree, node, np.repeat(here, len(classes)), np.tile(classes, len(here)), np.tile(votes, len(here)))
                        yield pa.RecordBatch.from_pydict(columns)

    return rows.filter("NOT training").mapInArrow(run, VOTES)


def _merge_leaves(top: Top, nodes: dict, marks: DataFrame) -> set[tuple[int, int]]:
    """Make siblings of the top that are leaves and say the same one leaf. Gives the nodes below the top this ends."""
    says = {(r["tree"], r["node"]): r["label"] for r in marks.collect()}
    below = set(says)
    says |= {at: nodes[at]["says"] for at in top.leaves}
    ended = set()
    for tree, node in sorted(top.cuts, key=lambda at: -at[1]):
        sides = [(tree, 2 * node), (tree, 2 * node + 1)]
        if all(s in says for s in sides) and says[sides[0]] == says[sides[1]]:
            found = nodes[tree, node]
            says[tree, node] = says[sides[0]]
            top.leaves[tree, node] = found["classes"], found["votes"]
            del top.cuts[tree, node]
            for side in sides:
                top.leaves.pop(side, None)
            ended |= below & set(sides)
    return ended


def predict(cells: DataFrame, classes: int, trees: int, depth: int, seed: int) -> DataFrame:
    """``label, prediction, times`` for the rows of ``cells`` not in training. A cell is a set of equal rows: levels
    ``numbers`` from 0 to 31, ascending ``slots`` of ones after them, ``width``, ``label``, ``training``, ``times``.
    Without ``classes`` labels are numbers."""
    shape = Shape(classes, cells.select("width").first()[0], trees, depth, seed)
    rows = _weighted(cells, shape)
    top, nodes = _top(rows, shape)
    votes = _below(rows, top, shape)
    given = votes.filter("id IS NOT NULL")
    if top.cuts and classes:
        ended = _merge_leaves(top, nodes, votes.filter("id IS NULL"))
        if ended:
            gone = rows.sparkSession.createDataFrame(sorted(ended), "tree int, node bigint")
            given = given.join(F.broadcast(gone), ["tree", "node"], "left_anti")
    if top.leaves:
        given = given.unionByName(_at_leaves(rows, top, shape))
    if classes:
        sums = given.groupBy("id", "label").agg(F.sum("vote").alias("vote"))
        answer = sums.groupBy("id").agg(F.max_by("label", F.struct("vote", -F.col("label"))).cast("double").alias("prediction"))
    else:
        answer = given.groupBy("id").agg((F.sum("vote") / trees).alias("prediction"))
    return rows.filter("NOT training").select("id", "label", "times").join(answer, "id").select("label", "prediction", "times")
