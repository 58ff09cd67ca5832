"""Jaccard join of documents on sets of word shingles, by combinations of tokens from extended prefixes.

A token is a shingle's hash. All tokens are put into one order, those of rarer words first (by a table of word
counters of fixed size, then by value). Two sets that overlap enough can differ in few tokens only, so a prefix of one
more token than that must hold one that both have. Tokens of short posting lists are indexed alone. Tokens
of longer lists belong to a class of width k: their combinations of k are indexed instead, and as k - 1 of
them may be shared without any shared combination, they count k - 1 less and the prefix is extended until
the count is reached. In long prefixes the tokens of a class are dealt to bins, and combinations are taken
within a bin; the number of bins follows from the set's size, and sets near a change of that number are
indexed for both.

Equal sets are one set from the start. Sets that share a key are candidates: the members of a key are compared
with a hub, another one each round, and where they still lie in different components, with each other, after a histogram of their
tokens has ruled out most pairs (the histograms' distance never exceeds the sets' difference): first along the nearest pairs
that connect them, one fewer than there are components, then in every pair that these left apart, in one key only. All
comparisons are exact. Links are then counted inside the components, block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.llm import words
from tidyspark.llm.bagminhash import _merged as merged_components
from tidyspark.llm.bagminhash import components
from tidyspark.llm.common import Bitmap, join_with_hot, list_array, small_batches, stored, texts
from tidyspark.operators.keyed import fits_broadcast, look_up

WORDS, PERCENT = 3, 90
SPACES = words.byte_set(0x20, *range(0x09, 0x0E))
BATCH_BYTES = 1 << 21
#: Counters that order the tokens, and how many of them travel in one row.
COUNTERS, COUNTER_SLICE = 1 << 20, 4_096
#: Posting lists longer than these put a token into the classes of width 2 and 3.
WIDTHS = {2: 64, 3: 2_048}
#: Frequent tokens of a prefix that a bin holds, about.
BIN_TOKENS = 8
BUCKETS, PAIR_ROWS, COUNT_ROWS, COUNT_TOKENS = 256, 2_048, 512, 4_096
#: What tells a pair of blocks of a key, and pairs of rows whose histograms are compared at once.
BLOCK, LOOK_PAIRS = ["key", "l", "r"], 1 << 14
#: Rounds of comparisons with one member of each key before members that are still apart meet.
HUBS = 2
#: Buckets of the histogram that are added up for a first look, and keys of a set that tell in which key a pair is given.
COARSE, SKETCH_KEYS = 8, 16
#: Rows of at most a hundred bytes that may be broadcast.
BROADCAST_ROWS = 1 << 19


def shingle_sets(values: list[str], size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, counts, hashed, places): the distinct tokens of every text, ascending, and how many each text has; the hashes
    of all words, and where among them each token has its words (-1 beyond a short text)."""
    data, ends = words.joined(values, b" ")
    first, length = words.places(data, SPACES)
    hashed = words.hashes(data, first, length)
    counts = np.diff(np.searchsorted(first, ends), prepend=0)
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), shingles)
    at = np.arange(len(owner)) + np.repeat(np.cumsum(counts) - counts - np.cumsum(shingles) + shingles, shingles)
    taken = np.minimum(counts, size)[owner]
    value = words.mixed(taken.astype(np.uint64))
    for j in range(size):
        more = taken > j
        value = np.where(more, words.mixed(value * words.PRIME + hashed[np.minimum(at + j, max(len(hashed) - 1, 0))]), value)
    order = owner_order(owner, value)
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    places = at[order[new], None] + np.arange(size)
    places[np.arange(size) >= taken[order[new], None]] = -1
    return value[new], np.bincount(owner[new], minlength=len(values)), hashed, places


def owner_order(owner: np.ndarray, value: np.ndarray, rank: np.ndarray | None = None) -> np.ndarray:
    """The order by owner, then rank (a byte or two), then value: one sort of their upper bits unless these are not enough."""
    bits = max(int(owner[-1]).bit_length(), 1) if len(owner) else 1
    key = owner.astype(np.uint64) << words.U(64 - bits)
    if rank is not None:
        key |= rank.astype(np.uint64) << words.U(54 - bits)
        bits += 10
    order = np.argsort(key | value >> words.U(bits))
    ordered, wholly = (key | value >> words.U(bits))[order], value[order]
    if ((ordered[1:] == ordered[:-1]) & (wholly[1:] != wholly[:-1])).any():
        return np.lexsort((value, owner) if rank is None else (value, rank, owner))
    return order


def counter_of(hashed: np.ndarray) -> np.ndarray:
    return (hashed & words.U(COUNTERS - 1)).astype(np.int64)


def _named_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(batch, tokens, counts, names, hashed, places); a set's name is the first half of its SHA-256, None if it is empty."""
    for batch in small_batches(batches, "text", BATCH_BYTES):
        tokens, counts, hashed, places = shingle_sets(batch.column("text").to_pylist())
        ends = np.cumsum(counts)
        names = [hashlib.sha256(tokens[e - n : e].tobytes()).digest()[:16] if n else None for e, n in zip(ends, counts)]
        yield batch, tokens, counts, names, hashed, places


def _signed(source: DataFrame) -> DataFrame:
    """(doc_id, set, size) of every row; rows with a ``slice`` hold a part of the task's word counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["doc_id", "set", "size", "slice", "counts"]
        kind = total = None
        for batch, _, counts, names, hashed, _ in _named_sets(batches):
            kind = batch.schema.field("doc_id").type
            found = np.bincount(counter_of(hashed), minlength=COUNTERS)
            total = found if total is None else total + found
            none = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.binary()), pa.array(counts, pa.int64()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())],
                columns,
            )
        if total is not None:
            parts = total.reshape(-1, COUNTER_SLICE).astype(np.uint32)  # a task's words
            none = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(none, kind), pa.nulls(none, pa.binary()), pa.nulls(none, pa.int64()), pa.array(np.arange(none), pa.int32()),
                 pa.array([p.tobytes() for p in parts], pa.binary())],
                columns,
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, set binary, size bigint, slice int, counts binary")


def _rarity(signed: DataFrame) -> np.ndarray:
    """One byte per counter, the lower the rarer: half steps of the logarithm of all tasks' sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["slice", "counts"]
        )

    parts = signed.filter("slice IS NOT NULL").select("slice", "counts")
    summed = parts.repartition("slice").mapInArrow(run, "slice int, counts binary").collect()  # COUNTERS longs at any size
    total = np.zeros((COUNTERS // COUNTER_SLICE, COUNTER_SLICE), np.int64)
    for row in summed:
        total[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    return np.floor(2 * np.log2(total.ravel() + 1.0)).astype(np.uint8)


def errors_allowed(size, percent: int):
    """Tokens of a set of this size that a linked set may lack, at most."""
    return size * (100 - percent) // 100


def bin_level(size: int, percent: int) -> int:
    return (int(errors_allowed(size, percent)) // BIN_TOKENS).bit_length()


def prefix_length(size: int, percent: int) -> int:
    """Tokens that suffice for a prefix whatever their classes."""
    spare = sum(k - 1 for k in WIDTHS) << bin_level(size, percent)
    return min(size, int(errors_allowed(size, percent)) + 1 + spare)


def _prefixes(source: DataFrame, rarity, percent: int) -> DataFrame:
    """(set, size, tokens): of each different set that can link to another the first tokens in the common order."""
    least = percent / (100 - percent) if percent < 100 else np.inf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, counts, names, hashed, places in _named_sets(batches):
            owner = np.repeat(np.arange(len(counts)), counts)
            rare = np.append(rarity.value[counter_of(hashed)], np.uint8(0))[places].sum(axis=1)
            order = owner_order(owner, tokens, rare)
            lengths = np.array([prefix_length(n, percent) if n >= least else 0 for n in counts], np.int64)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            first = tokens[order][place < lengths[owner]].view(np.int64)
            some = np.flatnonzero(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in some], pa.binary()), pa.array(counts[some], pa.int64()),
                 list_array(first, np.append(0, np.cumsum(lengths[some])), pa.int64())],
                ["set", "size", "tokens"],
            )

    found = source.mapInArrow(run, "set binary, size bigint, tokens array<bigint>")
    return found.groupBy("set").agg(F.first("size").alias("size"), F.first("tokens").alias("tokens"))


@lru_cache(maxsize=256)
def _choices(n: int, k: int) -> np.ndarray:
    return np.array(list(combinations(range(n), k)), np.int64).reshape(-1, k)


def _combined(tokens: np.ndarray, k: int) -> np.ndarray:
    """Keys of all combinations of ``k`` of the tokens."""
    chosen = tokens[_choices(len(tokens), k)]
    keys = np.full(len(chosen), k, np.uint64)
    for j in range(k):
        keys = words.mixed(keys * words.PRIME + chosen[:, j])
    return keys


def prefix_keys(tokens: np.ndarray, widths: np.ndarray, size: int, percent: int, repeated: np.ndarray | None = None) -> np.ndarray:
    """The keys of a set: ``tokens`` in the common order, ``widths`` their classes. Two sets that link have one in common.
    Tokens alone are keys only if they are ``repeated``, that is, may be in another set's prefix."""
    need = int(errors_allowed(size, percent)) + 1
    repeated = np.ones(len(tokens), bool) if repeated is None else repeated
    found = [np.zeros(0, np.uint64)]
    # A linked set is smaller by ``percent`` at most; both are indexed for the bins of the smaller one.
    for level in range(bin_level(-(-percent * size // 100), percent), bin_level(size, percent) + 1):
        if (widths[:need] == 1).all():
            found.append(words.mixed(tokens[:need][repeated[:need]] + words.U(1)))
            continue
        bins = np.where(widths > 1, (words.mixed(tokens ^ words.SPREAD2) & words.U((1 << level) - 1)).astype(np.int64), 0)
        group = widths.astype(np.int64) << 40 | bins
        order = np.argsort(group, kind="stable")
        ordered = group[order]
        nth = np.empty(len(group), np.int64)
        nth[order] = np.arange(len(group)) - np.searchsorted(ordered, ordered)
        counted = np.cumsum(nth >= widths - 1)
        end = int(np.searchsorted(counted, need)) + 1
        for g in np.unique(group[:end]):
            at, width = np.flatnonzero(group[:end] == g), int(g >> 40)
            found.append(words.mixed(tokens[at[repeated[at]]] + words.U(1)) if width == 1 else _combined(tokens[at], width))
    return np.unique(np.concatenate(found)).view(np.int64)


def _classed(prefixes: DataFrame) -> tuple[DataFrame, Bitmap]:
    """``prefixes`` with the classes of the frequent tokens among theirs, and a bitmap of the tokens in several of them."""
    width = F.lit(None).cast("int")
    for k, above in sorted(WIDTHS.items()):
        width = F.when(F.col("count") > above, k).otherwise(width)
    every = prefixes.select("set", F.explode("tokens").alias("token"))
    counted = stored(every.groupBy("token").count().filter("count > 1"), "counted")
    frequent = counted.filter(F.col("count") > min(WIDTHS.values())).select("token", width.alias("width"))
    hits = look_up(every, frequent, "token", ["set"], how="inner").groupBy("set").agg(
        F.collect_list("token").alias("frequent"), F.collect_list("width").alias("widths")
    )
    return prefixes.join(hits, "set", "left"), Bitmap.of(counted, F.col("token"))


def _keyed(classed: DataFrame, percent: int, repeated: Bitmap) -> DataFrame:
    """(set, size, key): every set under its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = [np.zeros(0, np.int64)], []
            for size, tokens, frequent, wide in zip(*(batch.column(c) for c in ("size", "tokens", "frequent", "widths"))):
                tokens = tokens.values.to_numpy().view(np.uint64)
                widths = np.ones(len(tokens), np.int8)
                if frequent.is_valid:
                    listed = frequent.values.to_numpy().view(np.uint64)
                    order = np.argsort(listed)
                    at = np.minimum(np.searchsorted(listed, tokens, sorter=order), len(listed) - 1)
                    hit = listed[order[at]] == tokens
                    widths[hit] = wide.values.to_numpy()[order[at[hit]]]
                keys.append(prefix_keys(tokens, widths, size.as_py(), percent, repeated.holds(tokens)))
                counts.append(len(keys[-1]))
            offsets = np.append(0, np.cumsum(counts, dtype=np.int64))
            arrays = [batch.column("set"), batch.column("size"), list_array(np.concatenate(keys), offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["set", "size", "keys"])

    signed = classed.mapInArrow(run, "set binary, size bigint, keys array<bigint>")
    return signed.select("set", "size", F.explode("keys").alias("key"))


def histogram(tokens: np.ndarray) -> np.ndarray:
    counts = np.bincount((tokens >> words.U(56)).astype(np.int64), minlength=BUCKETS)
    return np.minimum(counts, 65_535).astype(np.uint16)


def _contents(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, items, histogram) of the wanted sets."""
    # Names are digests: their first bytes are hashes.
    bitmap = Bitmap.of(wanted, F.conv(F.hex(F.substring("set", 1, 7)), 16, 10).cast("bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, counts, names, *_ in _named_sets(batches):
            ends = np.cumsum(counts)
            kept = bitmap.holds(np.array([int.from_bytes((name or b"")[:7]) for name in names], np.int64))
            rows = [(name, tokens[e - n : e]) for name, e, n, k in zip(names, ends, counts, kept) if name and k]
            columns = [[r[0] for r in rows], [r[1].tobytes() for r in rows], [histogram(r[1]).tobytes() for r in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["set", "items", "histogram"])

    rows = source.mapInArrow(run, "set binary, items binary, histogram binary")
    rows = rows.groupBy("set").agg(F.first("items").alias("items"), F.first("histogram").alias("histogram"))
    return rows.join(wanted, "set", "left_semi")


def _verified(pairs: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "x", 1 << 24):
            kept = []
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    pairs = pairs.select("a", "b")
    left, right = _with_contents(pairs, "a", contents, "items", "x"), _with_contents(pairs, "b", contents, "items", "y")
    sides = left.join(right, ["a", "b"]).select("a", "b", "x", "y")
    return sides.mapInArrow(run, "a binary, b binary")


def _blocks(rows: DataFrame, key: str, block_rows: int) -> DataFrame:
    """``rows`` (with ``n``, the rows of their key) once for every pair of blocks of their key that they are in;
    ``side`` is 1 for the right block of a pair of two."""
    many = F.ceil(F.col("n") / block_rows).cast("int")
    dealt = rows.withColumn("many", many).withColumn("own", F.pmod(F.xxhash64("set"), F.col("many")).cast("int"))
    left = dealt.withColumn("r", F.explode(F.sequence("own", F.col("many") - 1))).withColumn("l", F.col("own"))
    right = dealt.filter("own > 0").withColumn("l", F.explode(F.sequence(F.lit(0), F.col("own") - 1))).withColumn("r", F.col("own"))
    return left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1))).drop("many", "own")


def _sides(block: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    left = block[block["side"] == 0]
    return (left, left) if block["l"].iat[0] == block["r"].iat[0] else (left, block[block["side"] == 1])


def _whole_blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Batches of rows sorted by ``columns``, cut so that no group of equal values lies in two of them and that they have about
    as many pairs as one block may have."""
    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if kept is not None:
            table = pa.concat_tables([kept, table]).combine_chunks()
        starts = np.flatnonzero(_new_groups(table, columns))
        part = np.append(0, np.cumsum(np.diff(starts) ** 2)) // PAIR_ROWS**2
        cuts = starts[np.unique(part[:-1], return_index=True)[1]].tolist() + starts[-1:].tolist()
        for start, end in zip(cuts, cuts[1:]):
            yield table.slice(start, end - start)
        if cuts:
            kept = table.slice(cuts[-1])
    if kept is not None:
        yield kept


def _new_groups(table: pa.Table, columns: list[str]) -> np.ndarray:
    new = np.ones(table.num_rows, bool)
    values = [table.column(c).to_numpy() for c in columns]
    new[1:] = np.any([v[1:] != v[:-1] for v in values], axis=0)
    return new


def _near(rows: pa.Table, percent: int) -> tuple[np.ndarray, ...]:
    """(block, i, j, difference, root of i, root of j) of all pairs of rows of a block that sizes and histograms do not rule
    out; blocks are whole, their rows ascend by side, then size; roots are numbers."""
    block = np.cumsum(_new_groups(rows, BLOCK)) - 1
    side, size = rows.column("side").to_numpy().astype(np.int64), rows.column("size").to_numpy()
    x = np.frombuffer(b"".join(rows.column("histogram").to_pylist()), np.uint16).reshape(-1, BUCKETS)
    rough = x.reshape(len(x), BUCKETS // COARSE, COARSE).sum(axis=2, dtype=np.int32)
    root = rows.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
    # Rows of a side lie together, by size: those of fitting size are found among all rows by one number.
    sizes, where = np.unique(size, return_inverse=True)
    placed = (2 * block + side) * (len(sizes) + 1) + where
    within = rows.column("l").to_numpy() == rows.column("r").to_numpy()
    other = (2 * block + ~within) * (len(sizes) + 1)
    start = np.where(within, np.arange(len(x)) + 1, np.searchsorted(placed, other + np.searchsorted(sizes, -(-percent * size // 100))))
    end = np.searchsorted(placed, other + np.searchsorted(sizes, 100 * size // percent, side="right"))
    many = np.where(side == 0, np.maximum(end - start, 0), 0)
    ends = np.cumsum(many)
    found = [(np.zeros(0, np.int64),) * 3]
    at = 0
    while at < len(x):
        # the pairs of some rows at a time, of one at least
        until = max(int(np.searchsorted(ends, ends[at] - many[at] + LOOK_PAIRS, side="right")), at + 1)
        i = np.repeat(np.arange(at, until), many[at:until])
        j = np.arange(len(i)) - np.repeat(ends[at:until] - many[at:until] - (ends[at] - many[at]), many[at:until]) + start[i]
        apart = np.flatnonzero(root[i] != root[j])
        i, j, at = i[apart], j[apart], until
        # Of n tokens in both sets together a link leaves this share different.
        for h in (rough, x):
            apart = np.abs(np.subtract(h[i], h[j], dtype=np.int32)).sum(axis=1)
            fits = (100 + percent) * apart <= (100 - percent) * (size[i] + size[j])
            i, j, apart = i[fits], j[fits], apart[fits]
        found.append((i, j, apart))
    i, j, apart = map(np.concatenate, zip(*found))
    return block[i], i, j, apart / (size[i] + size[j]), root[i], root[j]


def spanning(first: np.ndarray, second: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Places of links of least weight that connect all nodes (small numbers) that the links do."""
    leads = np.arange(1 + max(first.max(initial=0), second.max(initial=0))).tolist()
    left, kept = len(np.unique(np.concatenate([first, second]))) - 1, []

    def lead(node: int) -> int:
        while leads[node] != node:
            leads[node] = leads[leads[node]]
            node = leads[node]
        return node

    for at in np.argsort(weight, kind="stable").tolist():
        if len(kept) >= left:
            break
        one, other = lead(int(first[at])), lead(int(second[at]))
        if one != other:
            leads[one] = other
            kept.append(at)
    return np.array(kept, np.int64)


def _near_in_blocks(members: DataFrame, contents: DataFrame, percent: int, least: bool) -> DataFrame:
    """The pairs (a, b) of members of a key in different components that sizes and histograms do not rule out: if ``least``,
    in each block as many as connect the same components, else all, each in one of its keys as far as sketches tell."""
    rows = members.join(contents.select("set", "histogram"), "set")
    sketches = F.array().cast("array<bigint>")
    if not least:
        place = F.row_number().over(Window.partitionBy("set").orderBy("key"))
        first = members.select("set", "key").withColumn("place", place).filter(F.col("place") <= SKETCH_KEYS)
        rows, sketches = rows.join(first.groupBy("set").agg(F.collect_list("key").alias("sketch")), "set"), F.col("sketch")
    rows = rows.select("key", "n", "set", "size", "root", "histogram", sketches.alias("sketch"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Most blocks hold a few rows: a task looks at many of them at once.
        for table in _whole_blocks(batches, BLOCK):
            block, i, j, difference, root_i, root_j = _near(table, percent)
            if least:
                starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])[: len(block)])
                kept = [np.zeros(0, np.int64)]
                for start, end in zip(starts, [*starts[1:], len(block)]):
                    nodes = np.unique([root_i[start:end], root_j[start:end]], return_inverse=True)[1].reshape(2, -1)
                    kept.append(start + spanning(*nodes, difference[start:end]))
                at = np.concatenate(kept)
                i, j = i[at], j[at]
            else:
                # A key that both sketches hold is one in which the pair meets; without such a key it is given in all.
                key, sketch = table.column("key").to_numpy(), table.column("sketch")
                held = {k: frozenset(sketch[k].as_py()) for k in np.unique([i, j]).tolist()}
                told = [min(held[k] & held[m], default=key[k]) == key[k] for k, m in zip(i.tolist(), j.tolist())]
                i, j = i[told], j[told]
            names = table.column("set").to_pylist()
            for start in range(0, len(i), LOOK_PAIRS):
                some = slice(start, start + LOOK_PAIRS)
                pairs = [sorted((names[k], names[m])) for k, m in zip(i[some].tolist(), j[some].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([p[side] for p in pairs], pa.binary()) for side in (0, 1)], ["a", "b"])

    blocks = _blocks(rows, "key", PAIR_ROWS).repartition(*BLOCK)
    # by size and name: equal choices in all keys
    return blocks.sortWithinPartitions(*BLOCK, "side", "size", "set").mapInArrow(run, "a binary, b binary")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every set on the left with every set on the right: products of indicator matrices
    over the tokens that occur on both sides, some columns at a time."""
    found = np.zeros((len(left), len(right)), np.float32 if max(map(len, left), default=0) < 1 << 24 else np.float64)
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = []
    for sets in (left, right):
        row = np.repeat(np.arange(len(sets)), list(map(len, sets)))
        tokens = np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, tokens), max(len(shared) - 1, 0))
        hit = shared[at] == tokens if len(shared) else np.zeros(len(tokens), bool)
        sides.append((row[hit], at[hit]))
    for start in range(0, len(shared), COUNT_TOKENS):
        parts = []
        for (row, at), sets in zip(sides, (left, right)):
            inside = (at >= start) & (at < start + COUNT_TOKENS)
            part = np.zeros((len(sets), min(COUNT_TOKENS, len(shared) - start)), np.float32)
            part[row[inside], at[inside] - start] = 1
            parts.append(part)
        found += parts[0] @ parts[1].T
    return found.astype(np.int64)


def _link_counts(rooted: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """(set, links): the rows of other sets that each set links to; ``rooted`` has (set, root, n, copies, size)."""
    # The two sets of a component of two are linked.
    two = rooted.filter("n = 2")
    both = two.groupBy("root").agg(F.sum("copies").alias("all"))
    pairs = two.join(both, "root").select("set", (F.col("all") - F.col("copies")).alias("links"))
    rows = _with_contents(rooted.filter("n > 2"), "set", contents, "items", "items")

    def run(block: pd.DataFrame) -> pd.DataFrame:
        a, b = _sides(block)
        left, right = ([np.frombuffer(x, np.uint64) for x in side["items"]] for side in (a, b))
        both = overlaps(left, right)
        linked = 100 * both >= percent * (a["size"].to_numpy()[:, None] + b["size"].to_numpy() - both)
        if a is b:
            np.fill_diagonal(linked, False)
            counted = [(a, linked @ b["copies"].to_numpy())]
        else:
            counted = [(a, linked @ b["copies"].to_numpy()), (b, a["copies"].to_numpy() @ linked)]
        return pd.concat([pd.DataFrame({"set": side["set"], "links": n}) for side, n in counted])

    met = _blocks(rows, "root", COUNT_ROWS).groupBy("root", "l", "r").applyInPandas(run, "set binary, links bigint")
    return pairs.union(met.groupBy("set").agg(F.sum("links").alias("links")))


def _different(keyed: DataFrame) -> DataFrame:
    """(key, n, set, size): of the keys that have the same members, by 128 bits of their names, one."""
    members = [F.bit_xor(F.xxhash64("set", F.lit(i))).alias(f"x{i}") for i in (1, 2)]
    one = keyed.groupBy("key").agg(F.count("*").alias("n"), *members).groupBy("n", "x1", "x2").agg(F.min("key").alias("key"))
    return stored(keyed.join(one.filter("n > 1").select("key", "n"), "key"), "keys")


def _with_contents(rows: DataFrame, key: str, contents: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with a column of their sets' contents: few rows go to the contents, many meet them by shuffle."""
    right = contents.select(F.col("set").alias(key), F.col(column).alias(name))
    return right.join(F.broadcast(rows), key) if fits_broadcast(rows, BROADCAST_ROWS) else rows.join(right, key)


def _components(keyed: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the sets that link to others; ``keyed`` has (key, n, set, size)."""
    fits = 100 * F.least("size", "other") >= percent * F.greatest("size", "other")
    tested = roots = None
    for step in range(HUBS + 2):
        members = keyed.withColumn("root", F.col("set")) if roots is None else keyed.join(
            roots, keyed["set"] == roots["node"], "left"
        ).withColumn("root", F.coalesce("root", "set"))
        # A key is open while its members lie in several components; two members have met in the first round.
        members = members.filter(F.col("n") > min(step + 1, 2))
        pick = F.struct(F.xxhash64("set", F.lit(step)), "set", "size", "root")
        state = members.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.min(pick).alias("hub")).filter("r1 <> r2")
        open_ = members.join(state.select("key", "hub"), "key")
        if step < HUBS:
            pairs = open_.withColumn("other", F.col("hub.size")).filter("root <> hub.root").filter(fits)
            pairs = pairs.select(F.least("set", "hub.set").alias("a"), F.greatest("set", "hub.set").alias("b"))
        else:
            pairs = _near_in_blocks(open_.select("key", "n", "set", "size", "root"), contents, percent, least=step == HUBS)
        pairs = pairs.distinct() if tested is None else pairs.distinct().join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if roots is not None and pairs.isEmpty():
            continue
        tested = pairs if tested is None else tested.union(pairs)
        found = stored(_verified(pairs, contents, percent), "alike")
        roots = components(found) if roots is None else merged_components(roots, found)
    return roots


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_links.

    A text's set holds its distinct shingles of three words (runs without white space, A to Z in lower case); a text
    of fewer words is one shingle. Two rows link when their sets' intersection is ``percent`` of their union or
    more; ``n_links`` counts the rows a row links to, ``component_id`` is the smallest id that it reaches by links, its own
    included. Rows with equal sets link, so repeated rows do. Texts without words (null, empty, white space only) have
    an empty set and link to nothing. A null id is no component's smallest unless there is no other. Any length of text is taken
    whole; an empty table gives no rows; other columns are ignored. Shingles are compared by 64-bit hashes.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    spark = docs.sparkSession
    source = texts(docs, id_col, text_col)
    signed = stored(_signed(source), "sets")
    rows = signed.filter("slice IS NULL").select("doc_id", "set", "size")
    rarity = spark.sparkContext.broadcast(_rarity(signed))  # COUNTERS bytes
    classed, repeated = _classed(stored(_prefixes(source, rarity, percent), "prefixes"))
    keyed = stored(_keyed(classed, percent, repeated), "entries")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("size").alias("low"), F.max("size").alias("high"))
    # The two members of a key must be about as large.
    shared = shared.filter(f"n > 2 OR n = 2 AND 100 * low >= {percent} * high").select("key", "n")
    keyed = keyed.join(shared, "key")
    # Members without another of about their size in the key link to none of it.
    by_size = Window.partitionBy("key").orderBy("size")
    near = (100 * F.lag("size").over(by_size) >= percent * F.col("size")) | (100 * F.col("size") >= percent * F.lead("size").over(by_size))
    keyed = _different(stored(keyed.withColumn("near", near).filter("near").drop("near", "n"), "near"))
    contents = stored(_contents(source, keyed.select("set").distinct()), "contents")
    roots = _components(keyed, contents, percent)
    sets = stored(
        rows.filter("set IS NOT NULL").groupBy("set").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.first("size").alias("size")
        ), "counted",
    )
    linked = sets.join(roots.select(F.col("node").alias("set"), "root"), "set")
    by_root = linked.groupBy("root").agg(F.count("*").alias("n"), F.min("least").alias("component_id"))
    linked = stored(linked.join(by_root, "root"), "linked")
    links = _link_counts(linked.select("set", "root", "n", "copies", "size"), contents, percent)
    told = sets.join(linked.select("set", "component_id"), "set", "left").join(links, "set", "left")
    told = told.filter("copies > 1 OR component_id IS NOT NULL").select(
        "set", F.coalesce("component_id", "least").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    done = join_with_hot(rows, stored(told, "told"), "set")
    return done.select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )
