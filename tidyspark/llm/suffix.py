"""Repeated passages: bytes covered by a string that starts at two places, found by suffix sorting.

Shards by content. A hash decides for every window of ``length`` bytes where its anchor lies, by the
window's bytes alone, so equal windows have equal anchors. Windows that share an anchor and lie
mostly on one side of it are a run, its key a hash of bytes that all of them hold; equal windows have equal
keys. Runs whose key is found at one place only hold nothing repeated and go no further. The
others' bytes (contexts) are grouped by key: equal contexts are counted before they are moved, and only
keys with several different contexts need sorting, in shards of whole keys. A key whose different contexts
take more than a sort may hold is split first: its contexts are cut by the distance of their windows from the
anchor, and each piece has a key of all the bytes that its windows share, which are the more the fewer windows
it has. Equal windows lie at equal distances, so they still meet. Pieces go the way of contexts, in turn; those of
one window need no sorting.

A shard comes in the order of its keys and is sorted in groups of whole keys. Each group is sorted by external induced sorting. A queue per first byte holds tuples (suffix, common prefix
with the suffix before it) in order and moves to disk beyond a budget: buckets are drained from the
smallest byte to the largest for the suffixes larger than their successor, then back for the others, and
each tuple induces that of the suffix one byte longer, whose common prefix is one more than the least of
those passed since the last of its bucket. The sorted seeds (local minima) come from an induction without
prefixes, which sorts the strings between seeds, and the reduced string of their names, ordered by rank
doubling. Bytes, flags and queues move to mapped files or disk beyond the budget; the seeds with their ranks and orders,
a copy of the text and the tuples of one first byte are in memory, about 47 bytes for each byte of a group, so the
bytes of a group bound what a task holds, however large its shard is.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyspark.llm.common import digest16, list_array, small_batches, stored, texts

LENGTH = 200
GRAM = 32
POSITION_BITS = 28
#: Bytes of tuples that a shard's queues keep in memory before they move to disk.
MEMORY = 96 << 20
#: Bytes of contexts that one sort holds; keys with more are split.
SORT_BYTES = 1 << 21
BATCH_BYTES = 1 << 20
CHUNK = 1 << 20
FAR = np.int16(30_000)
_U = np.uint64
_SPREAD, _SPREAD2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _SPREAD2
    x = (x ^ (x >> _U(29))) * _SPREAD
    return x ^ (x >> _U(32))


# ---- runs of windows ---------------------------------------------------------


def _anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all grams, the anchor of each window of ``length`` bytes), whatever text they are of."""
    gram, power = data.astype(np.uint64) + _U(1), 0x100000001B3
    width = 1
    while width < GRAM:
        gram = gram[:-width] * _U(power) + gram[width:]
        power, width = power * power & 0xFFFFFFFFFFFFFFFF, 2 * width
    hashed = _mixed(gram)
    mask = _U((1 << POSITION_BITS) - 1)
    least = hashed & ~mask | np.arange(len(hashed), dtype=np.uint64)
    span, reach = length - GRAM + 1, 1
    while 2 * reach <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[: len(hashed) - span + 1], least[span - reach : span - reach + len(hashed) - span + 1])
    return hashed, (least & mask).astype(np.int64)


def window_runs(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, key) of the runs of all texts; windows count from the text's start."""
    sizes = np.diff(ends, prepend=0)
    starts = ends - sizes
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length or not (sizes >= length).any():
        return none, none, none, none
    hashed, anchor = _anchors(data, length)
    window = np.arange(len(anchor))
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(anchor)]
    valid = window + length <= ends[text]
    # Windows that begin less than ``half`` bytes before their anchor hold the bytes behind it, the others those before.
    half = (length - GRAM) // 2
    side = anchor - window > half
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (side[1:] != side[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new & valid)
    stops = np.flatnonzero(np.append(new | ~valid, True)[1:]) + 1  # ends of all stretches
    count = stops[np.searchsorted(stops, first, side="right")] - first
    at, left = anchor[first], side[first]
    shift = np.where(left, -half, 0)
    steps = [0, half // 3, 2 * half // 3, half]
    key = _mixed(left.astype(np.uint64) + _U(length))
    for step in steps:
        key = _mixed(key * _SPREAD + hashed[np.minimum(at + shift + step, len(hashed) - 1)])
    owner = text[first]
    return owner, first - starts[owner], count, key.view(np.int64)


# ---- external induced sorting -------------------------------------------------


class Budget:
    """Bytes of tuples in memory, over all queues of a shard."""

    def __init__(self, memory: int):
        self.memory, self.used, self.queues = memory, 0, []

    def take(self, size: int) -> None:
        self.used += size
        if self.used > self.memory:
            for queue in sorted(self.queues, key=lambda q: -q.in_memory):
                self.used -= queue.to_disk()
                if self.used <= self.memory // 2:
                    break


class Queue:
    """Tuples (suffix, common prefix) in order: chunks that are appended at one end and taken from either.

    Beyond the budget, the chunks are written to an unnamed file of the task and read back in turn."""

    def __init__(self, budget: Budget):
        self.budget, self.chunks, self.in_memory, self.file = budget, deque(), 0, None
        budget.queues.append(self)

    def append(self, suffixes: np.ndarray, prefixes: np.ndarray) -> None:
        if len(suffixes):
            size = suffixes.nbytes + prefixes.nbytes
            self.chunks.append((suffixes, prefixes))
            self.in_memory += size
            self.budget.take(size)

    def to_disk(self) -> int:
        moved, self.in_memory = self.in_memory, 0
        if moved and self.file is None:
            self.file = tempfile.TemporaryFile()
        for i, chunk in enumerate(self.chunks):
            if not isinstance(chunk[0], int):
                at = self.file.seek(0, 2)
                self.file.write(chunk[0].tobytes())
                self.file.write(chunk[1].tobytes())
                self.chunks[i] = (at, len(chunk[0]))
        return moved

    def take(self, last: bool = False) -> tuple[np.ndarray, np.ndarray]:
        chunk = self.chunks.pop() if last else self.chunks.popleft()
        if isinstance(chunk[0], int):
            at, count = chunk
            self.file.seek(at)
            data = self.file.read(count * 10)
            return np.frombuffer(data, np.int64, count), np.frombuffer(data, np.int16, count, count * 8)
        size = chunk[0].nbytes + chunk[1].nbytes
        self.in_memory -= size
        self.budget.used -= size
        return chunk

    def take_many(self) -> tuple[np.ndarray, np.ndarray]:
        """Chunks from the front as one, as many as make up ``CHUNK`` tuples."""
        taken = [self.take()]
        total = len(taken[0][0])
        while self.chunks and total < CHUNK:
            taken.append(self.take())
            total += len(taken[-1][0])
        if len(taken) == 1:
            return taken[0]
        return np.concatenate([t[0] for t in taken]), np.concatenate([t[1] for t in taken])

    def __bool__(self) -> bool:
        return bool(self.chunks)


def _array(size: int, kind: str, memory: int) -> np.ndarray:
    """Zeros, in a mapped unnamed file if they would take more than the budget."""
    if size * np.dtype(kind).itemsize <= memory:
        return np.zeros(size, kind)
    with tempfile.TemporaryFile() as file:
        return np.memmap(file, kind, "w+", shape=(size,))


class SuffixSort:
    """Sorts all suffixes of ``text`` (bytes 1 to 255, a 0 at the end alone) by their first ``cap`` bytes."""

    def __init__(self, text: np.ndarray, cap: int, memory: int = MEMORY):
        self.text, self.cap, self.memory = text, cap, memory
        n = len(text)
        change = np.flatnonzero(text[:-1] != text[1:])
        self.small = _array(n, "bool", memory)  # smaller than the suffix behind it
        self.small[: n - 1] = np.repeat(text[change] < text[change + 1], np.diff(change, prepend=-1))
        self.small[n - 1] = True
        self.seeds = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1
        self.words = np.concatenate([text, np.zeros(8, np.uint8)])

    # Comparing directly, eight bytes at a time.

    def _word(self, at: np.ndarray) -> np.ndarray:
        view = np.lib.stride_tricks.sliding_window_view(self.words, 8)
        return np.ascontiguousarray(view[np.minimum(at, len(self.text))]).view(np.uint64)[:, 0]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray | None = None) -> np.ndarray:
        """Common prefixes of suffix pairs, up to the cap (or ``most``)."""
        most = np.full(len(a), self.cap) if most is None else most
        out, todo, done = most.copy(), np.arange(len(a)), 0
        while len(todo):
            todo = todo[done < most[todo]]
            differ = self._word(a[todo] + done) ^ self._word(b[todo] + done)
            hit = np.flatnonzero(differ)
            lowest = differ[hit] & (~differ[hit] + _U(1))
            out[todo[hit]] = np.minimum(done + (np.log2(lowest.astype(np.float64)) // 8).astype(np.int64), most[todo[hit]])
            todo, done = todo[differ == 0], done + 8
        return out

    # The two passes.

    def _induce(self, queues: list[Queue], carry: np.ndarray, fresh: np.ndarray, suffixes: np.ndarray, prefixes: np.ndarray, small: bool) -> None:
        before = suffixes - 1
        fits = np.flatnonzero((before >= 0) & (self.small[before] == small))
        targets = self.text[before[fits]]
        order = np.argsort(targets, kind="stable")
        fits, targets = fits[order], targets[order]
        borders = np.flatnonzero(np.diff(targets)) + 1
        untouched = np.ones(256, bool)
        for at in np.split(fits, borders) if len(fits) else ():
            byte = int(self.text[before[at[0]]])
            cuts = np.append(0, at + 1)
            rest = cuts[-1] < len(prefixes)
            least = np.minimum.reduceat(prefixes, cuts if rest else cuts[:-1])
            induced = np.minimum(least[: len(at)] + 1, self.cap).astype(np.int16)
            induced[0] = 0 if fresh[byte] else min(int(induced[0]), int(carry[byte]) + 1)
            carry[byte] = least[-1] if rest else FAR
            fresh[byte] = untouched[byte] = False
            queues[byte].append(before[at], induced)
        carry[untouched] = np.minimum(carry[untouched], prefixes.min())

    def _passes(self, seeds: np.ndarray, prefixes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes but the last, as (suffixes, common prefixes with the one before) of each first
        byte, from the largest byte to the smallest; the first of a byte has prefix 0."""
        budget = Budget(self.memory)
        larger, kept, smaller = ([Queue(budget) for _ in range(256)] for _ in range(3))
        carry, fresh = np.full(256, FAR), np.ones(256, bool)
        heads = self.text[seeds]
        cuts = np.searchsorted(heads, np.arange(257))
        last_large = np.full(256, -1)
        for byte in range(256):
            while larger[byte]:
                chunk = larger[byte].take_many()
                last_large[byte] = chunk[0][-1]
                kept[byte].append(*chunk)
                self._induce(larger, carry, fresh, *chunk, small=False)
            own = slice(cuts[byte], cuts[byte + 1])
            if own.start < own.stop:
                first = prefixes[own].astype(np.int16)
                seam = self.common(last_large[[byte]], seeds[own][:1])[0] if last_large[byte] >= 0 else 0
                first[0] = seam
                for start in range(0, len(first), CHUNK):
                    part = slice(own.start + start, min(own.start + start + CHUNK, own.stop))
                    self._induce(larger, carry, fresh, seeds[part], first[start : start + CHUNK], small=False)
        carry, fresh = np.full(256, FAR), np.ones(256, bool)
        for byte in range(255, -1, -1):
            down: list[tuple[np.ndarray, np.ndarray]] = []  # this byte's smaller suffixes, from the largest
            while smaller[byte]:
                chunk = smaller[byte].take_many()
                down.append(chunk)
                self._induce(smaller, carry, fresh, *chunk, small=True)
            smallest = down[-1][0][-1] if down else -1
            above = 0 if smallest < 0 else int(self.common(np.array([smallest]), last_large[[byte]])[0]) if last_large[byte] >= 0 else 0
            seam, up = above, []
            while kept[byte]:
                suffixes, own = kept[byte].take(last=True)
                up.append((suffixes, own))
                turned = np.append(above, own[:0:-1]).astype(np.int16)
                above = own[0]
                self._induce(smaller, carry, fresh, suffixes[::-1], turned, small=True)
            for chunk in reversed(up):
                yield chunk
            first = seam
            for suffixes, own in reversed(down):
                # ``own`` is the prefix with the next larger suffix; turned round it belongs to that one.
                yield suffixes[::-1], np.append(first, own[:0:-1]).astype(np.int16)
                first = own[0]

    def _sorted_seeds(self) -> np.ndarray:
        seeds = self.seeds
        if len(seeds) < 2:
            return seeds
        by_byte = seeds[np.argsort(self.text[seeds], kind="stable")]
        is_seed = _array(len(self.text), "bool", self.memory)
        is_seed[seeds] = True
        found: list[np.ndarray] = []
        chunks: list[np.ndarray] = []
        head = 256
        for suffixes, _ in self._passes(by_byte, np.zeros(len(by_byte), np.int16)):
            byte = int(self.text[suffixes[0]])
            if byte != head:
                found += reversed(chunks)
                chunks, head = [], byte
            chunks.append(suffixes[is_seed[suffixes]])
        found += reversed(chunks)
        ordered = np.concatenate([[len(self.text) - 1], *reversed(found)])  # the end is the smallest
        # Names: equal strings from a seed to the next have equal names.
        ends = np.append(seeds[1:], len(self.text) - 1)
        size = (ends - seeds + 1)[np.searchsorted(seeds, ordered)]
        same = size[1:] == size[:-1]
        pairs = np.flatnonzero(same)
        most = np.minimum(size[1:][pairs], self.cap)
        same[pairs] = self.common(ordered[:-1][pairs], ordered[1:][pairs], most) >= most
        names = np.append(0, np.cumsum(~same))
        rank = np.empty(len(seeds), np.int64)
        rank[np.searchsorted(seeds, ordered)] = names
        # The reduced string, by doubling: every name stands for two bytes or more.
        step = 1
        order = np.argsort(rank, kind="stable")
        while step < self.cap and rank[order[-1]] < len(rank) - 1:
            behind = np.append(rank[step:] + 1, np.zeros(min(step, len(rank)), np.int64))[: len(rank)]
            key = rank * (len(rank) + 1) + behind
            order = np.argsort(key, kind="stable")
            rank[order] = np.append(0, np.cumsum(key[order][1:] != key[order][:-1]))
            step *= 2
        return seeds[order]

    def chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ordered = self._sorted_seeds()
        prefixes = np.zeros(len(ordered), np.int64)
        prefixes[1:] = self.common(ordered[:-1], ordered[1:])
        return self._passes(ordered, prefixes)


def repeated_windows(contexts: list[bytes], windows: np.ndarray, length: int = LENGTH, memory: int = MEMORY) -> list[np.ndarray]:
    """For each context, which of its first windows occur as one of the others' (or its own other) windows."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    # Bytes move up by two: 0 ends the text, 1 stands between contexts. UTF-8 has no bytes above 0xF7.
    text = _array(int(sizes.sum()) + len(contexts) + 1, "uint8", memory)
    starts = np.cumsum(sizes + 1) - sizes - 1
    for start, context in zip(starts, contexts):
        text[start : start + len(context)] = np.frombuffer(context, np.uint8) + 2
        text[start + len(context)] = 1
    asked = _array(len(text), "bool", memory)
    hot = _array(len(text), "bool", memory)
    for start, count in zip(starts, windows):
        asked[start : start + count] = True
    # Within a byte the chunks come in order; between bytes nothing is shared.
    last, least, head = -1, 0, -1
    for suffixes, prefixes in SuffixSort(text, length, memory).chunks():
        byte = int(text[suffixes[0]])
        if byte != head:
            last, least, head = -1, int(FAR), byte
        at = np.flatnonzero(asked[suffixes])
        if not len(at):
            least = min(least, int(prefixes.min()))
            continue
        cuts = np.append(0, at + 1)
        rest = cuts[-1] < len(prefixes)
        between = np.minimum.reduceat(prefixes, cuts if rest else cuts[:-1])
        shared = between[: len(at)].copy()
        shared[0] = min(int(shared[0]), least) if last >= 0 else 0
        chosen = suffixes[at]
        alike = shared >= length
        hot[chosen[alike]] = True
        hot[np.append(last, chosen[:-1])[alike]] = True
        last, least = int(chosen[-1]), int(between[-1]) if rest else int(FAR)
    return [np.flatnonzero(hot[start : start + count]) for start, count in zip(starts, windows)]


# ---- the whole table ------------------------------------------------------------


def _stretches(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of consecutive numbers."""
    first = np.flatnonzero(np.append(True, np.diff(points) > 1)) if len(points) else np.zeros(0, np.int64)
    return points[first], np.diff(np.append(first, len(points)))


def _runs(rows: DataFrame, length: int) -> DataFrame:
    """(name, runs): the runs of windows of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            raw = [t.encode() for t in batch.column("text").to_pylist()]
            ends = np.cumsum([len(r) for r in raw])
            owner, first, count, key = window_runs(np.frombuffer(b"".join(raw), np.uint8), ends, length)
            offsets = np.searchsorted(owner, np.arange(len(raw) + 1))
            columns = [list_array(v, offsets, t) for v, t in ((first, pa.int32()), (count, pa.int32()), (key, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("name"), *columns], ["name", "first", "windows", "key"])

    found = rows.select("name", "text").mapInArrow(run, "name binary, first array<int>, windows array<int>, key array<bigint>")
    return found.select("name", F.inline(F.arrays_zip("first", "windows", "key")))


def _contexts(rows: DataFrame, length: int) -> DataFrame:
    """(name, first, windows, key, context) of the chosen runs of (name, text, runs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            owner, firsts, counts, keys, contexts = [], [], [], [], []
            for row, (text, runs) in enumerate(zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist())):
                data = text.encode()
                for r in runs:
                    owner.append(row)
                    firsts.append(r["first"])
                    counts.append(r["windows"])
                    keys.append(r["key"])
                    contexts.append(data[r["first"] : r["first"] + r["windows"] + length - 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("name").take(pa.array(owner, pa.int32())), pa.array(firsts, pa.int32()),
                 pa.array(counts, pa.int32()), pa.array(keys, pa.int64()), pa.array(contexts, pa.binary())],
                ["name", "first", "windows", "key", "context"],
            )

    return rows.select("name", "text", "runs").mapInArrow(run, "name binary, first int, windows int, key bigint, context binary")


def slices(context: bytes, windows: int, behind: int, key: int, width: int, length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(first window, windows, key, context) of the pieces of a context whose first window begins ``behind`` bytes before
    its anchor: windows at ``width`` distances, the key of ``key``, the distances and the bytes that windows at all of them share."""
    for part in range(behind // width, (behind - windows + 1) // width - 1, -1):
        nearest, farthest = behind - part * width, behind - (part + 1) * width + 1
        first, last = max(farthest, 0), min(nearest, windows - 1)
        shared = hashlib.blake2b(context[nearest : farthest + length], digest_size=8, salt=part.to_bytes(2), key=key.to_bytes(8, signed=True))
        yield first, last - first + 1, int.from_bytes(shared.digest(), signed=True), context[first : last + length]


def _slices(contexts: DataFrame, width: int, length: int) -> DataFrame:
    """(whole_key, whole_what, lead, windows, key, context): the pieces of (key, what, windows, context)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "context", BATCH_BYTES):
            raw = batch.column("context").to_pylist()
            starts = np.cumsum([0, *map(len, raw[:-1])])
            anchor = _anchors(np.frombuffer(b"".join(raw), np.uint8), length)[1]
            behind = (anchor[starts] - starts).tolist()
            owner, pieces = [], []
            for row, (context, key, windows) in enumerate(zip(raw, batch.column("key").to_pylist(), batch.column("windows").to_pylist())):
                own = list(slices(context, windows, behind[row], key, width, length))
                owner += [row] * len(own)
                pieces += own
            owner = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(owner), batch.column("what").take(owner)]
                + [pa.array(v, t) for v, t in zip(zip(*pieces), (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                ["whole_key", "whole_what", "lead", "windows", "key", "context"],
            )

    rows = contexts.select("key", "what", "windows", "context")
    return rows.mapInArrow(run, "whole_key bigint, whole_what binary, lead int, windows int, key bigint, context binary")


def groups_of_keys(rows: Iterable[tuple], most: int) -> Iterator[list[tuple]]:
    """Rows (key, what, windows, context) in the order of their keys, in lists of whole keys; a list holds contexts of
    ``most`` bytes at most, or those of one key."""
    held, size, start, before = [], 0, 0, 0  # the last key begins at ``start``, behind ``before`` bytes
    for row in rows:
        if held and row[0] != held[-1][0]:
            start, before = len(held), size
        held.append(row)
        size += len(row[3])
        if size > most and start:
            yield held[:start]
            held, size, start = held[start:], size - before, 0
    if held:
        yield held


def _sorted_shards(contexts: DataFrame, length: int, memory: int, most: int) -> DataFrame:
    """(key, what, starts, counts): repeated windows of the different contexts of each key, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("key", "what", "windows", "context"))))
        for group in groups_of_keys(rows, most):
            keys, whats, windows, held = zip(*group)
            found = [_stretches(points) for points in repeated_windows(list(held), np.array(windows), length, memory)]
            filled = [i for i, (starts, _) in enumerate(found) if len(starts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in filled], pa.int64()), pa.array([whats[i] for i in filled], pa.binary())]
                + [pa.array([found[i][j] for i in filled], pa.list_(pa.int32())) for j in (0, 1)],
                ["key", "what", "starts", "counts"],
            )

    shards = contexts.select("key", "what", "windows", "context").repartition("key").sortWithinPartitions("key")
    return shards.mapInArrow(run, "key bigint, what binary, starts array<int>, counts array<int>")


def _verdicts(contexts: DataFrame, length: int, memory: int, most: int, width: int) -> DataFrame:
    """(key, what, starts, counts): the repeated windows of (key, what, windows, context), which have a row for each
    place; several rows where the pieces of a context, cut at ``width`` distances, have some each."""
    groups = stored(
        contexts.groupBy("key", "what").agg(F.count("*").alias("times"), F.first("windows").alias("windows")), "context-groups"
    )
    # Different contexts of one window each have nothing in common.
    size = F.sum(F.col("windows") + length - 1)
    mixed = stored(
        groups.groupBy("key").agg(F.count("*").alias("n"), F.max("windows").alias("m"), (size > most).alias("large"))
        .filter("n > 1 AND m > 1").select("key", "large"), "mixed-keys"
    )
    different = contexts.join(mixed.filter("NOT large").select("key"), "key", "left_semi").dropDuplicates(["key", "what"])
    found = _sorted_shards(different, length, memory, most)
    large = mixed.filter("large").select("key")
    if not large.isEmpty():  # there are no more of them than groups that a sort can hold
        split = contexts.join(F.broadcast(large), "key", "left_semi").dropDuplicates(["key", "what"])
        pieces = stored(_slices(split, width, length).withColumn("what", digest16("context")), "slices")
        below = _verdicts(pieces.select("key", "what", "windows", "context"), length, memory, most, max(width // 4, 1))
        of_pieces = pieces.select("whole_key", "whole_what", "lead", "key", "what").join(below, ["key", "what"])
        found = found.unionByName(of_pieces.select(
            F.col("whole_key").alias("key"), F.col("whole_what").alias("what"),
            F.transform("starts", lambda start: start + F.col("lead")).alias("starts"), "counts",
        ))
    whole = groups.filter("times > 1").select(
        "key", "what", F.array(F.lit(0)).alias("starts"), F.array(F.col("windows").cast("int")).alias("counts")
    )
    partly = found.join(groups.filter("times > 1").select("key", "what"), ["key", "what"], "left_anti")
    return stored(whole.unionByName(partly), "verdicts")


def repeated_spans(rows: DataFrame, length: int = LENGTH, memory: int = MEMORY, most: int = SORT_BYTES) -> DataFrame:
    """(name, runs of windows that repeat) for texts with (name, text): arrays of (first, starts, counts);
    ``name`` is the text's digest, and copies of a text count once here."""
    runs = stored(_runs(rows, length), "runs")
    # A key found at two places or more: the places' hashes differ. Only numbers are moved.
    place = F.xxhash64("name", "first")
    known = runs.groupBy("key").agg(F.min(place).alias("p"), F.max(place).alias("q")).filter("p <> q").select("key")
    chosen = runs.join(known, "key", "left_semi").distinct().groupBy("name").agg(
        F.collect_list(F.struct("first", "windows", "key")).alias("runs")
    )
    with_text = rows.join(chosen, "name").dropDuplicates(["name"])
    contexts = stored(_contexts(with_text, length).withColumn("what", digest16("context")), "contexts")
    verdicts = _verdicts(contexts.select("key", "what", "windows", "context"), length, memory, most, max((length - GRAM) // 8, 1))
    hits = contexts.select("name", "first", "key", "what").join(verdicts, ["key", "what"])
    return hits.groupBy("name").agg(F.collect_list(F.struct("first", "starts", "counts")).alias("runs"))


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, memory: int = MEMORY, most: int = SORT_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, starts, stops, kept (bytes).

    Texts are UTF-8 bytes, a null text is empty. A byte goes if a string of ``length`` bytes that covers it
    starts anywhere else as well, in the same text or another; matches do not cross texts, overlaps count, and
    the input decides, not what is left. ``starts`` and ``stops`` are the maximal removed runs. Of texts that
    occur in several rows (repeated rows too) every byte goes if they are that long; shorter texts stay.
    Null ids stay as they are, an empty table gives no rows, other columns are ignored.
    """
    rows = texts(docs, id_col, text_col).withColumn("name", digest16("text"))
    long_ = rows.filter(F.octet_length("text") >= length)
    spans = repeated_spans(long_.select("name", "text"), length, memory, most)
    copied = long_.groupBy("name").agg(F.count("*").alias("times")).filter("times > 1").select("name", F.lit(True).alias("all"))
    marked = spans.join(copied, "name", "full_outer")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            raw = [t.encode() for t in batch.column("text").to_pylist()]
            data = np.frombuffer(b"\0".join([*raw, b""]), np.uint8)  # a place behind each text, where all its runs have ended
            sizes = np.array([len(r) for r in raw], np.int64)
            behind = np.cumsum(sizes + 1) - 1
            begin = behind - sizes
            every = pc.fill_null(batch.column("all"), False).to_numpy(zero_copy_only=False)
            firsts, starts, counts = batch.column("runs").flatten().flatten()
            first = np.repeat(begin, _lengths(batch.column("runs"))) + firsts.to_numpy(zero_copy_only=False)
            at = np.repeat(first, _lengths(starts)) + starts.flatten().to_numpy()
            gone = np.zeros(len(data), np.int32)
            np.add.at(gone, np.concatenate([at, begin[every]]), 1)
            np.add.at(gone, np.concatenate([at + counts.flatten().to_numpy() + length - 1, behind[every]]), -1)
            inside = np.cumsum(gone) > 0
            edge = np.diff(inside.astype(np.int8), prepend=0)
            start, stop = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
            owner = np.searchsorted(behind, start)
            offsets = np.searchsorted(owner, np.arange(len(raw) + 1))
            removed = np.bincount(owner, stop - start, len(raw)).astype(np.int64)
            left = ~inside
            left[behind] = False
            ends = np.cumsum(np.append(0, sizes - removed)).astype(np.int32)
            kept = pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(ends), pa.py_buffer(data[left])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(np.diff(offsets), pa.int64()),
                 list_array(start - begin[owner], offsets, pa.int32()), list_array(stop - begin[owner], offsets, pa.int32()), kept],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "starts", "stops", "kept"],
            )

    joined = rows.join(marked, "name", "left").select("doc_id", "text", "runs", "all")
    return joined.mapInArrow(
        run,
        f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, starts array<int>, stops array<int>, kept binary",
    )
