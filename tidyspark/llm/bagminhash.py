"""Near duplicates by weighted MinHash over bags of word shingles.

BagMinHash: every shingle owns a Poisson process of points over (time, weight level, register).
A text whose bag holds a shingle ``w`` times sees the points up to level ``w``; each register keeps
its earliest point, so two texts agree in a register with the probability of their weighted Jaccard
similarity. The levels are handled in a hierarchy of doubling intervals, (0,1], (1,2], (2,4], ...,
one process of the interval's rate each; only the interval that holds ``w`` is split, by its points'
levels. Points come in order of time, and a process ends once it is past all of a text's registers.

Registers are banded into keys. Texts are first merged into classes of equal bags; within every key
the members are compared with the key's hub, in two rounds with different hubs, and wherever members of a
key then still lie in different components, all pairs across them are compared, so no pair of a key is left
out, and most members of a large group cost a few comparisons each. Longer signatures rule out pairs far
below the limit (four times longer, and in blocks, for the last round); the exact multiset overlap of both
bags decides on the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.llm.common import list_array, small_batches, stored, texts

WORDS, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 24, 5
REGISTERS = BANDS * BAND_ROWS
HUB_ROUNDS, BLOCK_ROWS = 2, 4_096
#: Candidates get longer signatures. Pairs whose share of equal registers is this much below the limit are not
#: compared in full: 3.8 standard deviations, so each loses no more than the bands do at the limit (7 in 100,000).
#: The last round, which meets whole groups, takes all ``LONG_PARTS`` signatures of this length.
FINE_REGISTERS, SHARE_MARGIN = 360, 0.08
LONG_PARTS, LONG_MARGIN = 4, 0.04
_U = np.uint64
_PRIME, _SPREAD, _SPREAD2 = _U(0x100000001B3), _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _SPREAD2
    x = (x ^ (x >> _U(29))) * _SPREAD
    return x ^ (x >> _U(32))


def _stride(n: int) -> np.uint64:
    return _U(n * int(_SPREAD) & 0xFFFFFFFFFFFFFFFF)


def word_hashes(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of ASCII letters and digits and of other characters beyond ASCII)
    of all texts, and how many each text has."""
    raw = [v.encode() for v in values]
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    word = _WORD_BYTE[data]
    first = np.flatnonzero(word & ~np.append(False, word[:-1]))
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(values), np.int64)
    last = np.flatnonzero(word & ~np.append(word[1:], False))
    length = last - first + 1
    hashed = np.zeros(len(first), np.uint64)
    # Eight bytes at a time: a word of n bytes takes n / 8 rounds.
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    todo, done = np.arange(len(first)), 0
    while len(todo):
        left = np.minimum(length[todo] - done, 8)
        piece = np.ascontiguousarray(words[first[todo] + done]).view(np.uint64)[:, 0] & masks[left]
        hashed[todo] = _mixed(hashed[todo] * _PRIME + piece + _U(done + 1))
        done += 8
        todo = todo[length[todo] > done]
    return hashed, np.diff(np.searchsorted(first, ends), prepend=0)


def shingle_bags(hashes: np.ndarray, counts: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, times) of the bags: shingles of ``words`` words; a shorter text with any word is one shingle."""
    starts = np.cumsum(counts) - counts
    shingles = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), shingles)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    at = starts[owner] + offset
    size = np.minimum(counts, words)[owner]
    value = np.zeros(len(at), np.uint64)
    for j in range(words):
        inside = size > j
        value = np.where(inside, _mixed(value * _PRIME + hashes[np.minimum(at + j, max(len(hashes) - 1, 0))] + _U(j + 1)), value)
    key = value ^ (owner.astype(np.uint64) * _SPREAD)  # one sort puts the repeats of a text's shingle together
    order = np.argsort(key)
    owner, value, key = owner[order], value[order], key[order]
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(order)))
    by_text = np.argsort(owner[at], kind="stable")
    return owner[at][by_text], value[at][by_text], times[by_text]


def bag_signatures(
    owner: np.ndarray, shingle: np.ndarray, times: np.ndarray, many: int, registers: int = REGISTERS
) -> np.ndarray:
    """(text, register) matrix of the earliest points' identities; 0 for texts without shingles."""
    # One process per shingle and doubling interval (low, low + rate] that its times reach.
    owners, seeds, rates, lows, tops = [owner], [_mixed(shingle)], [np.ones(len(owner))], [np.zeros(len(owner))], [times.astype(float)]
    low, level = 1, 1
    more = np.flatnonzero(times > low)
    while len(more):
        owners.append(owner[more])
        seeds.append(_mixed(shingle[more] + _stride(level)))
        rates.append(np.full(len(more), float(low)))
        lows.append(np.full(len(more), float(low)))
        tops.append(times[more].astype(float))
        low, level = 2 * low, level + 1
        more = more[times[more] > low]
    owner, seed = np.concatenate(owners), np.concatenate(seeds)
    rate, low_, top = np.concatenate(rates), np.concatenate(lows), np.concatenate(tops)
    best = np.full(many * registers, np.inf)
    time = np.zeros(len(owner))
    step = 0
    while len(owner):
        step += 1
        drawn = _mixed(seed + _stride(step))
        # Logarithms may differ in the last bits between machines; cut off, they agree.
        time = time - np.log((drawn >> _U(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / rate
        place = _mixed(drawn ^ _SPREAD)
        register = ((place >> _U(40)) * _U(registers) >> _U(24)).astype(np.int64)
        height = low_ + rate * ((place & _U(0xFFFFFF)).astype(np.float64) * 2.0**-24)
        seen = np.flatnonzero(np.floor(height) < top)  # levels are whole: the point's unit interval must be reached
        np.minimum.at(best, owner[seen] * registers + register[seen], time[seen])
        if step > 8 and step % 8:  # later points change nothing, so the test may wait
            continue
        last = best.reshape(many, registers).max(axis=1)
        on = time < last[owner]
        owner, seed, rate, low_, top, time = owner[on], seed[on], rate[on], low_[on], top[on], time[on]
    best[np.isinf(best)] = 0
    return (best.view(np.uint64) >> _U(16)).reshape(many, registers)


def fine_signatures(owner: np.ndarray, shingle: np.ndarray, times: np.ndarray, many: int) -> np.ndarray:
    """(text, register) matrix of one byte of each register of ``LONG_PARTS`` independent signatures."""
    seeds = [shingle, *(_mixed(shingle + _stride(1_000 + part)) for part in range(1, LONG_PARTS))]
    parts = [(_mixed(bag_signatures(owner, seed, times, many, FINE_REGISTERS)) & _U(0xFF)).astype(np.uint8) for seed in seeds]
    return np.hstack(parts)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signatures), 1))
    for row in range(BAND_ROWS):
        keys = _mixed(keys * _PRIME + signatures[:, row::BAND_ROWS][:, :BANDS])
    return keys.view(np.int64)


def _bag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, list[bytes | None], int]]:
    for batch in small_batches(batches, "text", 1 << 21):
        hashes, counts = word_hashes(batch.column("text").to_pylist())
        owner, shingle, times = shingle_bags(hashes, counts)
        ends = np.cumsum(counts)
        names = [
            hashlib.sha256(hashes[end - n : end].tobytes()).digest()[:16] if n else None for end, n in zip(ends, counts)
        ]
        yield batch, owner, shingle, times, names, batch.num_rows


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, bag, weight, keys): ``bag`` names the text's sequence of words (null without words),
    ``weight`` counts its shingles, ``keys`` are the bands' keys, ``h`` is a hash of the text."""
    source = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("h"), F.lower("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, owner, shingle, times, names, many in _bag_rows(batches):
            keys = band_keys(bag_signatures(owner, shingle, times, many))
            weight = np.bincount(owner, times, many).astype(np.int64)
            filled = np.array([n is not None for n in names], bool)
            offsets = np.append(0, np.cumsum(np.where(filled, BANDS, 0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(names, pa.binary()), pa.array(weight),
                 list_array(keys[filled].ravel(), offsets, pa.int64())],
                ["doc_id", "h", "bag", "weight", "keys"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, h bigint, bag binary, weight bigint, keys array<bigint>")


CONTENTS = ("items", "signature", "more", "keys")


def _contents(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """(bag, items, signature, more, keys): the bags of the wanted texts (by ``h``) as sorted distinct numbers, one
    for each occurrence of a shingle, so that overlaps of multisets are overlaps of sets, their first fine
    signature, all of them, and the bands' keys."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # One plan at every size: the wanted texts may be a large part of all, so they are never broadcast.
    rows = docs.select(F.xxhash64(text).alias("h"), text.alias("text")).join(wanted.hint("merge"), "h", "left_semi")
    rows = rows.dropDuplicates(["h"])
    rows = rows.select(F.lower("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, owner, shingle, times, names, many in _bag_rows(batches):
            which = np.repeat(np.arange(len(owner)), times)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
            items = _mixed(shingle[which] + nth.astype(np.uint64) * _SPREAD)
            ends = np.searchsorted(owner[which], np.arange(many), side="right")
            starts = np.append(0, ends[:-1])
            packed = [np.sort(items[a:b]).tobytes() for a, b in zip(starts, ends)]
            registers = fine_signatures(owner, shingle, times, many)
            short = [r[:FINE_REGISTERS].tobytes() for r in registers]
            keys = [k.tobytes() for k in band_keys(bag_signatures(owner, shingle, times, many))]
            columns = [pa.array(x, pa.binary()) for x in (names, packed, short, [r.tobytes() for r in registers], keys)]
            yield pa.RecordBatch.from_arrays(columns, ["bag", *CONTENTS])

    found = rows.mapInArrow(run, f"bag binary, {', '.join(f'{c} binary' for c in CONTENTS)}").filter("bag IS NOT NULL")
    return found.groupBy("bag").agg(*[F.first(c).alias(c) for c in CONTENTS])


def _with_sides(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    sides = pairs.select("a", "b").join(table.select(F.col("bag").alias("a"), F.col(column).alias("x")), "a")
    return sides.join(table.select(F.col("bag").alias("b"), F.col(column).alias("y")), "b").select("a", "b", "x", "y")


def _taken(batch: pa.RecordBatch, alike: list[bool]) -> pa.RecordBatch:
    at = pa.array(np.flatnonzero(alike))
    return pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["a", "b"])


def _matrix(rows: list[bytes], kind: type, wide: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), kind).reshape(-1, wide)


def _close(pairs: DataFrame, contents: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose signatures do not rule them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_matrix(batch.column(side).to_pylist(), np.uint8, FINE_REGISTERS) for side in ("x", "y"))
            yield _taken(batch, (x == y).mean(axis=1) >= least - SHARE_MARGIN)

    return _with_sides(pairs, contents, "signature").mapInArrow(run, "a binary, b binary")


def _close_in_blocks(members: DataFrame, contents: DataFrame, least: float) -> DataFrame:
    """The same, by all fine signatures, for all pairs of members of a key (key, bag, weight, root, n) in different
    components: blocks of signatures meet block by block, and only close pairs leave a task. A pair is compared
    for the first key that both have; that key is open as well, as they lie in different components."""
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    rows = members.join(contents.select("bag", "more", "keys"), "bag").select(
        "key", "bag", "weight", F.xxhash64("root").alias("root"), "more", "keys", blocks.alias("blocks"),
        F.pmod(F.xxhash64("bag"), blocks).cast("int").alias("own"),
    )
    left = rows.withColumn("r", F.explode(F.sequence("own", F.col("blocks") - 1))).withColumn("l", F.col("own"))
    right = rows.filter("own > 0").withColumn("l", F.explode(F.sequence(F.lit(0), F.col("own") - 1))).withColumn("r", F.col("own"))
    both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))

    def run(block: pd.DataFrame) -> pd.DataFrame:
        a = block[block["side"] == 0]
        b = block[block["side"] == 1] if len(block) and block["l"].iat[0] != block["r"].iat[0] else a
        x, y = (_matrix(list(side["more"]), np.uint8, LONG_PARTS * FINE_REGISTERS) for side in (a, b))
        x1, y1 = (np.ascontiguousarray(side[:, :FINE_REGISTERS]) for side in (x, y))
        keys_a = _matrix(list(a["keys"]), np.int64, BANDS)
        keys_b = np.ascontiguousarray(_matrix(list(b["keys"]), np.int64, BANDS).T)
        weight_a, weight_b = a["weight"].to_numpy(), b["weight"].to_numpy()
        root_a, root_b = a["root"].to_numpy(), b["root"].to_numpy()
        first, second = a["bag"].to_numpy(), b["bag"].to_numpy()
        found = []
        for i in range(len(a)):
            lighter, heavier = np.minimum(weight_a[i], weight_b), np.maximum(weight_a[i], weight_b)
            fits = (root_a[i] != root_b) & (lighter >= least * heavier)
            if a is b:
                fits[: i + 1] = False
            for band in range(int(np.flatnonzero(keys_a[i] == block["key"].iat[0])[0])):
                fits &= keys_b[band] != keys_a[i, band]
            at = np.flatnonzero(fits)
            at = at[np.count_nonzero(y1[at] == x1[i], axis=1) >= (least - SHARE_MARGIN) * FINE_REGISTERS]
            at = at[np.count_nonzero(y[at] == x[i], axis=1) >= (least - LONG_MARGIN) * LONG_PARTS * FINE_REGISTERS]
            found += [(min(first[i], second[j]), max(first[i], second[j])) for j in at]
        return pd.DataFrame(found, columns=["a", "b"])

    columns = both.select("key", "l", "r", "side", "bag", "weight", "root", "more", "keys")
    return columns.groupBy("key", "l", "r").applyInPandas(run, "a binary, b binary")


def _verified(close: DataFrame, contents: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose whole bags overlap by ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                found.append(both >= least * (len(x) + len(y) - both))
            yield _taken(batch, found)

    return _with_sides(close, contents, "items").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of every linked node's component, by alternating large and small
    stars; each round is a few joins and sums over the links, written down before the next."""
    for _ in range(most_rounds):
        both = links.select("a", "b").filter("a <> b")
        both = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # All links now point from the larger to the smaller node.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
        )).alias("l")).select("l.*").filter("a <> b").distinct()
        links = stored(small, "links")
        # Done when all are stars: every node has one root, and no root has another.
        one, none = F.lit(1), F.lit(0)
        ends = links.select(F.col("a").alias("node"), one.alias("up"), none.alias("down")).union(links.select("b", none, one))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        if ends.filter("up > 1 OR up > 0 AND down > 0").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select("b", "b").distinct().toDF("node", "root")
            )
    raise RuntimeError("the components did not settle")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after the links (a, b) between known components (node, root) and single nodes. However many
    links two components have, one is followed."""
    ends = links
    for end in ("a", "b"):
        side = roots.select(F.col("node").alias(end), F.col("root").alias(f"of_{end}"))
        ends = ends.join(side, end, "left")
    ends = ends.select(*[F.coalesce(f"of_{end}", end).alias(end) for end in ("a", "b")])
    later = components(stored(ends.filter("a <> b").distinct(), "ends"))
    moved = roots.join(later.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return stored(moved.unionByName(later.join(roots, "node", "left_anti")), "roots")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, bag_id, n_shingles.

    Texts belong together when their bags of five-word shingles (lower case, other marks ignored)
    overlap by ``similarity`` or more, directly or through others; ``class_id`` is the class's smallest
    id, ``class_size`` its number of rows, ``bag_id`` names the text's words. Texts of fewer words are one
    shingle; texts without words (null, empty, marks only) are classes of their own, as are null ids
    without words. Repeated rows fall into one class. An empty table gives no rows; other columns
    are ignored.
    """
    rooted = _rooted(docs, id_col, text_col, similarity)
    known = rooted.filter("root IS NOT NULL")
    sizes = known.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    joined = known.join(sizes, "root").select("doc_id", "class_id", "class_size", "bag", "weight").unionByName(
        rooted.filter("root IS NULL").select(
            "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"), "bag", "weight"
        )
    )
    return joined.select("doc_id", "class_id", "class_size", F.hex("bag").alias("bag_id"), F.col("weight").alias("n_shingles"))


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """``docs`` with one row of each class, all columns kept: the smallest id (null ids last), then the
    smallest hash of the text. Rows without words all stay."""
    rooted = _rooted(docs, id_col, text_col, similarity)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    best = rooted.filter("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("best"))
    stay = best.select(F.col("best.doc_id").alias("__id"), F.col("best.h").alias("__h"), F.lit(True).alias("__words"))
    empty = rooted.filter("root IS NULL").select("doc_id", "h", F.lit(False)).distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("h"),
    )
    stay = stay.union(empty)
    kept = rows.join(stay, rows["id"].eqNullSafe(stay["__id"]) & (rows["h"] == stay["__h"]))
    # Rows equal in id and text are one document of their class.
    first = F.row_number().over(Window.partitionBy("id", "h").orderBy(F.lit(0)))
    return kept.withColumn("__place", first).filter("__place = 1 OR NOT __words").select("row.*")


def _rooted(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    """(doc_id, h, bag, weight, root): ``root`` names the class, null for rows without words."""
    table = stored(signed(docs, id_col, text_col), "signed")
    classes = _classes(docs, table, text_col, similarity)
    rooted = table.select("doc_id", "h", "bag", "weight").join(classes, table["bag"] == classes["node"], "left")
    return rooted.select("doc_id", "h", "bag", "weight", F.coalesce("root", "bag").alias("root"))


def _classes(docs: DataFrame, table: DataFrame, text_col: str, similarity: float) -> DataFrame:
    """(node, root) of the bags that are linked to others."""
    bags = table.filter("bag IS NOT NULL").groupBy("bag").agg(F.min("h").alias("h"), F.min("weight").alias("weight"), F.first("keys").alias("keys"))
    entries = bags.select("bag", "h", "weight", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1").select("key")
    entries = stored(entries.join(shared, "key", "left_semi"), "entries")
    contents = stored(_contents(docs, entries.select("h").distinct(), text_col), "bags")
    tested = roots = None
    for step in range(HUB_ROUNDS + 1):
        members = entries.withColumn("root", F.col("bag")) if roots is None else entries.join(
            roots, entries["bag"] == roots["node"], "left"
        ).withColumn("root", F.coalesce("root", "bag"))
        # A key is open while its members lie in more than one component.
        state = members.groupBy("key").agg(
            F.min(F.xxhash64("root")).alias("r1"), F.max(F.xxhash64("root")).alias("r2"), F.count("*").alias("n"),
            F.min(F.xxhash64("bag", F.lit(step))).alias("hub"),
        ).filter("r1 <> r2")
        open_ = members.select("key", "bag", "weight", "root").join(state.select("key", "n", "hub"), "key")
        if step < HUB_ROUNDS:
            hubs = open_.filter(F.xxhash64("bag", F.lit(step)) == F.col("hub")).select(
                "key", F.col("bag").alias("hb"), F.col("weight").alias("hw"), F.col("root").alias("hr")
            )
            pairs = open_.join(hubs, "key").filter("root <> hr")
            # Bags whose sizes differ too much cannot overlap enough.
            pairs = pairs.filter(F.least("weight", "hw") >= F.lit(similarity) * F.greatest("weight", "hw"))
            pairs = pairs.select(F.least("bag", "hb").alias("a"), F.greatest("bag", "hb").alias("b")).distinct()
            close = _close(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), contents, similarity)
        else:
            close = _close_in_blocks(open_, contents, similarity).join(tested, ["a", "b"], "left_anti")
        close = stored(close, "pairs")
        tested = close if tested is None else tested.union(close)
        found = stored(_verified(close, contents, similarity), "alike")
        roots = components(found) if roots is None else _merged(roots, found)
    return roots
