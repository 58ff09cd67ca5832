"""Byte-level BPE over whole texts, as numpy matrices.

A batch of texts is split into pieces with array operations on code point classes
(letters, digits, blanks, others), equal pieces are merged into one, and the
remaining ones are padded into byte matrices by length. Each round merges, in every
row at once, the leftmost pair of lowest rank; pairs are looked up in an open hash
table, and finished rows are compacted away. Rows beyond the widest matrix (runs of
hundreds of letters or blanks) keep their pairs in a heap, which yields the same merges
without quadratic work.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from tidyspark.llm.common import list_array, small_batches, texts

NO_RANK = np.int32(1 << 30)
#: Widths of the matrices; longer pieces go through the heap.
WIDTHS = (4, 6, 8, 12, 16, 24, 32, 64, 128, 256)
BATCH_BYTES = 1 << 20
LETTER, DIGIT, BLANK, OTHER = range(4)
# The endings that the splitting pattern sets apart after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
# Letters and digits of Unicode 16, which the splitting pattern follows; the
# interpreter's own table is one version older.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_DIGITS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 token, rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class PairTable:
    """Open-addressing hash table: (left id, right id) to the rank of the joined token."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        bits = max(4, (4 * len(pairs)).bit_length())
        self.mask = np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NO_RANK, np.int32)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]  # of several claims to a slot one stands
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return _mixed(keys.view(np.uint64)).view(np.int64) & self.mask

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, ``NO_RANK`` where they do not join; a negative id never joins."""
        keys = (left.astype(np.int64) << 32) | right
        keys[keys < 0] = -2  # padding: a negative id on either side
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], NO_RANK)
        todo = np.flatnonzero((found >= 0) & (found != keys))
        slots = slots[todo]
        while len(todo):
            slots = (slots + 1) & self.mask
            found = self.keys[slots]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slots[hit]]
            on = (found >= 0) & ~hit
            todo, slots = todo[on], slots[on]
        return out


class Vocabulary:
    """What encoding and decoding need of the ranks, built once per Python worker."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        by_id = [b""] * size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.classes = _classes()
        # Short tokens as sorted words, to find the pieces that are tokens as they stand.
        short = sorted((int.from_bytes(t, "little"), len(t), r) for t, r in ranks.items() if len(t) <= 8 and t[-1:] != b"\0")
        self.words = np.array([w for w, _, _ in short], np.uint64)
        self.word_lengths = np.array([n for _, n, _ in short], np.int64)
        self.word_ids = np.array([r for _, _, r in short], np.int32)

    def whole(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Ids of the pieces (padded rows as words) that are tokens, -1 for the others."""
        out = np.full(len(words), -1, np.int32)
        if words.shape[1] == 1:
            at = np.minimum(np.searchsorted(self.words, words[:, 0]), len(self.words) - 1)
            hit = (self.words[at] == words[:, 0]) & (self.word_lengths[at] == lengths)
            out[hit] = self.word_ids[at[hit]]
            rest = np.flatnonzero(~hit & (words.view(np.uint8)[np.arange(len(words)), lengths - 1] == 0))
        else:
            rest = np.arange(len(words))
        rows = words.view(np.uint8)
        for row in rest:
            out[row] = self.ranks.get(rows[row, : lengths[row]].tobytes(), -1)
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[_ranges(self.starts[ids], self.lengths[ids])]


def _classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": DIGIT}
    table = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        char = chr(point)
        kind = kinds.get(unicodedata.category(char)[0])
        if kind is not None:
            table[point] = kind
        elif char.isspace() and not 0x1C <= point <= 0x1F:  # the four separators are no white space in Unicode
            table[point] = BLANK
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_DIGITS, DIGIT)):
        for first, last in ranges:
            table[first : last + 1] = kind
    return table


#: The vocabulary a Python worker built last, by the digest of its file.
_LOADED: dict[str, Vocabulary] = {}


def _vocabulary(key: str, shared: Broadcast) -> Vocabulary:
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(shared.value)
    return _LOADED[key]


def _shared(spark: SparkSession, path: str) -> tuple[str, Broadcast]:
    """The ranks on every executor; the vocabulary file bounds their size."""
    ranks = load_ranks(path)
    return hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest(), spark.sparkContext.broadcast(ranks)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of start .. start + length - 1."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def piece_starts(points: np.ndarray, doc_starts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where the pieces of the concatenated texts begin (code point positions).

    Same as matching the splitting pattern in each text on its own: runs of one class,
    a single space joined to the run it precedes, the last blank before a run set apart,
    and the endings after an apostrophe that begins a piece.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes[points]
    border = np.zeros(n + 1, bool)  # a text begins here
    border[doc_starts] = True
    border[n] = True
    start = border[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    blank = kind == BLANK
    # The last blank of a run that a non-blank follows in the same text.
    last = np.zeros(n, bool)
    last[:-1] = blank[:-1] & ~blank[1:] & ~border[1:n]
    start |= last
    after = np.flatnonzero(last & (points == 32)) + 1
    start[after] = False  # the space belongs to the run that follows
    # Apostrophe endings: a lone apostrophe that begins a piece, before letters.
    marks = np.flatnonzero((points == 39) & start)
    marks = marks[marks + 1 < n]
    marks = marks[(kind[marks + 1] == LETTER) & ~border[marks + 1]]
    if len(marks):
        one, two = points[marks + 1], points[np.minimum(marks + 2, n - 1)]
        two = np.where((marks + 2 < n) & ~border[np.minimum(marks + 2, n)], two, 0)
        taken = np.zeros(len(marks), np.int64)
        for ending in ENDINGS:
            fits = one == ord(ending[0])
            if len(ending) == 2:
                fits &= two == ord(ending[1])
            taken[fits & (taken == 0)] = len(ending)
        marks, taken = marks[taken > 0], taken[taken > 0]
        start[marks + 1] = False
        rest = marks + 1 + taken
        inside = rest < n
        start[rest[inside]] = True
    return np.flatnonzero(start)


def _merge_rows(tokens: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge every row of a matrix (padding -1) to the end: tokens and how many a row has."""
    rows, width = tokens.shape
    out = np.full((rows, width), -1, np.int32)
    index = np.arange(rows)
    if width == 1:
        return tokens, (tokens >= 0).sum(axis=1)
    ranks = pairs.ranks(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(rows, width - 1)
    while len(index):
        place = ranks.argmin(axis=1)  # the leftmost of the lowest
        every = np.arange(len(index))
        rank = ranks[every, place]
        done = rank == NO_RANK
        if done.any():
            out[index[done], : tokens.shape[1]] = tokens[done]
            go = ~done
            index, tokens, ranks, place, rank = index[go], tokens[go], ranks[go], place[go], rank[go]
            every = np.arange(len(index))
            if not len(index):
                break
        tokens[every, place] = rank
        keep = np.ones(tokens.shape, bool)
        keep[every, place + 1] = False
        tokens = tokens[keep].reshape(len(index), -1)
        if tokens.shape[1] == 1:
            out[index, 0] = tokens[:, 0]
            break
        keep = np.ones(ranks.shape, bool)
        keep[every, place] = False
        ranks = ranks[keep].reshape(len(index), -1)
        left = place > 0
        rows_l, at = every[left], place[left]
        ranks[rows_l, at - 1] = pairs.ranks(tokens[rows_l, at - 1], rank[left])
        right = place < ranks.shape[1]
        rows_r, at = every[right], place[right]
        ranks[rows_r, at] = pairs.ranks(rank[right], tokens[rows_r, at + 1])
    return out, (out >= 0).sum(axis=1)


def _merge_long(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """The same merges for one long piece, lowest rank then leftmost from a heap."""
    ranks, by_bytes = vocabulary.ranks, [piece[i : i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
    heap = [(r, i) for i in range(len(piece) - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        if by_bytes[i] is None or (j := after[i]) >= len(piece) or ranks.get(by_bytes[i] + by_bytes[j]) != rank:
            continue
        by_bytes[i] += by_bytes[j]
        by_bytes[j] = None
        after[i] = k = after[j]
        if k < len(piece):
            before[k] = i
            if (r := ranks.get(by_bytes[i] + by_bytes[k])) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get(by_bytes[h] + by_bytes[i])) is not None:
            heapq.heappush(heap, (r, h))
    return [ranks[token] for token in by_bytes if token is not None]


def _distinct(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct padded rows: their indexes and, for each row, its number among them.
    Rows are ordered by a hash and compared in full with their neighbours."""
    key = words[:, 0] ^ lengths.astype(np.uint64)
    for column in range(1, words.shape[1]):
        key = _mixed(key) ^ words[:, column]
    order = np.argsort(key)
    ordered, sizes = words[order], lengths[order]
    new = np.ones(len(order), bool)
    new[1:] = sizes[1:] != sizes[:-1]
    for column in range(words.shape[1]):
        new[1:] |= ordered[1:, column] != ordered[:-1, column]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def encode_texts(values: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, one after the other, and each text's number of tokens."""
    joined = "".join(values)
    data = np.frombuffer(joined.encode(), np.uint8)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(values), np.int64)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    ends = np.cumsum(sizes)
    starts = piece_starts(points, (ends - sizes)[sizes > 0], vocabulary.classes)
    at = starts if len(points) == len(data) else np.flatnonzero((data & 0xC0) != 0x80)[starts]
    length = np.diff(np.append(at, len(data)))
    counts = np.zeros(len(at), np.int64)  # tokens of each piece
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    padded = np.concatenate([data, np.zeros(WIDTHS[-1], np.uint8)])
    low = 0
    for width in WIDTHS:
        chosen = np.flatnonzero((length > low) & (length <= width))
        low = width
        if not len(chosen):
            continue
        sizes_in, whole_width = length[chosen], -(-width // 8) * 8
        rows = np.lib.stride_tricks.sliding_window_view(padded, whole_width)[at[chosen]]
        padding = np.arange(whole_width) >= np.arange(width + 1)[:, None]
        words = rows.view(np.uint64) & ~(padding.astype(np.uint8) * np.uint8(255)).view(np.uint64)[sizes_in]
        first, number = _distinct(words, sizes_in)
        words, sizes_in = words[first], sizes_in[first]
        merged = np.full((len(first), width), -1, np.int32)
        merged[:, 0] = vocabulary.whole(words, sizes_in)
        many = np.ones(len(first), np.int64)
        apart = np.flatnonzero(merged[:, 0] < 0)
        if len(apart):
            tokens = vocabulary.byte_ids[words[apart].view(np.uint8)[:, :width]]
            tokens[padding[sizes_in[apart], :width]] = -1
            merged[apart], many[apart] = _merge_rows(tokens, vocabulary.pairs)
        counts[chosen] = many[number]
        found.append((chosen, merged[merged >= 0], (np.cumsum(many) - many)[number]))
    for i in np.flatnonzero(length > WIDTHS[-1]):
        piece = data[at[i] : at[i] + length[i]].tobytes()
        whole_id = vocabulary.ranks.get(piece)
        ids = [whole_id] if whole_id is not None else _merge_long(piece, vocabulary)
        counts[i] = len(ids)
        found.append((np.array([i]), np.array(ids, np.int32), np.zeros(1, np.int64)))
    before = np.cumsum(counts) - counts
    out = np.empty(counts.sum(), np.int32)
    for chosen, ids, offset in found:
        out[_ranges(before[chosen], counts[chosen])] = ids[_ranges(offset, counts[chosen])]
    total = np.append(before, counts.sum())[np.searchsorted(starts, ends)]  # pieces up to each text's end
    return out, np.diff(total, prepend=0)


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text, without special tokens.

    A null or empty text has no ids. Rows are encoded one by one, so repeated rows and
    null ids stay as they are; an empty table gives no rows; other columns are ignored.
    """
    key, shared = _shared(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = None
        for batch in small_batches(batches, "text", BATCH_BYTES):
            vocabulary = vocabulary or _vocabulary(key, shared)
            ids, counts = encode_texts(batch.column("text").to_pylist(), vocabulary)
            offsets = np.append(0, np.cumsum(counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), list_array(ids, offsets, pa.int32())], ["doc_id", "ids"]
            )

    source = texts(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def round_trip(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): ``encode`` and ``decode`` in one step, with one Python worker and vocabulary a task."""
    key, shared = _shared(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = None
        for batch in small_batches(batches, "text", BATCH_BYTES):
            vocabulary = vocabulary or _vocabulary(key, shared)
            ids, counts = encode_texts(batch.column("text").to_pylist(), vocabulary)
            ends = np.cumsum(counts)
            decoded = [vocabulary.decode(ids[end - n : end]).tobytes() for end, n in zip(ends, counts)]
            arrays = [batch.column("doc_id"), list_array(ids, np.append(0, ends), pa.int32()), pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    source = texts(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the bytes the ids stand for; null ids are none."""
    key, shared = _shared(encoded.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = None
        for batch in batches:
            vocabulary = vocabulary or _vocabulary(key, shared)
            decoded = []
            for ids in batch.column("ids"):
                ids = ids.values.to_numpy() if ids.is_valid else np.zeros(0, np.int64)
                decoded.append(vocabulary.decode(ids).tobytes())
            arrays = [batch.column("doc_id"), batch.column("ids"), pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    source = encoded.select("doc_id", "ids")
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")
