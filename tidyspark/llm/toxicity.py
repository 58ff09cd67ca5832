"""Toxicity by embeddings of character n-grams.

Every text is a bag of the byte n-grams of its words (with their borders); the
embeddings of the bag are averaged and go into a linear softmax, and embeddings and
softmax are learned together. Misspelt or unseen words share n-grams, hence vectors, with
those seen. For scoring, the linear layer is folded into the embeddings: one number per
n-gram bucket, averaged over the text.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyspark.llm.common import small_batches, stored, texts

SIZES = (3, 4, 5, 6)
BUCKET_BITS, WIDTH = 20, 4
#: Rows the model is fitted on, at most (by a hash of their id); each counts with its whole text.
TRAIN_ROWS = 6_000
EPOCHS, BATCH, RATE, GAIN = 5, 32, 0.2, 300.0
THRESHOLD = 0.3
HELD_OUT_OF, HELD_OUT = 4, 2
_PRIME = np.uint64(0x100000001B3)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _plain(texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, every run of other marks as one blank, and where each text begins;
    each begins and ends with a blank."""
    data = np.frombuffer(("\x00".join(["", *texts_]) + "\x00").encode(), np.uint8)
    word = _WORD_BYTE[data]
    # A zero byte inside a text is a mark like others, so the borders come from the lengths.
    sizes = np.array([len(t) if t.isascii() else len(t.encode()) for t in texts_], np.int64)
    borders = np.append(0, np.cumsum(sizes + 1))
    keep = word.copy()
    keep[1:] |= word[:-1]
    keep[borders] = True
    place = np.cumsum(keep) - 1
    return np.where(word, data, np.uint8(32))[keep], place[borders]


def ngrams(plain: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every size: positions whose n-gram lies in one word and its borders, and their buckets."""
    n = len(plain)
    blank = plain == 32
    inner = np.zeros(n, bool)  # a blank strictly inside the n-gram so far
    state = plain.astype(np.uint64) + np.uint64(1)
    for size in range(2, SIZES[-1] + 1):
        m = n - size + 1
        if m <= 0:
            return
        state = state[:m] * _PRIME + plain[size - 1 :] + np.uint64(size)
        if size > 2:
            inner = inner[:m] | blank[size - 2 : size - 2 + m]
        else:
            inner = inner[:m]
        if size in SIZES:
            at = np.flatnonzero(~inner)
            mixed = (state[at] ^ (state[at] >> np.uint64(29))) * _SPREAD
            yield at, (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # one per bucket: the embedding times the difference of the classes' softmax rows
    bias: float
    learned: bool = True  # False without texts of both classes: then scores tell nothing about a text

    def scores(self, values: list[str]) -> np.ndarray:
        """Probability of the toxic class for every text, from all its n-grams."""
        plain, borders = _plain(values)
        total, count = np.zeros(len(values)), np.zeros(len(values))
        for at, buckets in ngrams(plain):
            place = np.searchsorted(at, borders)
            sums = np.append(0.0, np.cumsum(self.weights[buckets], dtype=np.float64))
            total += np.diff(sums[place])
            count += np.diff(place)
        logit = GAIN * total / np.maximum(count, 1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500)))


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram buckets of a text and how often each occurs: at most one entry per bucket, however long the text."""
    plain, _ = _plain([text])
    found = [b for _, b in ngrams(plain)]
    bucket, times = np.unique(np.concatenate(found) if found else np.zeros(0, np.int32), return_counts=True)
    return bucket.astype(np.int32), times.astype(np.int32)


class Bags:
    """Bags in an unnamed file, read back a few at a time, so that memory does not grow with the sample's texts."""

    def __init__(self, bags: Iterable[tuple[np.ndarray, np.ndarray]]):
        self.file, self.sizes = tempfile.TemporaryFile(), []
        for bucket, times in bags:
            self.file.write(bucket.astype(np.int32).tobytes() + times.astype(np.int32).tobytes())
            self.sizes.append(len(bucket))
        self.starts = np.cumsum([0, *self.sizes])[:-1] * 8

    def ordered(self, order: np.ndarray) -> Bags:
        self.sizes, self.starts = [self.sizes[i] for i in order], self.starts[order]
        return self

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and their weights, which add up to GAIN."""
        self.file.seek(int(self.starts[i]))
        bucket, times = np.frombuffer(self.file.read(8 * self.sizes[i]), np.int32).reshape(2, -1)
        return bucket, (GAIN * times / max(1, times.sum(dtype=np.int64))).astype(np.float32)


def fit(values: list[str], labels: list[int], seed: int = 7) -> Model:
    """``learn`` from texts."""
    return learn(Bags(map(bag, values)), labels, seed)


def learn(bags: Bags, labels: list[int], seed: int = 7) -> Model:
    """Learn embeddings and softmax together (adaptive gradient steps, in numpy).

    Without texts of both classes nothing is learned: the score is the share of toxic ones (0.5 if there are
    no texts) and the model says so.
    """
    toxic = np.array(labels, np.int64)
    share = float(toxic.mean()) if len(toxic) else 0.5
    if not len(toxic) or not 0 < share < 1:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3))), False)
    random = np.random.default_rng(seed)
    size = 1 << BUCKET_BITS
    vectors = random.normal(0, 0.01, (WIDTH, size)).astype(np.float32)
    seen = np.zeros(size, bool)
    for i in range(len(bags)):
        seen[bags[i][0]] = True
    vectors[:, ~seen] = 0  # an n-gram that was never seen says nothing
    layer = random.normal(0, 0.5, (2, WIDTH)).astype(np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    past = np.full((WIDTH, size), 1e-4, np.float32)
    past_layer, past_bias = np.full_like(layer, 1e-2), np.full_like(bias, 1e-2)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = random.permutation(len(bags))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            read = [bags[i] for i in chosen]
            bucket, weight = (np.concatenate(part) for part in zip(*read))
            row = np.repeat(np.arange(len(chosen)), [len(b) for b, _ in read])
            mean = np.stack([np.bincount(row, weight * v[bucket], len(chosen)) for v in vectors], 1)
            logits = mean @ layer.T + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            error = odds / odds.sum(1, keepdims=True)
            error[np.arange(len(chosen)), toxic[chosen]] -= 1
            error /= len(chosen)
            back = error @ layer
            touched, place = np.unique(bucket, return_inverse=True)
            step = error.T @ mean
            past_layer += step**2
            layer -= rate * step / np.sqrt(past_layer)
            step = error.sum(0)
            past_bias += step**2
            bias -= rate * step / np.sqrt(past_bias)
            for d in range(WIDTH):
                step = np.bincount(place, weight * back[row, d], len(touched)).astype(np.float32)
                past[d, touched] += step**2
                vectors[d, touched] -= rate * step / np.sqrt(past[d, touched])
    return Model((layer[1] - layer[0]) @ vectors, float(bias[1] - bias[0]))


def held_out(doc_id: Column | str) -> Column:
    """Rows whose labels are not learned from: CRC-32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(HELD_OUT_OF)) == HELD_OUT, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    rows: int = TRAIN_ROWS,
) -> Model:
    """Fit on at most ``rows`` labelled rows that are not held out, chosen by a hash of their id.

    ``rows`` is the only bound (``TRAIN_ROWS`` unless told otherwise): no row is left out for the length of its
    text. Labels other than 0 and 1 and null ids are ignored; of several labels for an id the largest
    counts. Only the chosen ids go to the join; texts become bags of at most one entry per bucket in the
    tasks, and the driver writes the chosen bags to a file.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
    # The sample is taken from the ids, so few texts are moved; more ids than rows allow for labels without a text.
    drawn = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(rows)
    source = texts(docs, id_col, text_col).select("doc_id", F.lower("text").alias("text"))
    sample = source.join(F.broadcast(drawn), "doc_id").select(
        F.xxhash64("doc_id", F.lit(11)).alias("first"), F.xxhash64("text").alias("then"), "toxic", "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 20):
            bags = [bag(text) for text in batch.column("text").to_pylist()]
            columns = [pa.array([part.tobytes() for part in parts], pa.binary()) for parts in (zip(*bags) if bags else ((), ()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("first", "then", "toxic")), *columns], ["first", "then", "toxic", "bucket", "times"])

    made = sample.mapInArrow(run, "first bigint, then bigint, toxic int, bucket binary, times binary")
    # Stored with a number a row, so that two reads agree on the rows.
    made = stored(made.withColumn("n", F.monotonically_increasing_id()), "bags")
    order = {r["n"]: i for i, r in enumerate(made.orderBy("first", "then", "n").limit(rows).select("n").collect())}
    places, toxic = [], []

    def chosen() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for r in made.select("n", "toxic", "bucket", "times").toLocalIterator():  # a partition at a time
            if r["n"] in order:
                places.append(order[r["n"]])
                toxic.append(r["toxic"])
                yield np.frombuffer(r["bucket"], np.int32), np.frombuffer(r["times"], np.int32)

    bags = Bags(chosen())
    return learn(bags.ordered(np.argsort(places)), [toxic[i] for i in np.argsort(places)])


def is_toxic(score: Column | str, model: Model) -> Column:
    """Whether a score reaches the threshold; never, if the model has learned nothing."""
    return (F.col(score) if isinstance(score, str) else score) >= THRESHOLD if model.learned else F.lit(False)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the toxicity of every whole text, 0 to 1, as column ``name``.

    A null or empty text has no n-grams and gets the model's prior. Nothing but the text is looked
    at. All columns stay as they are; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # fixed size

    @F.arrow_udf("double")
    def toxic(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for value in values:
            table = pa.RecordBatch.from_arrays([value], ["text"])
            parts = [Model(*shared.value).scores(b.column("text").to_pylist()) for b in small_batches(iter([table]), "text", 1 << 22)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return docs.withColumn(name, toxic(F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))))


def crc_held_out(doc_id: int) -> bool:
    """``held_out`` for one id."""
    return zlib.crc32(str(doc_id).encode()) % HELD_OUT_OF == HELD_OUT
