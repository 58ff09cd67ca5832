"""Phrase collocations from stripes: every prefix keys a counter of its next words.

Level by level, from the empty prefix to prefixes of three words, each task gathers stripes in arrays (prefix, next
words, counts), stripes are shuffled whole and merged elementwise. An occurrence of a prefix that no
counted word follows adds to the counter's nameless rest, so a merged stripe holds three things: the
phrases that extend its prefix, the prefix's own number of occurrences (the sum), and the greatest count of
an extension, which tells whether the prefix is subsumed on the right; read by its last words, the same counters
tell it on the left.

No phrase is more frequent than its parts. A level counts only phrases whose prefix and suffix are frequent,
as told by a bitmap of bounded size that may let more through but never less. Stripes of frequent
prefixes are dealt over several tasks by their next words. Words travel as 64-bit hashes, under a seed for
which all words of the corpus differ; the words themselves come back at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.llm import words as w
from tidyspark.llm.common import Bitmap, join_with_hot, list_array, small_batches, stored

LEAST, LONGEST, SUBSUMED, TOP = 30, 4, 80, 2_000
SCALE = 2_000_000
NO_LANGUAGE = "und"
ENDS = w.byte_set(*b".,;:!?", *range(0x0A, 0x0E))
BREAKS = ENDS | w.byte_set(0x20, 0x09)
BATCH_BYTES, HELD_ROWS = 1 << 22, 1 << 20
#: A prefix with more than this share of all occurrences is dealt to ``SHARDS``; there are no more of them than its inverse.
HOT_SHARE, SHARDS = 1_000, 64
REST = 0
TURNS = (0, 21, 42)


def batch_words(values: list[str], seed: int) -> tuple[np.ndarray, ...]:
    """(hash, text, piece, first byte, length) of every word, and the bytes."""
    data, ends = w.joined(values, b"\n")
    first, length = w.places(data, BREAKS)
    hashed = w.hashes(data, first, length, seed)
    hashed[hashed == REST] = 1
    piece = np.cumsum(ENDS[data])[first]
    return hashed.view(np.int64), np.searchsorted(ends, first, side="right"), piece, first, length, data


def _source(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE))
    return docs.select(
        lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )


def _vocabulary(source: DataFrame, seed: int) -> DataFrame:
    """(lang, next, word, c): the stripe of the empty prefix, one row per word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            hashed, text, _, first, length, data = batch_words(batch.column("text").to_pylist(), seed)
            names, lang = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
            lang = lang[text]
            # Words of one batch are told apart by hash and length, those of different batches by their letters.
            order = np.lexsort((length, hashed, lang))
            columns = [c[order] for c in (lang, hashed, length)]
            new = np.ones(len(order), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
            at = np.flatnonzero(new)
            counts = np.diff(np.append(at, len(order)))
            starts, sizes = first[order[at]], length[order[at]]
            raw = data[_ranges(starts, sizes)]
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            word = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[columns[0][at]], pa.string()), pa.array(columns[1][at]), word, pa.array(counts)],
                ["lang", "next", "word", "c"],
            )

    found = source.mapInArrow(run, "lang string, next bigint, word string, c bigint")
    return found.groupBy("lang", "next", "word").agg(F.sum("c").alias("c"))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _turned(x, by: int):
    """A rotation of 64 bits, of an array or of a column."""
    if isinstance(x, Column):
        return x if not by else F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, 64 - by))
    x = x.view(np.uint64)
    return (x if not by else x << w.U(by) | x >> w.U(64 - by)).view(np.int64)


def _place(lang: np.ndarray, grams: list[np.ndarray]) -> np.ndarray:
    """A hash of phrases that Spark can compute as well (``_column_place``)."""
    for x, by in zip(grams, TURNS):
        lang = lang ^ _turned(x, by)
    return lang


def _column_place(phrase: str, size: int) -> Column:
    place = F.xxhash64("lang")
    for i, by in zip(range(size), TURNS):
        place = place.bitwiseXOR(_turned(F.col(phrase)[i], by))
    return place


class _Stripes:
    """Counts of (language, prefix, next word), held by a task in arrays of bounded size."""

    def __init__(self):
        self.langs, self.parts, self.rows = {}, [], 0

    def add(self, names: np.ndarray, lang: np.ndarray, grams: list[np.ndarray]) -> Iterator[tuple]:
        codes = np.array([self.langs.setdefault(n, len(self.langs)) for n in names], np.int64)
        self.parts.append(([codes[lang], *grams], np.ones(len(lang), np.int64)))
        self.rows += len(lang)
        if self.rows > HELD_ROWS:
            self._combine()
            if self.rows > HELD_ROWS // 2:
                yield from self.emit()

    def _combine(self) -> None:
        columns = [np.concatenate(c) for c in zip(*(p[0] for p in self.parts))]
        counts = np.concatenate([p[1] for p in self.parts])
        key = np.zeros(len(counts), np.uint64)
        for column in columns:
            key = w.mixed(key * w.PRIME + column.view(np.uint64))
        order = np.argsort(key)
        columns = [c[order] for c in columns]
        at = np.flatnonzero(_differs(columns))
        summed = np.add.reduceat(counts[order], at) if len(at) else counts
        self.parts, self.rows = [([c[at] for c in columns], summed)], len(at)

    def emit(self) -> Iterator[tuple]:
        """(language codes, grams, counts) of all that is held."""
        if not self.rows:
            return
        self._combine()
        (lang, *grams), counts = self.parts[0]
        self.parts, self.rows = [], 0
        yield lang, grams, counts


def _differs(columns: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _striped(lang_names: list[str], lang: np.ndarray, grams: list[np.ndarray], counts: np.ndarray, lang_hash: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
    """Rows of (lang, prefix, shard, nexts, counts)."""
    *prefix, following = grams
    shard = np.where(np.isin(_place(lang_hash[lang], prefix), hot), (following.view(np.uint64) >> w.U(58)).astype(np.int64), 0)
    order = np.lexsort((shard, *prefix[::-1], lang))
    lang, shard, following, counts = lang[order], shard[order], following[order], counts[order]
    prefix = [p[order] for p in prefix]
    at = np.flatnonzero(_differs([lang, shard, *prefix]))
    ends = np.append(at, len(order))
    wide = len(prefix)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(lang_names, object)[lang[at]], pa.string()),
         list_array(np.stack([p[at] for p in prefix], axis=1).ravel(), np.arange(len(at) + 1) * wide, pa.int64()),
         pa.array(shard[at].astype(np.int32)), list_array(following, ends, pa.int64()), list_array(counts, ends, pa.int64())],
        ["lang", "prefix", "shard", "nexts", "counts"],
    )


def _level(source: DataFrame, size: int, seed: int, frequent: Bitmap, hot: np.ndarray, least: int) -> DataFrame:
    """(lang, prefix, shard, total, counter): the merged stripes of prefixes of ``size`` words. The counter holds the
    next words that follow ``least`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Stripes()
        hashes: dict[str, int] = {}

        def packed(found):
            names = list(held.langs)
            own = np.array([hashes[n] for n in names], np.int64)
            for lang, grams, counts in found:
                yield _striped(names, lang, grams, counts, own, hot)

        for batch in small_batches(batches, "text", BATCH_BYTES):
            hashed, text, piece, *_ = batch_words(batch.column("text").to_pylist(), seed)
            if len(hashed) < size:
                continue
            langs = batch.column("lang").to_pylist()
            hashes.update(zip(langs, batch.column("lang_hash").to_pylist()))
            names, lang = np.unique(np.array(langs, object), return_inverse=True)
            lang = lang[text]
            own = np.array([hashes[n] for n in names], np.int64)[lang]
            many = len(hashed) - size + 1
            grams = [hashed[j : j + many] for j in range(size)]
            known = (piece[:many] == piece[size - 1 :]) & frequent.holds(_place(own[:many], grams))
            # The next word counts if the piece goes on and the words up to it, but for the first, are frequent too.
            following = np.full(many, REST, np.int64)
            goes_on = np.flatnonzero(known[:-1] & known[1:] & (piece[: many - 1] == piece[size:]))
            following[goes_on] = hashed[goes_on + size]
            at = np.flatnonzero(known)
            yield from packed(held.add(names, lang[at], [*(g[at] for g in grams), following[at]]))
        yield from packed(held.emit())

    stripes = source.mapInArrow(run, "lang string, prefix array<bigint>, shard int, nexts array<bigint>, counts array<bigint>")
    dealt = stripes.repartition("lang", "prefix", "shard").sortWithinPartitions("lang", "prefix", "shard")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a stripe follow each other; the last one of a batch may go on in the next.
        open_: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c) for c in ("lang", "prefix", "shard", "nexts", "counts")]
            rows = (
                np.array(columns[0].to_pylist(), object), columns[1].flatten().to_numpy().reshape(-1, size),
                columns[2].to_numpy(), pc.list_value_length(columns[3]).to_numpy(),
            )
            entries = tuple(c.flatten().to_numpy() for c in columns[3:])
            if open_:
                rows, entries = (tuple(np.concatenate(x) for x in zip(a, b)) for a, b in zip(open_, (rows, entries)))
            rows, entries = merged_stripes(rows, entries)
            last = int(rows[3][-1])
            open_ = tuple(c[-1:] for c in rows), tuple(c[len(c) - last :] for c in entries)
            yield counted(tuple(c[:-1] for c in rows), tuple(c[: len(c) - last] for c in entries), least)
        if open_:
            yield counted(*open_, least)

    kind = "lang string, prefix array<bigint>, shard int, total bigint, counter array<struct<next: bigint, c: bigint>>"
    return dealt.mapInArrow(merge, kind)


def merged_stripes(rows: tuple, entries: tuple) -> tuple[tuple, tuple]:
    """Elementwise sums of neighbouring equal stripes. Rows are (lang, prefix, shard, entries of the row), entries (next, count)."""
    lang, prefix, shard, lengths = rows
    new = _differs([lang, shard, *prefix.T])
    stripe = np.repeat(np.cumsum(new) - 1, lengths)
    order = np.lexsort((entries[0], stripe))
    stripe, following = stripe[order], entries[0][order]
    at = np.flatnonzero(_differs([stripe, following]))
    counts = np.add.reduceat(entries[1][order], at)
    return (lang[new], prefix[new], shard[new], np.bincount(stripe[at], minlength=new.sum())), (following[at], counts)


def counted(rows: tuple, entries: tuple, least: int) -> pa.RecordBatch:
    """Stripes as rows: their sum, and a counter of the next words that are frequent."""
    lang, prefix, shard, lengths = rows
    following, counts = entries
    ends = np.cumsum(lengths)
    sums = np.append(0, np.cumsum(counts))
    kept = (counts >= least) & (following != REST)
    held = np.append(0, np.cumsum(kept))
    counter = pa.StructArray.from_arrays([pa.array(following[kept]), pa.array(counts[kept])], ["next", "c"])
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), list_array(prefix.ravel(), np.arange(len(lang) + 1) * prefix.shape[1], pa.int64()),
         pa.array(shard, pa.int32()), pa.array(sums[ends] - sums[ends - lengths]),
         pa.ListArray.from_arrays(pa.array(np.append(0, held[ends]), pa.int32()), counter)],
        ["lang", "prefix", "shard", "total", "counter"],
    )


def _phrases(stripes: DataFrame) -> DataFrame:
    """(lang, phrase, a): the phrases that the stripes' counters hold."""
    entry = stripes.select("lang", "prefix", F.inline("counter"))
    return entry.select("lang", F.concat("prefix", F.array("next")).alias("phrase"), F.col("c").alias("a"))


def _hot(phrases: DataFrame, size: int, total: int) -> np.ndarray:
    """Hashes of the prefixes with more than a thousandth of all words; there can be no more than a thousand."""
    rows = phrases.filter(F.col("a") * HOT_SHARE > total).select(_column_place("phrase", size).alias("h")).collect()
    return np.array([r["h"] for r in rows], np.int64)


def stripes_of(source: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """(vocabulary, stripes): the counter of the empty prefix by word, and the merged stripes of all longer prefixes."""
    seed = 0
    while True:
        vocabulary = stored(_vocabulary(source, seed), "vocabulary")
        names = vocabulary.groupBy("next").agg(F.min("word").alias("one"), F.max("word").alias("other"))
        if names.filter("one <> other").isEmpty():
            break
        seed += 1  # two words share a hash
    total = vocabulary.agg(F.sum("c")).first()[0] or 0
    phrases = vocabulary.filter(F.col("c") >= least).select("lang", F.array("next").alias("phrase"), F.col("c").alias("a"))
    levels = []
    for size in range(1, longest):
        bitmap = Bitmap.of(phrases, _column_place("phrase", size))
        levels.append(stored(_level(source, size, seed, bitmap, _hot(phrases, size, total), least), "stripes"))
        phrases = _phrases(levels[-1])
    stripes = levels[0]
    for level in levels[1:]:
        stripes = stripes.unionByName(level)
    return vocabulary, stripes


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
    subsumed: int = SUBSUMED, top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of every language.

    Words are runs without blanks and tabs of texts in lower case (A to Z), phrases of 2 to ``longest`` words do not cross
    marks or line breaks, and occur ``least`` times or more (``a``); ``l`` and ``r`` count the two parts
    of the lowest-scoring cut, ``n`` all words of the language. A phrase is dropped where a longer one around it has ``subsumed``
    percent of its occurrences. Ties of the score go to the more frequent phrase, then to the smaller one in bytes.

    A null language is ``und``; null and empty texts have no words; repeated rows count as often as they occur; texts of
    any length are taken whole. An empty table gives no rows; other columns are ignored.
    """
    if not 2 <= longest <= len(TURNS) + 1:
        raise ValueError(f"longest must lie between 2 and {len(TURNS) + 1}")
    vocabulary, stripes = stripes_of(_source(docs, text_col, lang_col), least, longest)
    phrases = stored(_phrases(stripes), "phrases")
    totals = stored(
        stripes.groupBy("lang", "prefix").agg(F.sum("total").alias("total"), F.max(F.array_max("counter.c")).alias("best")).filter(
            F.col("total") >= least
        ), "totals",
    )
    # Longer candidates around a phrase: by its own stripe on the right, by counters that end with it on the left.
    around = totals.filter("best IS NOT NULL").select("lang", F.col("prefix").alias("phrase"), "best").union(
        phrases.filter(F.size("phrase") > 2).select("lang", F.slice("phrase", 2, longest).alias("phrase"), F.col("a").alias("best"))
    )
    around = around.groupBy("lang", "phrase").agg(F.max("best").alias("best"))
    kept = phrases.join(around, ["lang", "phrase"], "left")
    wide = "CAST({} AS DECIMAL(20,0))".format
    kept = kept.filter(F.expr(f"best IS NULL OR 100 * {wide('best')} < {int(subsumed)} * {wide('a')}")).drop("best")
    parts = totals.select(F.struct("lang", "prefix").alias("part"), "total")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)))
    for name, part in (("l", F.slice("phrase", F.lit(1), F.col("k"))), ("r", F.slice("phrase", F.col("k") + 1, F.lit(longest)))):
        cuts = cuts.withColumn("part", F.struct("lang", part.alias("prefix")))
        cuts = stored(join_with_hot(cuts, parts, "part", how="inner").withColumnRenamed("total", name).drop("part"), "cuts")
    score = F.expr(f"CAST({SCALE} * {wide('a')} AS DECIMAL(38,0)) DIV ({wide('l')} + {wide('r')})")
    cuts = cuts.withColumn("score", score.cast("bigint"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = stored(best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "scored")
    names = vocabulary.filter(F.col("c") >= least).select("next", "word").distinct()
    letters = scored.select("lang", "phrase", F.posexplode("phrase").alias("place", "next"))
    spelled = join_with_hot(letters, names, "next", how="inner").groupBy("lang", "phrase").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    named = scored.join(spelled, ["lang", "phrase"]).withColumn("phrase", F.concat_ws(" ", "words.word"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    all_words = vocabulary.groupBy("lang").agg(F.sum("c").alias("n"))
    return ranked.join(all_words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
