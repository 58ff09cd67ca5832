"""Hard negatives, the Jaccard join and collocations against brute force and hard inputs."""

import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import CLASHING, DOCS, hard_rows, passage
from tests.oracle import connect, normal
from tidyspark.llm import collocations, hard_negatives, ngram_join
from tidyspark.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def hard(spark):
    df = spark.createDataFrame(hard_rows(), DOCS)
    extra = spark.createDataFrame([], f"{CLASHING}, set binary, size int, n int, root string").schema
    return df.selectExpr("*", *[f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in extra]).cache()


@pytest.mark.parametrize("name", ["op11_slots", "op12_combinations", "op13_stripes"])
def test_queries_match_sql(spark, name):
    got = QUERIES[name](spark, SMALL)
    want = connect(SMALL).execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert set(columns) <= set(got.columns)
    rows = got.select(*columns).collect()
    assert normal(rows, range(len(columns))) == normal(want.fetchall(), range(len(columns)))


# ---- hard negatives -------------------------------------------------------------


def brute_negatives(rows, many, k, lowest, highest):
    """Every anchor, positive and negative one by one, in whole numbers."""
    by_id = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or x != x or abs(x) == INF for x in vector):
            continue
        by_id[i] = min(by_id.get(i, (label, vector)), (label, vector))
    whole = {i: (label, [int(np.floor(256 * x)) for x in vector]) for i, (label, vector) in by_id.items()}

    def score(i, j):
        return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(whole[i][1], whole[j][1]))))

    found = set()
    for a in whole:
        if a % 3:
            continue
        others = [j for j in whole if j != a and len(whole[j][1]) == len(whole[a][1])]
        ranked = sorted((-score(a, j), j) for j in others)
        positives = [(j, -s) for s, j in ranked if whole[j][0] == whole[a][0]][:many]
        for positive, top in positives:
            fits = [(j, -s) for s, j in ranked if whole[j][0] != whole[a][0] and lowest * top <= -100 * s <= highest * top][:k]
            found |= {(a, positive, r, j, top, s) for r, (j, s) in enumerate(fits, 1)}
    return found


@pytest.mark.parametrize("block_rows, anchor_rows", [(7, 3), (8_192, 2_048)])
def test_negatives_match_brute_force(spark, block_rows, anchor_rows):
    rnd = random.Random(4)
    rows = [(i, rnd.randrange(3), [round(rnd.uniform(-0.4, 1), 1) for _ in range(4)]) for i in range(60)]
    rows += [(i, 1, rows[0][2]) for i in range(60, 70)]  # ties
    rows += [(70, None, [1.0] * 4), (71, 0, None), (72, 0, [1.0, None, 1.0, 1.0]), (73, 0, [NAN] * 4), (74, 0, [INF] * 4), (None, 0, [1.0] * 4)]
    rows += [rows[0], (3, 0, [0.5] * 4), (75, 1, [0.5] * 3), (78, 2, [0.25] * 3), (76, 1, [0.0] * 4), (77, 0, [-1.0] * 4)]
    rows += [(81, 0, []), (84, 1, []), (87, 0, [])]
    df = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "vec_id bigint, label int, embedding array<double>, score double, anchor_id int")
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 3 == 0, block_rows=block_rows, anchor_rows=anchor_rows)
    assert {tuple(r) for r in got.collect()} == brute_negatives(rows, 5, 3, 50, 95)
    wide = hard_negatives.hard_negatives(df, F.col("vec_id") % 3 == 0, many=2, k=6, lowest=10, highest=100)
    assert {tuple(r) for r in wide.collect()} == brute_negatives(rows, 2, 6, 10, 100)


def test_negatives_of_large_components_and_empty_tables(spark):
    rows = [(0, 0, [1e9, 2.0]), (1, 0, [1e8, 1.0]), (2, 1, [7e7, 3.0]), (3, 1, [6e7, -3.0]), (6, 0, [1e300, 0.0]), (9, 1, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    got = {tuple(r) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % 3 == 0).collect()}
    assert got == brute_negatives(rows, 5, 3, 50, 95)
    assert not hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 3 == 0).count()
    assert not hard_negatives.hard_negatives(df, F.col("vec_id") < 0).count()


# ---- Jaccard join ------------------------------------------------------------------


def brute_join(rows, percent):
    sets = []
    for _, text in rows:
        words = [m.encode() for m in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))]
        sets.append({tuple(words[i : i + 3]) for i in range(max(len(words) - 2, 1))} if words else set())
    links = collections.defaultdict(set)
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            links[i].add(j)
            links[j].add(i)
    found = []
    for i, (doc, _) in enumerate(rows):
        reached, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reached
            reached |= new
            todo += new
        ids = [rows[j][0] for j in reached if rows[j][0] is not None]
        found.append((doc, len(sets[i]), min(ids, default=None), len(links[i])))
    return sorted(found, key=repr)


def joined(df, percent=90):
    return sorted(map(tuple, ngram_join.jaccard_join(df, percent=percent).collect()), key=repr)


def near_copies(seed, many, size, changes):
    rnd, words = random.Random(seed), passage(seed, size).split()
    for _ in range(many):
        copy = list(words)
        for _ in range(rnd.randrange(changes)):
            copy[rnd.randrange(size)] = f"w{rnd.randrange(10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("percent", [90, 70])
def test_join_matches_brute_force(spark, percent, monkeypatch):
    # Low widths: combinations of two and three tokens in several bins decide, and blocks of few rows meet.
    monkeypatch.setattr(ngram_join, "WIDTHS", {2: 2, 3: 6})
    for name, value in (("PAIR_ROWS", 4), ("COUNT_ROWS", 4), ("COUNT_TOKENS", 64)):
        monkeypatch.setattr(ngram_join, name, value)
    shared = passage(9, 40)
    texts = [*near_copies(1, 30, 150, 8), *near_copies(2, 12, 400, 20), *near_copies(3, 12, 12, 2), *near_copies(4, 10, 4, 2)]
    texts += [f"{passage(100 + i, 30)} {shared} {passage(200 + i, 20)}" for i in range(25)]
    texts += [texts[0], texts[0].upper(), f"{shared} {shared}", shared, f"{shared} end"]
    rows = [((i * 7) % 1_009, text) for i, text in enumerate(texts)]
    assert joined(spark.createDataFrame(rows, "doc_id bigint, text string"), percent) == brute_join(rows, percent)


def test_join_of_hard_rows(hard, spark):
    assert joined(hard) == brute_join([(i, t) for i, t, *_ in hard_rows()], 90)
    assert ngram_join.jaccard_join(hard.limit(0)).count() == 0
    with pytest.raises(ValueError):
        ngram_join.jaccard_join(hard, percent=20)
    ids = spark.createDataFrame([("b", "one two"), ("a", "One\ttwo"), ("c", "one two three")], "doc_id string, text string")
    assert joined(ids) == [("a", 1, "a", 1), ("b", 1, "a", 1), ("c", 1, "c", 0)]


def test_prefix_keys_meet():
    """Two sets that link have a key in common, whatever classes the tokens have."""
    rnd = random.Random(6)
    for _ in range(300):
        size = rnd.randrange(9, 400)
        x = {rnd.randrange(2**60) for _ in range(size)}
        y = set(rnd.sample(sorted(x), size - rnd.randrange(ngram_join.errors_allowed(size, 90) + 1)))
        if rnd.random() < 0.5:
            y |= {rnd.randrange(2**60) for _ in range(rnd.randrange(1 + size // 20))}
        if 100 * len(x & y) < 90 * len(x | y):
            continue
        widths = {t: rnd.choice(rnd.choice([(1,), (1, 2, 3), (2, 3), (3,)])) for t in x | y}
        keys = []
        for side in (x, y):
            tokens = sorted(side)[: ngram_join.prefix_length(len(side), 90)]
            keys.append(set(ngram_join.prefix_keys(np.array(tokens, np.uint64), np.array([widths[t] for t in tokens], np.int8), len(side), 90).tolist()))
        assert keys[0] & keys[1]


def test_near_members_are_given_along_spanning_pairs_then_once(spark):
    """40 near copies under five keys: 39 pairs a key in the first round, each of the 780 pairs once in the next."""
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(400)]
    tokens = [np.sort(np.array([*base[:390], *(rnd.getrandbits(64) for _ in range(8))], np.uint64)) for _ in range(40)]
    names = [bytes([i]) * 16 for i in range(40)]
    contents = spark.createDataFrame(
        [(n, t.tobytes(), ngram_join.histogram(t).tobytes()) for n, t in zip(names, tokens)], "set binary, items binary, histogram binary"
    )
    members = spark.createDataFrame(
        [(k, 40, n, len(t), n) for k in range(5) for n, t in zip(names, tokens)], "key bigint, n bigint, set binary, size bigint, root binary"
    )
    first = ngram_join._near_in_blocks(members, contents, 90, least=True)
    every = ngram_join._near_in_blocks(members, contents, 90, least=False)
    assert first.count() == 5 * 39 and every.count() == every.distinct().count() == 780
    roots = ngram_join.components(first.distinct())
    assert roots.count() == 40 and roots.select("root").distinct().count() == 1


def test_near_members_of_many_small_keys_are_found_together(spark, monkeypatch):
    """Keys of a few members are compared many at a time, across batches and blocks, with the pairs that each has alone."""
    rnd, percent = random.Random(11), 90
    base = [[rnd.getrandbits(64) for _ in range(rnd.choice([60, 64, 300]))] for _ in range(6)]
    sets = [np.unique(np.array([*b[: len(b) - rnd.randrange(9)], *(rnd.getrandbits(64) for _ in range(rnd.randrange(4)))], np.uint64)) for b in base for _ in range(20)]
    names, grams = [bytes([i]) * 16 for i in range(len(sets))], [ngram_join.histogram(t).astype(int) for t in sets]
    contents = spark.createDataFrame([(n, t.tobytes(), ngram_join.histogram(t).tobytes()) for n, t in zip(names, sets)], "set binary, items binary, histogram binary")
    keys = [rnd.sample(range(len(sets)), rnd.choice([2, 3, 5, 30])) for _ in range(300)]
    members = spark.createDataFrame(
        [(k, len(of), names[i], len(sets[i]), names[i % 40]) for k, of in enumerate(keys) for i in of], "key bigint, n bigint, set binary, size bigint, root binary"
    )

    def fits(i, j):
        n = len(sets[i]), len(sets[j])
        near = (100 + percent) * np.abs(grams[i] - grams[j]).sum() <= (100 - percent) * sum(n)
        return i % 40 != j % 40 and 100 * min(n) >= percent * max(n) and near

    wanted = {(names[min(i, j)], names[max(i, j)]) for of in keys for i in of for j in of if i < j and fits(i, j)}
    for rows in (ngram_join.PAIR_ROWS, 8):
        monkeypatch.setattr(ngram_join, "PAIR_ROWS", rows)
        got = ngram_join._near_in_blocks(members, contents, percent, least=False)
        assert wanted and {tuple(r) for r in got.collect()} == wanted
    first = {tuple(r) for r in ngram_join._near_in_blocks(members, contents, percent, least=True).collect()}
    assert first <= wanted
    ids = [0] * 7 + [1] * 5 + [2, 3, 3]
    batches = [pa.RecordBatch.from_pydict({"key": ids[at : at + 4]}) for at in range(0, len(ids), 4)] + [pa.RecordBatch.from_pydict({"key": pa.array([], pa.int64())})]
    pieces = [t.column("key").to_pylist() for t in ngram_join._whole_blocks(iter(batches), ["key"])]
    assert sum(pieces, []) == ids and all(a[-1] != b[0] for a, b in zip(pieces, pieces[1:]))


def test_blocks_of_few_rows_are_no_call_each(spark, monkeypatch):
    """One look takes in many keys: no grouped call per key, whose cost alone was most of the step."""
    rnd = random.Random(12)
    tokens = np.sort(np.array([rnd.getrandbits(64) for _ in range(50)], np.uint64))
    rows = pa.table({
        "key": np.repeat(np.arange(500), 3), "l": np.zeros(1500, np.int32), "r": np.zeros(1500, np.int32), "side": np.zeros(1500, np.int32),
        "size": np.full(1500, 50), "histogram": [ngram_join.histogram(tokens).tobytes()] * 1500, "root": [bytes([i % 3]) * 16 for i in range(1500)],
    })
    block, i, j, difference, *_ = ngram_join._near(rows, 90)
    assert np.bincount(block).tolist() == [3] * 500 and (i < j).all() and not difference.any()


def test_join_without_hubs_and_with_small_blocks(spark, monkeypatch):
    """Links found by the last two rounds alone, in blocks of a few members, are those of all pairs."""
    monkeypatch.setattr(ngram_join, "HUBS", 0)
    monkeypatch.setattr(ngram_join, "PAIR_ROWS", 4)
    rnd = random.Random(10)
    rows = []
    for group in range(3):
        text = [f"w{group}x{i}" for i in range(60)]
        for _ in range(15):  # a chain: each text differs a little from the one before
            text = [rnd.choice([w, w, w, w, w, w, w, w, w, w, w, w, w, w, w, w, w, w, w, w + "y"]) if i > 56 else w for i, w in enumerate(text)]
            rows.append((len(rows), " ".join(text)))
            text = text[1:] + [f"n{len(rows)}"]
    sets = {i: {tuple(t.split()[j : j + 3]) for j in range(len(t.split()) - 2)} for i, t in rows}
    links = {i: [j for j in sets if j != i and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])] for i in sets}
    least = {}
    for i in sets:
        if i not in least:
            open_, least[i] = [i], i
            while open_:
                for j in links[open_.pop()]:
                    if j not in least:
                        least[j] = i
                        open_.append(j)
    got = ngram_join.jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_links"]) for r in got} == {i: (least[i], len(links[i])) for i in sets}
    assert len(set(least.values())) < len(rows) and max(map(len, links.values())) > 1


# ---- collocations -----------------------------------------------------------------------


def brute_collocations(rows, least, top):
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + m])) for m in range(1, 5) for i in range(len(words) - m + 1))
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    best = collections.Counter()
    for (lang, words), a in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                best[lang, words[i : i + m]] = max(best[lang, words[i : i + m]], a)
    found = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * best[lang, words] >= 80 * a:
            continue
        parts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(parts))
        found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, r, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, all_ in found.items() for r, (score, a, phrase, left, right) in enumerate(sorted(all_)[:top], 1)
    )


@pytest.mark.parametrize("held", [50, 1 << 20])
def test_collocations_match_brute_force(spark, held, monkeypatch):
    monkeypatch.setattr(collocations, "HELD_ROWS", held)
    monkeypatch.setattr(collocations, "BATCH_BYTES", 300)
    rnd = random.Random(8)
    vocabulary = [*"abcdef", "É", "日本", "x" * 40, "the", "The", "\x00", "a\x00"]
    rows = []
    for i in range(400):
        words = [rnd.choice(vocabulary) + rnd.choice(["", "", "", "", ",", "!"]) for _ in range(rnd.randrange(30))]
        rows.append((rnd.choice(["en", "de", None, "und", ""]), rnd.choice([" ", "  ", "\t", " \n"]).join(words)))
    rows += [("en", None), ("en", ""), ("fr", " .,; "), *[("en", "hot hot hot")] * 60]
    df = spark.createDataFrame([(i, t, lang, 0.5) for i, (lang, t) in enumerate(rows)], "doc_id int, text string, lang string, score double")
    got = sorted(tuple(r) for r in collocations.collocations(df, least=5, top=40).collect())
    assert got == brute_collocations(rows, 5, 40)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_collocations_of_hard_rows(hard):
    rows = [(lang, text) for _, text, lang, *_ in hard_rows()]
    got = collocations.collocations(hard, least=2)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, 2, 2_000)


def test_shared_hashes_take_another_seed(spark, monkeypatch):
    """Two words with one hash are noticed, and the next seed is tried."""
    plain, seeds = collocations._vocabulary, []

    def clash(source, seed):
        seeds.append(seed)
        found = plain(source, seed)
        return found if seed else found.withColumn("next", F.lit(7).cast("bigint"))

    monkeypatch.setattr(collocations, "_vocabulary", clash)
    rows = [("en", "aa bbb cc")] * 3
    df = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    got = sorted(tuple(r) for r in collocations.collocations(df, least=2).collect())
    assert got == brute_collocations(rows, 2, 2_000) and seeds == [0, 1]
