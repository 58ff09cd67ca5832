"""The registered queries of the subpackage: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyspark.llm import (
    bagminhash, bpe, chat, collocations, content_sort, hard_negatives, licenses, mixing, neighbours, ngram_join, secret_scan, suffix, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licences(_table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.col("licences.licence")))
    return found.select(
        "doc_id", F.size("sentences").alias("n_sentences"), F.size("licences").alias("n_licences"),
        F.concat_ws(",", names).alias("licence_names"),
        F.concat_ws(",", F.transform("licences", lambda x: F.concat_ws(":", x.licence, x.start, x.stop))).alias("spans"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op3_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_sort(_table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
"""


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.round_trip(_table(spark, sf_dir, "documents"), ranks_path())
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _joined(spans: str) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)))


def _times(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))
    counts = [_times(k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        toxicity.is_toxic("score", model).cast("int").alias("predicted"),
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("SELECT -1L AS conv_id, t.turn AS turn, t.role AS role, '</s>[INST] ok [/INST]' AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return chat.read_back(chat.format_turns(turns.unionByName(probe)))


def op9_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


OP11_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, list_dot_product(a.v, e.v)::BIGINT AS score
  FROM e AS a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


def op12_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [words]
    ELSE list_transform(range(1, len(words) - 1), lambda i: words[i : i + 2]) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s AS a JOIN s AS b USING (shingle) JOIN n AS na ON na.doc_id = a.doc_id
  JOIN n AS nb ON nb.doc_id = b.doc_id WHERE a.doc_id <> b.doc_id GROUP BY x, y, na.n_shingles, nb.n_shingles
  HAVING 100 * count(*) >= 90 * (na.n_shingles + nb.n_shingles - count(*))),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT doc_id, coalesce(n_shingles, 0) AS n_shingles, (SELECT min(y) FROM r WHERE r.x = d.doc_id) AS component_id,
  (SELECT count(*) FROM l WHERE l.x = d.doc_id) AS n_links
FROM documents AS d LEFT JOIN n USING (doc_id)
"""


def op13_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda m: list_transform(range(1, len(words) - m + 2),
    lambda i: words[i : i + m - 1])))) AS ws FROM w),
f AS (SELECT lang, ws, count(*) AS f FROM g GROUP BY lang, ws),
n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, ws, f AS a FROM f WHERE len(ws) >= 2 AND f >= 30),
k AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM c),
s AS (SELECT k.lang, k.ws, k.a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * k.a) // (x.f + y.f))::BIGINT AS score
  FROM k JOIN f AS x ON x.lang = k.lang AND x.ws = k.ws[1:k] JOIN f AS y ON y.lang = k.lang AND y.ws = k.ws[k + 1:]
  QUALIFY row_number() OVER (PARTITION BY k.lang, k.ws ORDER BY score, k) = 1),
o AS (SELECT lang, a, unnest(list_concat([ws[1:2], ws[2:3]], CASE WHEN len(ws) = 4 THEN [ws[3:4], ws[1:3], ws[2:4]] ELSE [] END)) AS ws
  FROM c WHERE len(ws) > 2),
b AS (SELECT lang, ws, max(a) AS best FROM o GROUP BY lang, ws),
e AS (SELECT s.lang, array_to_string(s.ws, ' ') AS phrase, s.a, l, r, score FROM s LEFT JOIN b ON b.lang = s.lang AND b.ws = s.ws
  WHERE best IS NULL OR 100 * best < 80 * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM e JOIN n USING (lang) QUALIFY rank <= 2000
"""


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_licenses, op2_mixing, op3_content_sort, op4_byte_bpe, op5_secrets, op6_neighbours, op7_toxicity, op8_chat,
        op9_bagminhash, op10_suffix, op11_slots, op12_combinations, op13_stripes,
    )
}
ORACLES: dict[str, str] = {
    "op3_content_sort": OP3_SQL.strip(), "op11_slots": OP11_SQL.strip(), "op12_combinations": OP12_SQL.strip(),
    "op13_stripes": OP13_SQL.strip(),
}
