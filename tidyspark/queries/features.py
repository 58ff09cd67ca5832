"""Queries over feature preparation."""

from __future__ import annotations

from tidyspark.functions.numbers import round_even
from tidyspark.operators import features as f
from tidyspark.queries.base import query, sql_round, table

_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_WORDS = ("l_returnflag", "l_linestatus")


def _lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*_NUMBERS, *_WORDS)


def _with_stats(stats: dict[str, str], value: str) -> str:
    """Rewrite each number by a formula over its own column's statistics."""
    inner = ", ".join(f"{sql.format(c=c)} AS {name}_{c}" for c in _NUMBERS for name, sql in stats.items())
    outer = ", ".join(f"{value.format(c=c)} AS {c}" for c in _NUMBERS)
    return f"WITH stats AS (SELECT {inner} FROM lineitem) SELECT {outer}, {', '.join(_WORDS)} FROM lineitem, stats"


@query(
    "feat_clip",
    _with_stats(
        {"low": "quantile_cont({c}, 0.01)", "high": "quantile_cont({c}, 0.99)"},
        sql_round("CASE WHEN {c} < low_{c} THEN low_{c} WHEN {c} > high_{c} THEN high_{c} ELSE {c} END", 6),
    ),
)
def feat_clip(spark, sf_dir):
    clipped = f.clip_outliers(_lineitem(spark, sf_dir))
    return clipped.withColumns({c: round_even(clipped[c], 6) for c in _NUMBERS})


@query(
    "feat_scale_standard",
    _with_stats(
        {"mean": "avg({c})", "dev": "stddev_samp({c})"},
        sql_round("CASE WHEN dev_{c} > 0 THEN ({c} - mean_{c}) / dev_{c} ELSE 0.0 END", 4),
    ),
)
def feat_scale_standard(spark, sf_dir):
    return f.scale(_lineitem(spark, sf_dir), "standard")


@query(
    "feat_scale_minmax",
    _with_stats(
        {"low": "min({c})", "high": "max({c})"},
        sql_round("CASE WHEN high_{c} > low_{c} THEN ({c} - low_{c}) / (high_{c} - low_{c}) ELSE 0.0 END", 4),
    ),
)
def feat_scale_minmax(spark, sf_dir):
    return f.scale(_lineitem(spark, sf_dir), "minmax")


@query(
    "feat_scale_robust",
    _with_stats(
        {"q1": "quantile_cont({c}, 0.25)", "q2": "quantile_cont({c}, 0.5)", "q3": "quantile_cont({c}, 0.75)"},
        sql_round("CASE WHEN q3_{c} > q1_{c} THEN ({c} - q2_{c}) / (q3_{c} - q1_{c}) ELSE {c} - q2_{c} END", 4),
    ),
)
def feat_scale_robust(spark, sf_dir):
    return f.scale(_lineitem(spark, sf_dir), "robust")


@query(
    "feat_encode_ordinal",
    """WITH seen AS (SELECT c_mktsegment AS v, min(c_custkey) AS place FROM customer GROUP BY c_mktsegment),
coded AS (SELECT v, row_number() OVER (ORDER BY place, v) - 1 AS code FROM seen)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, code AS c_mktsegment FROM customer JOIN coded ON v = c_mktsegment""",
)
def feat_encode_ordinal(spark, sf_dir):
    return f.encode_ordinal(table(spark, sf_dir, "customer"), ["c_custkey"])


@query(
    "feat_encode_onehot",
    """SELECT l_quantity, l_extendedprice, l_discount, l_tax,
  (l_returnflag = 'N')::BIGINT AS "l_returnflag_N", (l_returnflag = 'R')::BIGINT AS "l_returnflag_R",
  (l_linestatus = 'O')::BIGINT AS "l_linestatus_O" FROM lineitem""",
)
def feat_encode_onehot(spark, sf_dir):
    return f.encode_onehot(_lineitem(spark, sf_dir))
