"""Feature preparation: clipping, scaling, ordinal and one-hot encoding."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.functions import names
from tidyspark.functions.numbers import round_even
from tidyspark.operators import facts
from tidyspark.operators.clean import known_facts
from tidyspark.operators.keyed import BROADCAST_ROWS, fits_broadcast, look_up, number_rows
from tidyspark.operators.quantiles import quantiles
from tidyspark.session import cut_lineage

# Clipping needs more than this many values in a column.
CLIP_MINIMUM = 4


def _predictors(df: DataFrame, target: str | None) -> list[str]:
    return [c for c in names.numeric_columns(df) if not names.same_name(c, target)]


def _number(df: DataFrame, column: str) -> Column:
    return facts.value_of(df.schema[column]).cast("double")


def clip_outliers(df: DataFrame, lower: float = 0.01, upper: float = 0.99, target: str | None = None) -> DataFrame:
    """Limit each numeric column to its two quantiles; missing values stay missing."""
    columns = _predictors(df, target)
    if not columns:
        return df
    counts = known_facts(df, ["nulls"], columns)
    eligible = [c for c in columns if counts[c]["rows"] - counts[c]["nulls"] > CLIP_MINIMUM]
    changes = {}
    for column, (low, high) in quantiles(df, {c: [lower, upper] for c in eligible}).items():
        value = _number(df, column)
        changes[column] = F.when(value < low, low).when(value > high, high).otherwise(value)
    return df.withColumns(changes) if changes else df


def scale(df: DataFrame, method: str = "standard", target: str | None = None) -> DataFrame:
    """Scale numeric columns by ``standard``, ``minmax`` or ``robust``, to 4 decimals.

    The statistics come from one aggregation; as literals they leave the rewrite
    a plain projection.
    """
    columns = _predictors(df, target)
    if not columns:
        return df
    rules = {"standard": _standard, "minmax": _minmax, "robust": _robust}
    scaled = rules[method](df, columns)
    return df.withColumns({c: round_even(expression, 4) for c, expression in scaled.items()})


def _standard(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    found = known_facts(df, ["mean", "deviation"], columns)
    return {
        c: (_number(df, c) - found[c]["mean"]) / found[c]["deviation"] if found[c]["deviation"] else F.lit(0.0)
        for c in columns
    }


def _minmax(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    found = known_facts(df, ["low", "high"], columns)
    result = {}
    for c in columns:
        low, high = found[c]["low"], found[c]["high"]
        varies = low is not None and high > low
        result[c] = (_number(df, c) - low) / (high - low) if varies else F.lit(0.0)
    return result


def _robust(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    result = {}
    for c, (q25, q50, q75) in quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns}).items():
        if q50 is None:
            result[c] = F.lit(None).cast("double")
        else:
            centred = _number(df, c) - q50
            result[c] = centred / (q75 - q25) if q75 > q25 else centred
    return result


def encodable(df: DataFrame, target: str | None) -> list[str]:
    """Text columns that are neither the target nor identifier-like."""
    return [
        c for c in names.text_columns(df) if not names.same_name(c, target) and not names.is_identifier_name(c)
    ]


def _coded(seen: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """Add ``code``, the zero-based place of a value among those of its ``name``: one task per name while the
    dictionary's size is checked to be small, slices of one sort otherwise."""
    seen = cut_lineage(seen)
    if fits_broadcast(seen, limit):
        return seen.withColumn("code", F.row_number().over(Window.partitionBy("name").orderBy(*order)) - 1)
    numbered = number_rows(seen, [F.col("name"), *order], "position")
    first = {r["name"]: r["first"] for r in numbered.groupBy("name").agg(F.min("position").alias("first")).collect()}
    start = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])
    return numbered.withColumn("code", F.col("position") - start[F.col("name")]).drop("position")


def value_codes(df: DataFrame, columns: list[str], limit: int = BROADCAST_ROWS) -> tuple[DataFrame, dict[str, int]]:
    """A dictionary table (name, value, code) of the text columns' values in UTF-8 byte order, nulls left out, and
    each column's number of values. The values stay on the cluster; one number per column comes to the driver."""
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("value")) for c in columns])
    seen = df.select(F.inline(cells)).filter("value IS NOT NULL").distinct()
    coded = cut_lineage(_coded(seen, [F.col("value")], limit))
    sizes = {r["name"]: r["count"] for r in coded.groupBy("name").count().collect()}
    return coded, {c: sizes.get(c, 0) for c in columns}


def with_codes(
    df: DataFrame, codes: DataFrame, named: dict[str, str], spread_by: list[str], limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Add the code of each column's value under the name ``named`` gives; -1 for nulls and values not in ``codes``."""
    for column, name in named.items():
        own = codes.filter(F.col("name") == column).select(F.col("value").alias("__value"), F.col("code").alias(name))
        df = look_up(df.withColumn("__value", F.col(f"`{column}`")), own, "__value", spread_by, limit=limit).drop("__value")
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(-1)).cast("bigint"))
    return df


def encode_ordinal(
    df: DataFrame, order_by: list[str], target: str | None = None, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Replace text by the rank of its first appearance in ``order_by`` order;
    missing values get -1.

    The dictionary of all columns is built by one aggregation. It is numbered in
    one task per column while its size is checked to be small, and by slices
    otherwise; the look-up broadcasts it or spreads hot values over many tasks.
    """
    columns = encodable(df, target)
    if not columns:
        return df
    place = F.struct(*[F.col(f"`{c}`") for c in order_by])
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("value")) for c in columns])
    seen = (
        df.select(place.alias("place"), F.inline(cells))
        .filter("value IS NOT NULL")
        .groupBy("name", "value")
        .agg(F.min("place").alias("place"))
    )
    ranked = _coded(seen, [F.col("place"), F.col("value")], limit)
    for column in columns:
        codes = ranked.filter(F.col("name") == column).select(
            F.col("value").alias(column), F.col("code").cast("bigint").alias("__code")
        )
        df = (
            look_up(df, codes, column, spread_by=order_by, limit=limit)
            .withColumn(column, F.coalesce("__code", F.lit(-1).cast("bigint")))
            .drop("__code")
            .select(*[F.col(f"`{c}`") for c in df.columns])
        )
    return df


def categories(df: DataFrame, columns: list[str], max_categories: int | None = None) -> dict[str, list[str]]:
    """Sorted distinct values per column. They become columns of a table, so all are
    returned; a caller who wants no wide tables sets ``max_categories``: an error then
    names a column with more, and at most one more value per column leaves the cluster.
    """
    if not columns:
        return {}
    counted = facts.value_counts(df, columns).filter(F.col("s").isNotNull())
    if max_categories is not None:
        order = Window.partitionBy("ordinal").orderBy("s")
        counted = counted.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= max_categories + 1)
    found: dict[str, list[str]] = defaultdict(list)
    for row in counted.select("ordinal", "s").collect():
        found[df.columns[row["ordinal"] - 1]].append(row["s"])
    for column, values in found.items():
        if max_categories is not None and len(values) > max_categories:
            raise ValueError(f"column {column} has more than {max_categories} categories")
    return {c: sorted(found[c], key=lambda v: v.encode()) for c in columns}


def one_hot_columns(found: dict[str, list[str]]) -> dict[str, Column]:
    """Indicator expressions ``<column>_<value>``; the first category is implied."""
    return {
        f"{column}_{value}": F.coalesce((F.col(f"`{column}`") == value).cast("bigint"), F.lit(0).cast("bigint"))
        for column, values in found.items()
        for value in values[1:]
    }


def encode_onehot(df: DataFrame, target: str | None = None, max_categories: int | None = None) -> DataFrame:
    """Replace text columns by indicator columns appended after the others."""
    columns = encodable(df, target)
    if not columns:
        return df
    added = one_hot_columns(categories(df, columns, max_categories))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, *[expression.alias(name) for name, expression in added.items()])
