"""Facts about a table's columns, gathered in one scan.

``column_facts`` is the only place that aggregates whole columns. It stays lazy:
one row per column, each row carrying the table's row count, so every report
(profile, quality, validation, plan) is a small projection on top of it and only
the statistics that report asks for are computed.

The scan is one ungrouped aggregation. Each task folds its rows into a single
buffer row, so what is shuffled is one row per task whatever the table's size
and however its values are spread. Wide tables are cut into groups of columns so
that every aggregation stays below the field limit of whole-stage code
generation; a columnar scan then still reads every column once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.functions import names, numbers, text

# Whole-stage code generation is given up above 100 buffer fields.
FIELD_LIMIT = 90

NUMBER, TEXT, BOOLEAN, OTHER = "number", "text", "boolean", "other"

# name -> (result type, aggregation buffer fields)
STATISTICS = {
    "nulls": ("bigint", 1),
    "padded": ("bigint", 1),
    "negatives": ("bigint", 1),
    "low": ("double", 1),
    "high": ("double", 1),
    "mean": ("double", 2),
    "deviation": ("double", 3),
    "text_low": ("double", 1),
    "text_high": ("double", 1),
    "text_mean": ("double", 2),
    "all_numbers": ("boolean", 1),
    "all_integers": ("boolean", 1),
    "all_booleans": ("boolean", 1),
    "all_dates": ("boolean", 1),
}


def kind_of(field: T.StructField) -> str:
    if names.is_boolean(field):
        return BOOLEAN
    if names.is_numeric(field):
        return NUMBER
    return TEXT if names.is_text(field) else OTHER


def value_of(field: T.StructField) -> Column:
    """The column with NaN read as missing."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return numbers.not_nan(value)
    return value


def _aggregate(field: T.StructField, statistic: str) -> Column | None:
    """The aggregate behind one statistic, None where it does not apply."""
    value, kind = value_of(field), kind_of(field)
    if statistic == "nulls":
        return F.count_if(value.isNull())
    if kind in (NUMBER, BOOLEAN):
        # a boolean counts as 0/1 in a profile; it is never negative
        number = value.cast("int" if kind == BOOLEAN else "double").cast("double")
        simple = {"low": F.min, "high": F.max, "mean": F.avg, "deviation": F.stddev_samp}
        if statistic in simple:
            return simple[statistic](number)
        if statistic == "negatives" and kind == NUMBER:
            return F.count_if(value < 0)
    if kind == TEXT:
        if statistic == "padded":
            return F.count_if(text.is_padded(value))
        over_numbers = {"text_low": F.min, "text_high": F.max, "text_mean": F.avg}
        if statistic in over_numbers:
            return over_numbers[statistic](text.to_number(value))
        every = {
            "all_numbers": text.is_number,
            # shares the number test with the statistics above; most text fails it at once
            "all_integers": lambda v: text.is_number(v) & text.is_integer(v),
            "all_booleans": text.is_boolean_word,
        }
        if statistic in every:
            return F.bool_and(every[statistic](value))
        if statistic == "all_dates" and names.is_date_name(field.name):
            return F.bool_and(F.when(value.isNotNull(), text.to_date(value).isNotNull()))
    return None


# Statistics that one counter-example settles, and what else they make pointless.
SETTLED_BY = {
    "all_numbers": ("all_numbers", "all_integers", "text_low", "text_high", "text_mean"),
    "all_integers": ("all_integers",),
    "all_booleans": ("all_booleans",),
    "all_dates": ("all_dates",),
}
FIRST_LOOK_ROWS = 256
# Smaller tables are scanned in full as fast as they are looked at.
FIRST_LOOK_FROM = 100_000

Disproved = dict[str, set[str]]


def first_look(
    df: DataFrame,
    want: list[str],
    rows: int = FIRST_LOOK_ROWS,
    smallest: int = FIRST_LOOK_FROM,
    total: int | None = None,
) -> Disproved:
    """Which "every value is a …" statements the first few rows already refute.

    One counter-example settles such a statement for the whole column, so the
    full scan need not test it again. Nothing is concluded from rows that agree.
    ``total`` is the table's row count where it is known already.
    """
    tests = [s for s in want if s in SETTLED_BY]
    fields = [f for f in df.schema if names.is_text(f)]
    if not tests or not fields or (df.count() if total is None else total) < smallest:
        return {}
    sample = df.select(*[F.col(f"`{f.name}`") for f in fields]).take(rows)
    if not sample:
        return {}
    local = df.sparkSession.createDataFrame(sample, T.StructType(fields))
    return {
        row["name"]: {gone for test in tests if row[test] is False for gone in SETTLED_BY[test]}
        for row in column_facts(local, tests).collect()
    }


def _groups(fields: list[tuple[int, T.StructField]], want: list[str]) -> list[list[tuple[int, T.StructField]]]:
    """Consecutive columns whose aggregation buffers fit one generated stage."""
    groups, used = [[]], 2
    for item in fields:
        need = sum(STATISTICS[s][1] for s in want if _aggregate(item[1], s) is not None)
        if groups[-1] and used + need > FIELD_LIMIT:
            groups.append([])
            used = 2
        groups[-1].append(item)
        used += need
    return groups


def all_missing(df: DataFrame) -> Column:
    """True for a row in which every value is missing."""
    return F.coalesce(*[F.when(value_of(f).isNotNull(), F.lit(True)) for f in df.schema]).isNull()


def _facts_of_group(
    df: DataFrame, fields: list[tuple[int, T.StructField]], want: list[str], empties: bool, disproved: Disproved
) -> DataFrame:
    wanted = [
        (i, f, s, None if s in disproved.get(f.name, ()) else _aggregate(f, s)) for i, f in fields for s in want
    ]
    empty_rows = F.count_if(all_missing(df)) if empties else F.lit(None).cast("bigint")
    totals = df.agg(
        F.count("*").alias("rows"),
        empty_rows.alias("empty_rows"),
        *[agg.alias(f"{s}_{i}") for i, _, s, agg in wanted if agg is not None],
    )

    def absent(field: T.StructField, statistic: str) -> Column:
        refuted = statistic.startswith("all_") and statistic in disproved.get(field.name, ())
        return F.lit(False) if refuted else F.lit(None)

    def entry(i: int, field: T.StructField) -> Column:
        present = {s for j, _, s, agg in wanted if j == i and agg is not None}
        return F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("dtype"),
            F.lit(kind_of(field)).alias("kind"),
            "rows",
            "empty_rows",
            *[
                (F.col(f"{s}_{i}") if s in present else absent(field, s)).cast(STATISTICS[s][0]).alias(s)
                for s in want
            ],
        )

    return totals.select(F.inline(F.array(*[entry(i, f) for i, f in fields])))


def column_facts(
    df: DataFrame, want: list[str], empty_rows: bool = False, disproved: Disproved | None = None
) -> DataFrame:
    """One row per column: ``ordinal, name, dtype, kind, rows, empty_rows`` and
    the wanted statistics (NULL where a statistic does not apply to the type).

    ``all_*`` statistics are NULL for a column without values. ``disproved`` names
    statistics per column that need no test any more (see ``first_look``): ``all_*``
    then read false, numbers held as text read NULL.
    """
    if not df.columns:
        raise ValueError("a table needs at least one column")
    groups = _groups(list(enumerate(df.schema, start=1)), want)
    parts = [
        _facts_of_group(df, group, want, empty_rows and index == 0, disproved or {})
        for index, group in enumerate(groups)
    ]
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, columns: list[str] | None = None, typed: bool = True) -> DataFrame:
    """How often each value of each column occurs: ``ordinal, s, n, d, times``.

    Text sits in ``s``, integers in ``n``, other numbers in ``d``; all three are
    NULL for missing values. Counting happens per task before the shuffle, so a
    value that fills a third of the table costs one row per task.
    """
    chosen = [(i, f) for i, f in enumerate(df.schema, start=1) if columns is None or f.name in columns]

    def cell(i: int, field: T.StructField) -> Column:
        value, kind = value_of(field), kind_of(field)
        integral = isinstance(field.dataType, T.IntegralType) or kind == BOOLEAN
        fractional = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        as_text = None if integral or fractional else value.cast("string")
        return F.struct(
            F.lit(i).alias("ordinal"),
            (F.lit(None).cast("string") if as_text is None else as_text).alias("s"),
            (value.cast("bigint") if integral else F.lit(None).cast("bigint")).alias("n"),
            (value.cast("double") if fractional else F.lit(None).cast("double")).alias("d"),
        )

    cells = df.select(F.inline(F.array(*[cell(i, f) for i, f in chosen])))
    return cells.groupBy("ordinal", "s", "n", "d").agg(F.count("*").alias("times"))
