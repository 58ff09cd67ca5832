"""Cleaning rewrites. Each takes a DataFrame and returns a lazy DataFrame.

Rewrites that apply to a column only when *all* its values qualify need to look
at the values first. They take the column facts of a scan already made (``known``)
or make one scan for the columns in question.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.functions import names, text
from tidyspark.operators import facts
from tidyspark.operators.duplicates import drop_duplicate_rows
from tidyspark.operators.quantiles import medians, modes

Known = dict[str, Row]


def known_facts(df: DataFrame, want: list[str], columns: list[str] | None = None) -> Known:
    """Column facts by column name: one scan, one small row per column."""
    subset = df if columns is None else df.select(*[F.col(f"`{c}`") for c in columns])
    if not subset.columns:
        return {}
    refuted = facts.first_look(subset, want)
    return {row["name"]: row for row in facts.column_facts(subset, want, disproved=refuted).collect()}


def _rewrite(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    return df.withColumns(changes) if changes else df


def remove_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna("all")


def remove_empty_columns(df: DataFrame, known: Known | None = None) -> DataFrame:
    """Drop columns without any value; a table of nothing else is kept as it is."""
    known = known or known_facts(df, ["nulls"])
    empty = [c for c in df.columns if c in known and known[c]["nulls"] == known[c]["rows"]]
    return df if len(empty) == len(df.columns) else df.drop(*empty)


def remove_duplicates(df: DataFrame, rows: int | None = None) -> DataFrame:
    return drop_duplicate_rows(df, rows=rows)


def coerce_numeric(df: DataFrame, known: Known | None = None) -> DataFrame:
    """Text columns in which every value is a number become numeric: ``bigint``
    when all are integers, else ``double``."""
    columns = names.text_columns(df)
    known = known or known_facts(df, ["all_numbers", "all_integers"], columns)
    changes = {}
    for column in columns:
        if column in known and known[column]["all_numbers"]:
            number = text.to_number(F.col(f"`{column}`"))
            if known[column]["all_integers"]:
                number = text.plain_number(F.col(f"`{column}`")).cast("bigint")
            changes[column] = number
    return _rewrite(df, changes)


def normalise_booleans(df: DataFrame, known: Known | None = None) -> DataFrame:
    """Text columns made of boolean words only get ``Yes`` and ``No``."""
    columns = names.text_columns(df)
    known = known or known_facts(df, ["all_booleans"], columns)
    hits = [c for c in columns if c in known and known[c]["all_booleans"]]
    return _rewrite(df, {c: text.to_yes_no(F.col(f"`{c}`")) for c in hits})


def fill_values(df: DataFrame, known: Known | None = None) -> dict[str, str | float | None]:
    """What each column with missing values is filled with: the median of numbers,
    else the most frequent value, ``Unknown`` for text without values."""
    simple = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    known = known or known_facts(df, ["nulls"], simple)
    holed = [c for c in simple if c in known and known[c]["nulls"] > 0]
    numeric = [c for c in holed if names.is_numeric(df.schema[c])]
    common = modes(df, [c for c in holed if c not in numeric])
    for column, value in common.items():
        if value is None and names.is_text(df.schema[column]):
            common[column] = "Unknown"
    return {**medians(df, numeric), **common}


def fill_missing(df: DataFrame, values: dict[str, str | float | None] | None = None) -> DataFrame:
    """Fill missing values; a column that has nothing to be filled with stays as it is.

    Filled numeric columns are doubles, as a median may fall between integers.
    """
    changes = {}
    for column, filling in (fill_values(df) if values is None else values).items():
        field = df.schema[column]
        value = facts.value_of(field)
        if names.is_numeric(field):
            changes[column] = F.coalesce(value.cast("double"), F.lit(filling).cast("double"))
        elif filling is not None:
            changes[column] = F.coalesce(value, F.lit(filling).cast(field.dataType))
    return _rewrite(df, changes)


def correct_negatives(df: DataFrame) -> DataFrame:
    """Negative numbers become 0; missing ones stay missing."""
    changes = {}
    for column in names.numeric_columns(df):
        value = F.col(f"`{column}`")
        zero = F.lit(0).cast(df.schema[column].dataType)
        changes[column] = F.when(value < 0, zero).otherwise(value)
    return _rewrite(df, changes)


def normalise_strings(
    df: DataFrame, exclude: tuple[str, ...] = (), region_columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Trim and title-case every text column; short codes in region columns go to
    upper case. ``exclude`` names columns to leave alone."""

    def region(column: str) -> bool:
        return column in region_columns if region_columns is not None else names.is_region_name(column)

    return _rewrite(
        df,
        {
            c: text.normalise_text(F.col(f"`{c}`"), region(c))
            for c in names.text_columns(df)
            if c not in exclude
        },
    )


def standardise_dates(df: DataFrame, known: Known | None = None) -> DataFrame:
    """Columns with ``date`` in their name become ``yyyy-MM-dd`` text, provided
    every value can be read as a date."""
    named = [f for f in df.schema if names.is_date_name(f.name)]
    textual = [f.name for f in named if names.is_text(f)]
    known = known or known_facts(df, ["all_dates"], textual)
    changes = {
        f.name: F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd")
        for f in named
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    }
    for column in textual:
        if column in known and known[column]["all_dates"]:
            changes[column] = text.to_date(F.col(f"`{column}`")).cast("string")
    return _rewrite(df, changes)


def standardise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*names.unique_snake_case(df.columns))
