"""Reading tables: typed CSV, JSON, parquet, and the guards around them."""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidyspark.functions import text
from tidyspark.operators.facts import FIELD_LIMIT
from tidyspark.session import scratch_path
from tidyspark.sources import records

# ---- fixed values ---------------------------------------------------------
# What a delimited file's values may look like, padding included.
_PAD = f"[{text.WHITESPACE_CLASS}]*"
INTEGER_VALUE = rf"^{_PAD}[+-]?[0-9]+{_PAD}$"
NUMBER_VALUE = rf"^{_PAD}[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?{_PAD}$"
BOOLEAN_VALUE = rf"(?i)^{_PAD}(true|false){_PAD}$"
# ---------------------------------------------------------------------------

# Aggregation buffers per column; groups of columns stay within generated code.
_TYPE_CHECKS = 4
_GROUP = FIELD_LIMIT // _TYPE_CHECKS


def _type_checks(column: str) -> Column:
    """Aggregate: do all values look like numbers, integers, booleans; is one an
    integer too long for a long (which a double would not hold exactly)."""
    value = F.col(f"`{column}`")
    number = F.rlike(value, F.lit(NUMBER_VALUE))
    integer = number & F.rlike(value, F.lit(INTEGER_VALUE))
    too_long = integer & (F.length(value) > 18) & text.strip(value).try_cast("bigint").isNull()
    return F.struct(
        F.bool_and(number).alias("numbers"),
        F.bool_and(integer).alias("integers"),
        F.bool_and(F.rlike(value, F.lit(BOOLEAN_VALUE))).alias("booleans"),
        F.coalesce(F.bool_or(too_long), F.lit(False)).alias("too_long"),
    )


def _typed(column: str, fits: Row) -> Column:
    value = F.col(f"`{column}`")
    if fits["integers"] and not fits["too_long"]:
        return text.strip(value).cast("bigint")
    if fits["numbers"] and not fits["too_long"]:
        return text.strip(value).cast("double")
    if fits["booleans"]:
        return F.lower(text.strip(value)) == "true"
    return value


def promote_types(df: DataFrame) -> DataFrame:
    """Give text columns the narrowest of long, double, boolean, text that takes
    every value. All values are looked at; nothing is guessed from a sample."""
    typed = []
    for start in range(0, len(df.columns), _GROUP):
        group = df.columns[start : start + _GROUP]
        row = df.agg(*[_type_checks(c).alias(f"c{i}") for i, c in enumerate(group)]).first()
        typed += [_typed(c, row[i]).alias(c) for i, c in enumerate(group)]
    return df.select(*typed)


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted value runs over a line end: some line has an odd number of quotes."""
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def read_csv(spark: SparkSession, path: str, multi_line: bool | None = None, **options: str) -> DataFrame:
    """CSV with a header. Missing-value words become NULL and types are promoted;
    date text stays text.

    Files are split over tasks. Where a quoted value holds a line break, records are put together from
    lines of all blocks (``records``). Pass ``multi_line`` to skip that check: if true, each
    file is read whole by one task.
    """
    if multi_line is None and has_broken_lines(spark, path):
        raw = records.read_broken_csv(spark, path, **options)
    else:
        settings = {"header": "true", "escape": '"', "multiLine": str(bool(multi_line)).lower(), **options}
        raw = spark.read.options(**settings).csv(path)
    words = list(text.MISSING_WORDS)
    blanked = raw.select(*[F.when(~F.col(f"`{c}`").isin(words), F.col(f"`{c}`")).alias(c) for c in raw.columns])
    return promote_types(blanked)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON records, one per line or as one array, decided for each file of a folder.

    Both kinds are split over tasks: lines by their ends, arrays by the braces that end their records
    (``records``), which are first written down line by line. Broken records are an error. Columns
    that only some records have are missing in the others.
    """
    pieces = records.pieces_in_order(spark, path).withColumn("mark", F.regexp_extract("value", r"^\s*(\S)", 1))
    opening = pieces.filter("mark <> ''").groupBy("file").agg(F.min_by("mark", F.struct("block", "piece")).alias("mark"))
    files: dict[bool, list[str]] = {True: [], False: []}
    for row in opening.collect():  # a row per file, as the listing of the folder itself
        files[row["mark"] == "["].append(unquote(row["file"]))
    paths: str | list[str] = path
    if files[True]:
        lines = scratch_path(spark, "records")
        records.array_records(spark, files[True]).select("record").write.text(lines)
        paths = [*files[False], lines]
    return spark.read.option("mode", "FAILFAST").json(paths)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Pick the reader by extension; unknown extensions are refused."""
    readers = {
        ".csv": read_csv,
        ".json": read_json,
        ".parquet": lambda s, p: s.read.parquet(p),
    }
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension not in readers:
        raise ValueError(f"unsupported table format: {extension or path}")
    return readers[extension](spark, path)


def require_rows(df: DataFrame) -> DataFrame:
    """The table itself, or an error when it has no rows."""
    if df.isEmpty():
        raise ValueError("the table contains no data rows")
    return df


def preview(df: DataFrame, order_by: list[str], rows: int = 8) -> DataFrame:
    """The first rows as text, missing values as empty text."""
    top = df.orderBy(*[F.col(f"`{c}`") for c in order_by]).limit(rows)
    return top.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def column_list(df: DataFrame) -> DataFrame:
    """``ordinal, column_name`` of a table, from its schema alone."""
    pairs = list(enumerate(df.columns, start=1))
    return df.sparkSession.createDataFrame(pairs, "ordinal int, column_name string")
