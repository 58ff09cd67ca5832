"""Writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.functions.numbers import finite


def store(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a table as a folder of files, one per task; returns the path."""
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        # padding is data: keep it
        writer.options(
            header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
        ).csv(path)
    else:
        raise ValueError(f"unsupported table format: {fmt}")
    return path


def json_safe(df: DataFrame) -> DataFrame:
    """Values JSON can hold: NaN and infinities become NULL, types JSON does not
    know become text."""
    plain = (T.StringType, T.BooleanType, T.IntegralType, T.ArrayType, T.MapType, T.StructType)

    def safe(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return finite(value).alias(field.name)
        if isinstance(field.dataType, plain):
            return value
        return value.cast("string").alias(field.name)

    return df.select(*[safe(f) for f in df.schema])
