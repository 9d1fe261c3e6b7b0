"""CSV text of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def csv_value(value: Column, kind: T.DataType) -> Column:
    """NULL is empty, quotes are doubled, a value with a quote, newline or comma is quoted."""
    text = value.cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".0")))
    if isinstance(kind, T.StringType):
        marks = reduce(lambda a, b: a | b, [text.contains(mark) for mark in ('"', "\n", ",")])
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        text = F.when(marks, quoted).otherwise(text)
    return F.coalesce(text, F.lit(""))


def csv_row(df: DataFrame) -> Column:
    values = [csv_value(F.col(f"`{field.name}`"), field.dataType) for field in df.schema.fields]
    return F.concat_ws(",", *values)


def csv_header(df: DataFrame) -> str:
    return ",".join(df.columns)
