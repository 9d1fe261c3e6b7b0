"""Text to typed values, NULL for text that does not read as the type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Text forms accepted for each type.
INTEGER_TEXT = r"^[+-]?[0-9]+$"
CODE_TEXT = r"^([+-]?[0-9]+)(\.[0-9]*)?$"
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DOUBLE_TEXT = r"^[ ]*([+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?|Infinity|NaN))[ ]*$"
TIMESTAMP_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,9})?$"
DATE_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"

# A failing try_cast costs an exception, so text is tested by pattern and by range before it is cast.
_RANGES = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}
_SAFE_LENGTH = 18


def _in_range(digits: Column, kind: str) -> Column:
    """Digits (with sign) as ``kind``; empty text and numbers out of range are NULL."""
    number = digits.cast("bigint")
    if kind != "bigint":
        limit = 1 << _RANGES[kind]
        number = F.when(number.between(-limit, limit - 1), number.cast(kind))
    long = F.when(F.length(digits) > _SAFE_LENGTH, digits.try_cast(kind))
    return F.when(F.length(digits).between(1, _SAFE_LENGTH), number).otherwise(long)


def code(text: Column, kind: str = "int") -> Column:
    """Whole part of a decimal text as a code: "12" and "12.0" are 12, "" and "n/a" are NULL."""
    return _in_range(F.regexp_extract(text, CODE_TEXT, 1), kind)


def whole_number(text: Column, kind: T.DataType) -> Column:
    return F.when(text.rlike(INTEGER_TEXT), _in_range(text, kind.simpleString()))


def double(text: Column, kind: T.DataType = T.DoubleType()) -> Column:
    number = F.regexp_replace(F.trim(text), "[fFdD]$", "")
    return F.when(text.rlike(DOUBLE_TEXT), number.try_cast(kind))


def boolean(text: Column) -> Column:
    return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)


def timestamp(text: Column, pattern: str | None = None) -> Column:
    if pattern:
        return F.try_to_timestamp(text, F.lit(pattern))
    return F.when(text.rlike(TIMESTAMP_TEXT), text.try_cast("timestamp"))


def typed(text: Column, kind: T.DataType, pattern: str | None = None) -> Column:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return whole_number(text, kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return double(text, kind)
    if isinstance(kind, T.BooleanType):
        return boolean(text)
    if isinstance(kind, T.DecimalType):
        plain = F.replace(text, F.lit(","), F.lit(""))
        return F.when(plain.rlike(DECIMAL_TEXT), plain.try_cast(kind))
    if isinstance(kind, T.TimestampType):
        return timestamp(text, pattern)
    if isinstance(kind, T.DateType):
        return F.when(text.rlike(DATE_TEXT), text.try_cast(kind))
    if isinstance(kind, T.StringType):
        return text
    raise ValueError(f"unsupported data type: {kind.simpleString()}")
