"""Types of text columns: one pass of value tests, then the tightest common type of each column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from spotshare.functions import casts

# Widening order of the numeric types.
NUMERIC = ("int", "bigint", "double")


# Types in test order; a value counts for the first that reads it.
KINDS = (*NUMERIC, "timestamp", "boolean", "string")

# A schema is made on the driver, so its columns are bounded.
MAX_COLUMNS = 10_000


def value_type(text: Column, pattern: str | None = None) -> Column:
    """Position in ``KINDS`` of the type of one value; NULL for blanks."""
    whole = casts.whole_number(text, T.LongType())
    small = whole.between(-(1 << 31), (1 << 31) - 1)
    tests = (
        small,
        whole.isNotNull(),
        text.rlike(casts.DOUBLE_TEXT),
        casts.timestamp(text, pattern).isNotNull(),
        casts.boolean(text).isNotNull(),
    )
    kind = F.when(text.isNull() | (text == ""), F.lit(None))
    for position, test in enumerate(tests):
        kind = kind.when(test, position)
    return kind.otherwise(len(tests))


def _seen(text: Column, pattern: str | None) -> Column:
    """The types seen in a column as bits of one number, which partial aggregation merges before the shuffle."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1), value_type(text, pattern))).alias("seen")


def _common_type(seen: DataFrame) -> DataFrame:
    """Same type, else the widest numeric one, else text; text when there is no value at all."""
    numeric = F.when(F.col("seen") >= 4, "double").when(F.col("seen") >= 2, "bigint").otherwise("int")
    common = (
        F.when(F.col("seen").between(1, 7), numeric).when(F.col("seen") == 8, "timestamp").when(F.col("seen") == 16, "boolean")
    )
    return seen.select("column", common.otherwise("string").alias("type"))


def infer_columns(df: DataFrame, pattern: str | None = None) -> DataFrame:
    """``column, type`` of every (text) column, from one aggregate over the rows as they are."""
    seen = [F.struct(F.lit(c).alias("column"), _seen(F.col(f"`{c}`"), pattern)) for c in df.columns]
    return _common_type(df.agg(F.array(*seen).alias("seen")).select(F.inline("seen")))


def infer_map(df: DataFrame, column: str, pattern: str | None = None) -> DataFrame:
    """``column, type`` of every key of a text map; keys may differ from row to row."""
    values = df.select(F.explode(column).alias("column", "value"))
    return _common_type(values.groupBy("column").agg(_seen(F.col("value"), pattern)))


def union_of_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.explode(F.map_keys(column)).alias("column")).distinct()


def to_schema(types: DataFrame, max_columns: int = MAX_COLUMNS) -> T.StructType:
    """Inferred types (one row for each column) as a schema, columns in name order; more than ``max_columns`` raise."""
    rows = types.limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        raise ValueError(f"more than {max_columns} different keys cannot become columns")
    fields = [T.StructField(row["column"], T.StructType.fromDDL(f"value {row['type']}")["value"].dataType, True) for row in rows]
    return T.StructType(sorted(fields, key=lambda f: f.name))


def apply_schema(
    df: DataFrame,
    schema: T.StructType,
    column: str | None = None,
    pattern: str | None = None,
    encode: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed columns from text columns, or from the keys of text map ``column``.

    A missing value is the empty text, which is NULL for every type but text. Text that does not read as its type is
    NULL. ``encode`` names text columns to URL-encode, ``keep`` columns to pass through.
    """
    present = set(df.columns)

    def raw(name: str) -> Column:
        if column is not None:
            return F.try_element_at(F.col(column), F.lit(name))
        return F.col(f"`{name}`") if name in present else F.lit(None).cast("string")

    def value(field: T.StructField) -> Column:
        text = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            return F.url_encode(text) if field.name in encode else text
        return casts.typed(text, field.dataType, pattern)

    # The texts are a projection of their own, so that each is read once however often its cast looks at it.
    texts = df.select(*keep, *[F.coalesce(raw(f.name), F.lit("")).alias(f.name) for f in schema.fields])
    return texts.select(*keep, *[value(field).alias(field.name) for field in schema.fields])


def url_encode_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.url_encode(F.col(name)) for name in names})
