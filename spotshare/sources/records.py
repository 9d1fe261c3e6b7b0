"""Record pages, nested records and CSV result batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from spotshare.operators.infer import apply_schema, infer_columns, to_schema

# Where the record list sits in a page: a plain page and a page with a result wrapper.
PLAIN = "records"
WRAPPED = "results.records"

# Member that every record carries for bookkeeping; it is not data.
BOOKKEEPING = "attributes"

DONE_STATE = "Completed"


def read_pages(
    spark: SparkSession, path: str, field: str = PLAIN, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """One row for each record of all pages, primitives as text.

    A page is one JSON line, or one file with ``multi_line``. Without the page ``schema`` Spark scans the pages once
    more to find the union of the record members. A page that does not parse fails the query. Where pages state
    ``totalSize`` or ``done`` beside their records, the query also fails unless all records and the last page are there.
    """
    reader = spark.read.options(primitivesAsString=True, multiLine=multi_line, mode="FAILFAST")
    page = (reader.schema(schema) if schema is not None else reader).json(path)
    complete = _complete(page, field)
    if complete is not None:
        page = page.where(F.when(complete, True).otherwise(F.raise_error(F.lit(f"pages below {path} are incomplete")).cast("boolean")))
    return page.select(F.explode(field).alias("record")).select("record.*")


def _complete(page: DataFrame, field: str) -> Column | None:
    """Whether the pages hold what their envelope states, NULL members aside; None if it states nothing."""
    holder, _, _ = field.rpartition(".")
    members = page.select(f"{holder}.*").columns if holder and isinstance(page.schema[holder].dataType, T.StructType) else (
        [] if holder else page.columns)
    prefix = f"{holder}." if holder else ""
    tests = []
    if "totalSize" in members:
        total = F.max(F.col(f"{prefix}totalSize").cast("bigint"))
        tests.append(F.coalesce(F.sum(F.coalesce(F.size(field), F.lit(0))) == total, total.isNull()))
    if "done" in members:
        last = F.bool_or(F.col(f"{prefix}done").cast("boolean"))
        tests.append(F.coalesce(last, F.lit(True)))
    if not tests:
        return None
    both = tests[0] if len(tests) == 1 else tests[0] & tests[1]
    return page.agg(both.alias("complete")).scalar()


def _leaves(kind: T.StructType, path: tuple[str, ...], value: Column | None) -> list[tuple[str, Column]]:
    leaves = []
    for member in kind.fields:
        if member.name == BOOKKEEPING:
            continue
        inner = F.col(f"`{member.name}`") if value is None else value.getField(member.name)
        name = (*path, member.name)
        if isinstance(member.dataType, T.StructType):
            leaves += _leaves(member.dataType, name, inner)
        else:
            leaves.append((".".join(name), inner.cast("string")))
    return leaves


def flatten(records: DataFrame) -> DataFrame:
    """Nested members as ``parent.child`` text columns; NULL stays NULL."""
    return records.select(*[value.alias(name) for name, value in _leaves(records.schema, (), None)])


def read_csv_batches(
    spark: SparkSession, path: str, batches: DataFrame, schema: T.StructType | None = None, infer: bool = False
) -> DataFrame:
    """Rows of the completed batches below ``path`` (folders ``batch_id=<id>``, a header in each file).

    ``batches`` holds ``batch_id, state``, a row for each batch of one job; only the folders of completed ones are opened, also to
    infer types. Every file's header must name the columns in their order, else the query fails. Quoted values may span
    lines; a line break inside a value becomes a space. Without a completed batch the result is empty.
    """
    done = batches.where(F.col("state") == DONE_STATE).select(F.col("batch_id").cast("string")).distinct()
    folders = [f"{path}/batch_id={row[0]}" for row in done.orderBy("batch_id").toLocalIterator()]
    if not folders:
        fields = [] if schema is None else [f for f in schema.fields if f.name != "batch_id"]
        return spark.createDataFrame([], T.StructType([*fields, T.StructField("batch_id", batches.schema["batch_id"].dataType)]))
    reader = spark.read.options(
        header=True, multiLine=True, quote='"', escape='"', inferSchema=infer, mode="FAILFAST", basePath=path, enforceSchema=False
    )
    rows = (reader.schema(schema) if schema is not None else reader).csv(folders)
    kept = rows
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType) and f.name != "batch_id"]
    return kept.withColumns({c: F.regexp_replace(F.col(f"`{c}`"), r"\r\n|\r|\n", " ") for c in texts})


def typed_records(
    records: DataFrame,
    schema: T.StructType | None = None,
    infer: bool = False,
    pattern: str | None = None,
    encode: list[str] | None = None,
) -> DataFrame:
    """Flat text records under a given schema, an inferred one, or as text."""
    if schema is None:
        text = T.StructType([T.StructField(c, T.StringType(), True) for c in records.columns])
        schema = to_schema(infer_columns(records, pattern)) if infer else text
    return apply_schema(records, schema, pattern=pattern, encode=encode or ())
