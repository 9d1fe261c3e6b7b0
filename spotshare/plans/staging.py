"""Written intermediate tables and size-checked broadcast sides."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

# A side is broadcast only when a count over its written rows proves it within both bounds.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# What a row takes in a broadcast hash table besides its values: key, padding, lengths and slots.
TABLE_ROW_BYTES = 128

# Bytes of hash tables that the plan under construction may still broadcast; None outside ``one_plan``.
_left: ContextVar[int | None] = ContextVar("left", default=None)


@contextmanager
def one_plan(max_bytes: int = MAX_BROADCAST_BYTES) -> Iterator[None]:
    """Sides made inside are joined in one plan, so the driver may hold all at a time: their hash tables together stay within ``max_bytes``."""
    token = _left.set(max_bytes)
    try:
        yield
    finally:
        _left.reset(token)


@dataclass(frozen=True)
class Spread:
    """How the rows of a side are copied over more of the join key, unless they can be broadcast as they are."""

    whole: Column  # aggregate: whether a fact row may meet all rows of its key
    copies: Column  # of a row
    rows: Callable[[DataFrame], DataFrame]


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares for cut lineage, else the warehouse, which tables share anyway."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark)}/spotshare/{kind}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, kind: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a lost executor repeats a read, not the work."""
    folder = new_folder(df.sparkSession, kind)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` in a checkpoint in the shared folder, computed once; unlike a stage that is read back it keeps its partitions."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def _width(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        total = F.lit(8)
        for field in kind.fields:
            total = total + _width(value.getField(field.name), field.dataType)
        return total
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0)) + 16
    return F.lit(kind.defaultSize if hasattr(kind, "defaultSize") else 16)


def _size(df: DataFrame) -> tuple[Column, Column]:
    """Row count and uncompressed byte size as aggregates."""
    width = F.lit(0)
    for field in df.schema.fields:
        width = width + _width(F.col(f"`{field.name}`"), field.dataType)
    return F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes")


def _fits(rows: int, size: int, max_rows: int, max_bytes: int, table: bool) -> bool:
    """Whether a side is within the bounds, by its hash table where ``table`` or in ``one_plan``, which it then takes its bytes from."""
    left = _left.get()
    if table or left is not None:
        size += TABLE_ROW_BYTES * rows
    if rows > max_rows or size > max_bytes or (left is not None and size > left):
        return False
    if left is not None:
        _left.set(left - size)
    return True


def join_side(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES, *, spread: Spread | None = None
) -> DataFrame:
    """A lookup side ready to join: written once, measured while it is written, broadcast only within the bounds.

    Beyond them the side is joined by a shuffle on the join keys, where adaptive execution splits hot partitions
    of the fact; the side itself holds at most one matching row for each fact row. A retried task can only raise the
    measured size, never lower it. With ``spread`` the bounds hold for the hash table, and the rows are spread unless
    they are broadcast whole.
    """
    seen = Observation()
    more = [] if spread is None else [spread.whole.alias("whole"), F.sum(spread.copies).alias("copies")]
    side = write_stage(df.observe(seen, *_size(df), *more), "side")
    size = seen.get
    rows, width = size["rows"], size["bytes"]
    if spread is not None and not size["whole"]:
        copies = size["copies"] or 0
        side, rows, width = spread.rows(side), copies, width * copies // max(rows, 1)
    if _fits(rows, width, max_rows, max_bytes, spread is not None):
        return F.broadcast(side)
    if spread is not None and size["whole"]:
        side = spread.rows(side)
    return side.hint("merge")
