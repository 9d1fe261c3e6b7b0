"""Limit/offset pages and key-range chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotshare.plans.staging import write_stage

_SHIFT = 33
# A page that ends within so many rows of the start is read by a top-k, which writes nothing.
SHALLOW_ROWS = 10_000


def total_order(df: DataFrame, order_by: Sequence[str | Column]) -> list[str | Column]:
    return [*order_by, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]


def positioned(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Add 0-based ``position`` in the given total order.

    The sorted rows are written once with their partition-local positions; the offset of each partition comes from
    the partition counts. No task sees more than its own range of keys; rows with equal keys are ranged by a hash of
    the whole row, so that a hot key is spread as well.
    """
    staged = write_stage(df.orderBy(*total_order(df, order_by)).withColumn("__id", F.monotonically_increasing_id()), "sorted")
    part = F.shiftrightunsigned("__id", _SHIFT)
    counts = staged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    # One row for each written partition, of which a sort makes at most spark.sql.shuffle.partitions: 16 bytes each.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    joined = staged.join(F.broadcast(starts), part == F.col("__part"))
    local = F.col("__id").bitwiseAND((1 << _SHIFT) - 1)
    return joined.withColumn("position", F.col("__start") + local).drop("__id", "__part", "__start")


def pages(df: DataFrame, order_by: Sequence[str | Column], page_size: int) -> DataFrame:
    """Every page at once: ``position``, ``page`` (0-based) and ``last_page`` for the page that ends the read.

    A page shorter than ``page_size`` ends the read, as does a full page with nothing behind it.
    """
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    rows = positioned(df, order_by)
    last = F.call_function("div", rows.agg(F.max("position")).scalar(), F.lit(page_size))
    number = F.call_function("div", F.col("position"), F.lit(page_size))
    return rows.withColumn("page", number).withColumn("last_page", number == last)


def page(df: DataFrame, order_by: Sequence[str | Column], limit: int, offset: int) -> DataFrame:
    """One page, in no order; the same rows by either way.

    A shallow page is a top-k. For a deep one all rows are ranged and written once, then the page's rows are read by position.
    """
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")
    if limit + offset <= SHALLOW_ROWS:
        return df.orderBy(*total_order(df, order_by)).offset(offset).limit(limit)
    inside = (F.col("position") >= offset) & (F.col("position") < offset + limit)
    return positioned(df, order_by).where(inside).drop("position")


def key_chunks(df: DataFrame, key: str, chunk_size: int) -> DataFrame:
    """Add ``chunk_id``: consecutive key ranges of ``chunk_size`` keys from the smallest key on."""
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    first = df.agg(F.min(key)).scalar()
    return df.withColumn("chunk_id", F.call_function("div", F.col(key) - first, F.lit(chunk_size)))


def chunk_ranges(df: DataFrame, key: str, chunk_size: int) -> DataFrame:
    """Key range and row count of every chunk."""
    chunks = key_chunks(df, key, chunk_size).groupBy("chunk_id")
    return chunks.agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count(F.lit(1)).alias("n_rows"))
