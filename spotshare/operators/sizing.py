"""Encoded table size and size-bounded partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from spotshare.functions.csvtext import csv_row
from spotshare.plans.staging import checkpointed

MAX_BUNDLE_BYTES = 10 * 1024 * 1024


def _sizes(df: DataFrame) -> tuple[Column, Column]:
    bytes_ = F.sum(F.octet_length(csv_row(df)).cast("bigint"))
    return F.count(F.lit(1)).alias("n_rows"), F.coalesce(bytes_, F.lit(0)).alias("n_bytes")


def table_size(df: DataFrame) -> DataFrame:
    """Exact row count and CSV bytes in one pass."""
    return df.agg(*_sizes(df))


def bundle_count(size: int, max_bytes: int = MAX_BUNDLE_BYTES) -> int:
    return 1 if size <= max_bytes else size // max_bytes + 1


def size_repartition(df: DataFrame, max_bytes: int = MAX_BUNDLE_BYTES) -> DataFrame:
    """Partitions of about ``max_bytes`` of CSV text each.

    ``df`` is computed once, into a checkpoint that is measured while it is written and keeps the partitions. Fewer partitions are
    neighbours put together, without a shuffle; only more of them are dealt anew.
    """
    seen = Observation()
    held = checkpointed(df.observe(seen, *_sizes(df)))
    n = bundle_count(seen.get["n_bytes"], max_bytes)
    return held.coalesce(n) if n <= held.rdd.getNumPartitions() else held.repartition(n)
