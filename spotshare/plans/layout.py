"""A sorted layout of a table, made once, of which any limit/offset page opens only the one or two files that hold it."""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from spotshare.operators.paging import total_order
from spotshare.sources import files

_SHIFT = 33


def lay_out(df: DataFrame, order_by: Sequence[str | Column], path: str) -> None:
    """Sorts ``df`` by range into ``path/part=<number>`` and notes how many rows each part has; does nothing if that is noted.

    Equal keys are ordered by a hash of the whole row, so that a hot key is spread over parts. A layout that failed before its
    note is made anew.
    """
    spark = df.sparkSession
    if files.exists(spark, f"{path}/_parts"):
        return
    if {"part", "nth"} & {c.lower() for c in df.columns}:
        raise ValueError("the columns part and nth name places in the layout")
    local = F.monotonically_increasing_id()
    placed = df.orderBy(*total_order(df, order_by)).withColumn("nth", local.bitwiseAND((1 << _SHIFT) - 1)).withColumn("part", F.spark_partition_id())
    placed.write.mode("overwrite").partitionBy("part").parquet(path)
    # a row for each part, of which a sort makes at most spark.sql.shuffle.partitions
    counts = _read(spark, path, df.schema).groupBy("part").count().collect()
    note = {"schema": df.schema.jsonValue(), "rows": {str(r["part"]): r["count"] for r in counts}}
    files.put_text(spark, f"{path}/_parts", json.dumps(note))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    placed = T.StructType([*schema.fields, T.StructField("nth", T.LongType()), T.StructField("part", T.IntegerType())])
    return spark.read.schema(placed).parquet(path) if files.listed(spark, path) else spark.createDataFrame([], placed)


def page(spark: SparkSession, path: str, limit: int, offset: int) -> DataFrame:
    """The rows of one page with their ``position`` from 0; in no order. Only parts that hold some of them are opened."""
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")
    text = files.text_of(spark, f"{path}/_parts")
    if text is None:
        raise ValueError(f"no layout below {path}")
    note = json.loads(text)
    parts = sorted((int(part), rows) for part, rows in note["rows"].items())
    starts = [0, *accumulate(rows for _, rows in parts)]
    inside, position = F.lit(False), F.lit(None).cast("long")
    first = max(0, bisect_right(starts, offset) - 1)
    for (part, rows), start in list(zip(parts, starts))[first:]:
        if start >= offset + limit:
            break
        low, high = max(0, offset - start), min(rows, offset + limit - start)
        if low < high:
            inside = inside | ((F.col("part") == part) & (F.col("nth") >= low) & (F.col("nth") < high))
            position = F.when(F.col("part") == part, F.col("nth") + start).otherwise(position)
    rows = _read(spark, path, T.StructType.fromJson(note["schema"])).where(inside)
    return rows.withColumn("position", position).drop("part", "nth")
