"""Shards along a Hilbert curve through several metadata dimensions, in DataFrame functions only.

Every row gets a cell: its dimensions, quantised to a few bits each. Cells follow the Hilbert curve, rows follow their cell, and the
order is cut into runs of equal row counts. Neighbours on the curve are neighbours in every dimension, so a shard spans a small
range of each and its file can be skipped by any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotshare.plans.staging import write_stage

SHARDS = 40
BITS = 4  # of each dimension: 65,536 cells with four
SALTS = 64  # parts of a cell, so that a hot cell is numbered by many tasks


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """The place on the Hilbert curve of a cell given by whole numbers from 0 to 2**bits - 1."""
    n = len(axes)
    start = F.array(*(a.cast("long") for a in axes))
    # undo the excess work from the highest bit down: one step for each bit and axis, over an array of the coordinates
    steps = F.array(*(
        F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i + 1).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)))

    def undo(x: Column, step: Column) -> Column:
        own, head, low = F.element_at(x, step["i"]), F.element_at(x, 1), step["q"] - 1
        swap = own.bitwiseXOR(head).bitwiseAND(low)
        is_set = own.bitwiseAND(step["q"]) != 0
        return F.transform(x, lambda v, j: F.when(is_set, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(
            F.when((j == 0) & (step["i"] == 1), v).when((j == 0) | (j == step["i"] - 1), v.bitwiseXOR(swap)).otherwise(v)))

    turned = F.aggregate(steps, start, undo)
    # Gray code: every coordinate takes up the ones before it
    gray = F.aggregate(turned, F.array().cast("array<bigint>"), lambda done, v: F.concat(done, F.array(
        F.when(F.size(done) > 0, v.bitwiseXOR(F.element_at(done, -1))).otherwise(v))))

    def last_fold(x: Column) -> Column:
        fold = F.aggregate(F.array(*(F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1))), F.lit(0).cast("long"),
                           lambda t, q: F.when(F.element_at(x, -1).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        return F.transform(x, lambda v: v.bitwiseXOR(fold))

    folded = F.transform(F.array(gray), last_fold)[0]
    # the bits of all coordinates, highest first
    order = F.array(*(F.struct(F.lit(b).alias("b"), F.lit(i + 1).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)))
    return F.transform(F.array(folded), lambda x: F.aggregate(order, F.lit(0).cast("long"), lambda t, s: t * 2 + F.call_function(
        "shiftright", F.element_at(x, s["i"]), s["b"]).bitwiseAND(F.lit(1).cast("long"))))[0]


def size_of(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + 16).cast("long")


def cells(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, the quantised dimensions (source, lang, size, doc_id) and ``cell`` for every row.

    Names are dealt to their values by hash; sizes by steps of a half on a logarithmic scale; ids evenly from the smallest to the
    largest. NULL is value 0 of its dimension.
    """
    top = (1 << bits) - 1
    ends = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, span = (ends["low"], ends["high"] - ends["low"] + 1) if ends["low"] is not None else (0, 1)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def name(column: str) -> Column:
        return F.when(F.col(column).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(top)) + 1)

    rows = docs.select("doc_id", size_of().alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "source", "lang")
    place = (F.col("doc_id") - F.lit(low)).cast("decimal(20,0)") * (top + 1) / F.lit(span).cast("decimal(20,0)")
    rows = rows.select(
        "doc_id", "size", "text_crc32", name("source").alias("d_source"), name("lang").alias("d_lang"),
        F.least(F.floor(F.log2(F.col("size") / 16) * 1.25), F.lit(top)).cast("long").alias("d_size"),
        F.coalesce(F.least(F.floor(place).cast("long"), F.lit(top)), F.lit(0)).cast("long").alias("d_id"),
    )
    return rows.withColumn("cell", hilbert_index([F.col("d_source"), F.col("d_lang"), F.col("d_size"), F.col("d_id")], bits))


def assign(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, salts: int = SALTS) -> DataFrame:
    """``cells`` with ``shard`` and ``slot`` (gapless from 0 in each shard): row counts of shards differ by one at most.

    Every row is placed, repeated rows and NULL ids too. In a cell, rows follow a salt of their text and id (equal rows are
    neighbours), so the order is the same in every run. With fewer rows than shards some shards are empty.
    """
    if shards < 1:
        raise ValueError("shards: at least one")
    rows = cells(docs, bits).withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(salts)).cast("int"))
    rows = write_stage(rows, "cells")
    # how many rows stand before a part: parts within their cell, then at most 2**(4*bits) cells by one running sum
    parts = rows.groupBy("cell", "salt").agg(F.count(F.lit(1)).alias("n"))
    parts = write_stage(parts.withColumn("inside", F.sum("n").over(Window.partitionBy("cell").orderBy("salt")) - F.col("n")), "parts")
    heads = parts.groupBy("cell").agg(F.sum("n").alias("n"))
    heads = heads.select("cell", (F.sum("n").over(Window.orderBy("cell")) - F.col("n")).alias("before"))
    offsets = parts.join(heads, "cell").select("cell", "salt", (F.col("before") + F.col("inside")).alias("before"))
    total = rows.count()
    own = Window.partitionBy("cell", "salt").orderBy("text_crc32", "doc_id", "size")
    ranked = rows.withColumn("nth", F.row_number().over(own) - 1).join(offsets, ["cell", "salt"])
    rank = (F.col("before") + F.col("nth")).cast("decimal(19,0)")
    ranked = ranked.withColumn("rank", rank).withColumn("shard", F.floor(F.col("rank") * shards / F.lit(total).cast("decimal(19,0)")).cast("int"))
    first = F.ceil(F.col("shard").cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)") / shards).cast("long")
    return ranked.withColumn("slot", F.col("rank").cast("long") - first).drop("rank", "before", "nth", "salt")


def manifest(assigned: DataFrame) -> DataFrame:
    """For each shard its rows, bytes and the range of every dimension: what a reader prunes files by."""
    dims = ("d_source", "d_lang", "d_size", "d_id")
    return assigned.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"),
        *(f(d).alias(f"{d}_{n}") for d in dims for f, n in ((F.min, "min"), (F.max, "max"))),
    )


def placement(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The shard of every row, by the law of equal row counts."""
    return assign(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
