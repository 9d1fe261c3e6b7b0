"""Extraction of a table in key chunks of equal depth, each by a job of its own that can be repeated.

The chunks are key ranges between quantiles of a mergeable sketch, which one pass makes. A key that alone fills several chunks is
cut further by a hash of its rows. Each chunk is read by a plain range filter, which reaches the scan, and written to its own
folder; an extraction that was interrupted goes on with the chunks that are not there yet, by the plan it was begun with.
"""

from __future__ import annotations

import json
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from spotshare.sources import files

MAX_CHUNKS = 10_000  # of a plan, which the driver holds
SKETCH = 8192  # the sketch's k: ranks are right within some hundredths of a percent of all rows
_LEAST, _GREATEST = -(1 << 63), (1 << 63) - 1
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Chunk:
    """Keys from ``low`` (None: the least) to ``last`` (None: the greatest), or no key; part ``part`` of ``parts`` by row hash."""

    low: int | None
    last: int | None
    part: int = 0
    parts: int = 1
    no_key: bool = False


def _ranges(cuts: list[int], hot: dict[int, int]) -> list[Chunk]:
    """Chunks between quantiles; ``hot`` are keys by the number of chunks that each of them fills alone."""
    chunks, low = [], None
    for cut in sorted(set(cuts)):
        if cut > _LEAST:
            chunks.append(Chunk(low, cut - 1))
        low = cut
        if cut in hot:
            chunks += [Chunk(cut, cut, part, hot[cut]) for part in range(hot[cut])]
            low = cut + 1
    return chunks if low is not None and low > _GREATEST else [*chunks, Chunk(low, None)]


def plan(df: DataFrame, key: str, rows: int) -> list[Chunk]:
    """Chunks of about ``rows`` rows by the integer column ``key``; together they hold every row once.

    One pass counts the rows and sketches the keys; keys that fill several chunks are counted in another one. Rows without a key are chunks of their own, cut by row hash. Equal rows
    stay in one chunk, however many they are.
    """
    if rows <= 0:
        raise ValueError("chunks must hold rows")
    if not isinstance(df.schema[key].dataType, _INTEGERS):
        raise ValueError(f"{key} is no integer column")
    value = F.col(f"`{key}`").cast("long")
    seen = df.agg(
        F.count(value).alias("held"), F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint(value, F.lit(SKETCH)).alias("sketch"))
    row = seen.first()
    held, missing = row["held"], row["n"] - row["held"]
    n, without = max(1, round(held / rows)), max(1, round(missing / rows)) if missing else 0
    if n + without > MAX_CHUNKS:
        raise ValueError(f"{n + without} chunks are more than {MAX_CHUNKS}")
    chunks = []
    if held:
        cuts = []
        if n > 1:
            one = df.sparkSession.createDataFrame([(bytearray(row["sketch"]),)], "sketch binary")
            ranks = F.array(*(F.lit(i / n) for i in range(1, n)))
            cuts = one.select(F.kll_sketch_get_quantile_bigint("sketch", ranks)).first()[0]
        # a key that is the quantile at several places is counted, to cut it into so many parts
        often = [cut for cut, times in Counter(cuts).items() if times > 1]
        counts = df.where(F.col(f"`{key}`").isin(often)).groupBy(value.alias("key")).count().collect() if often else []
        chunks = _ranges(list(cuts), {r["key"]: max(1, round(r["count"] / rows)) for r in counts})
    return chunks + [Chunk(None, None, part, without, True) for part in range(without)]


def rows_of(df: DataFrame, key: str, chunk: Chunk) -> DataFrame:
    """The rows of a chunk; the range is a filter on the column itself, so row groups and partitions outside it are skipped."""
    column = F.col(f"`{key}`")
    if chunk.no_key:
        found = df.where(column.isNull())
    else:
        test = column.isNotNull()
        if chunk.low is not None:
            test = test & (column >= F.lit(chunk.low))
        if chunk.last is not None:
            test = test & (column <= F.lit(chunk.last))
        found = df.where(test)
    if chunk.parts > 1:
        found = found.where(F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.lit(chunk.parts)) == chunk.part)
    return found


def extract(df: DataFrame, key: str, rows: int, path: str, at_once: int = 4) -> list[Chunk]:
    """Writes every chunk of ``df`` as Parquet to ``path/chunk_id=<number>``, ``at_once`` at a time, and returns the chunks.

    What is there from an earlier call is not written again; the plan of that call is kept, so ``df`` must be the same.
    """
    spark = df.sparkSession
    stated = files.text_of(spark, f"{path}/_plan")
    if stated is None:
        chunks = plan(df, key, rows)
        files.put_text(spark, f"{path}/_plan", json.dumps({"key": key, "rows": rows, "chunks": [asdict(c) for c in chunks]}))
    else:
        known = json.loads(stated)
        if (known["key"], known["rows"]) != (key, rows):
            raise ValueError(f"the extraction below {path} was begun with key {known['key']} and {known['rows']} rows a chunk")
        chunks = [Chunk(**c) for c in known["chunks"]]

    def write(number: int) -> None:
        folder = f"{path}/chunk_id={number}"
        if not files.exists(spark, f"{folder}/_SUCCESS"):
            rows_of(df, key, chunks[number]).write.mode("overwrite").parquet(folder)

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(write, range(len(chunks))))
    return chunks


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a finished extraction with their ``chunk_id``; fails while a chunk is missing."""
    stated = files.text_of(spark, f"{path}/_plan")
    chunks = json.loads(stated)["chunks"] if stated is not None else None
    if chunks is None or not all(files.exists(spark, f"{path}/chunk_id={i}/_SUCCESS") for i in range(len(chunks))):
        raise ValueError(f"the extraction below {path} is not finished")
    whole = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema.fields), T.StructField("chunk_id", T.IntegerType())])
    return spark.read.schema(whole).parquet(path) if chunks else spark.createDataFrame([], whole)
