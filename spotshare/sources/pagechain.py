"""Pages that name their successor: their order by pointer jumping, and the records in that order.

A page has its own address and that of the next one, like the elements of a linked list. In every round each page learns the
page twice as far ahead, so a chain of n pages is ranked in about log2(n) joins of a table of one narrow row for each page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from spotshare.plans.staging import join_side, write_stage
from spotshare.sources.records import PLAIN

URL, NEXT = "url", "nextRecordsUrl"  # members of a page: its address, and that of its successor
_NAMED = 5  # addresses that a message names


class BrokenChain(ValueError):
    """Pages that are no single chain."""


def _refuse(found: DataFrame, what: str) -> None:
    named = [row[0] for row in found.orderBy(found.columns[0]).limit(_NAMED).collect()]
    if named:
        raise BrokenChain(f"{what}: {', '.join(map(str, named))}")


def ranked(links: DataFrame) -> DataFrame:
    """``url`` and ``page``, its number from 0, for the pages of ``links`` (``url``, ``next``, NULL behind the last page).

    Raises ``BrokenChain`` by name if an address occurs twice or is NULL, two pages have one successor, a successor is lost, there is
    more than one first page, or pages run in a circle. No pages give no rows.
    """
    links = write_stage(links.select("url", "next"), "links")
    _refuse(links.where("url IS NULL").select(F.lit("NULL").alias("url")), "pages without an address")
    _refuse(links.groupBy("url").count().where("count > 1").select("url"), "pages that are there twice")
    known = links.where("next IS NOT NULL")
    _refuse(known.groupBy("next").count().where("count > 1").select("next"), "pages that follow two others")
    _refuse(known.join(links.select(F.col("url").alias("next")), "next", "left_anti").select("next"), "pages that are lost")
    # as all successors are there and differ, what is left are chains and circles; each chain has a first page
    first = links.join(known.select(F.col("next").alias("url")), "url", "left_anti").select("url")
    starts = [row[0] for row in first.orderBy("url").limit(_NAMED).collect()]
    if len(starts) > 1:
        raise BrokenChain(f"chains that begin at several pages: {', '.join(starts)}")
    n = links.count()
    jumps = links.withColumn("ahead", F.col("next").isNotNull().cast("long"))
    for _ in range(n.bit_length()):
        if jumps.where("next IS NOT NULL").isEmpty():
            break
        far = jumps.select(F.col("url").alias("next"), F.col("next").alias("far"), F.col("ahead").alias("more"))
        jumps = write_stage(jumps.join(far.hint("merge"), "next", "left").select(
            "url", F.col("far").alias("next"), (F.col("ahead") + F.coalesce("more", F.lit(0))).alias("ahead")), "jumps")
    _refuse(jumps.where("next IS NOT NULL").select("url"), "pages that run in a circle")
    return jumps.select("url", (F.lit(n - 1) - F.col("ahead")).alias("page"))


def read_chain(spark: SparkSession, path: str, records: T.StructType, multi_line: bool = False) -> DataFrame:
    """The records of all pages below ``path``, as text, with ``page`` and ``place`` of each in it, both from 0.

    A page is one JSON line, or one file with ``multi_line``, with the members ``url``, ``nextRecordsUrl`` (NULL or none on the last one),
    ``totalSize`` and ``records``. Pages are scanned once for their links and once for their records, never for their members.
    Raises ``BrokenChain`` also if the pages hold other than ``totalSize`` records.
    """
    text = T.StringType()
    schema = T.StructType([T.StructField(URL, text), T.StructField(NEXT, text), T.StructField("totalSize", T.LongType()),
                           T.StructField(PLAIN, T.ArrayType(records))])
    pages = spark.read.schema(schema).options(multiLine=multi_line, mode="FAILFAST", primitivesAsString=True).json(path)
    held = F.coalesce(F.size(PLAIN), F.lit(0)).cast("long")
    links = write_stage(pages.select(F.col(URL).alias("url"), F.col(NEXT).alias("next"), held.alias("held"), F.col("totalSize").alias("total")), "links")
    order = ranked(links)
    wrong = links.agg(F.sum("held").alias("held"), F.max("total").alias("most"), F.min("total").alias("least")).first()
    if wrong["most"] is not None and not wrong["held"] == wrong["most"] == wrong["least"]:
        raise BrokenChain(f"the pages below {path} hold {wrong['held']} records and state {wrong['least']} to {wrong['most']}")
    placed = pages.select(F.col(URL).alias("__url"), F.posexplode(PLAIN).alias("place", "record"))
    return placed.join(join_side(order), F.col("__url") == F.col("url")).select("page", "place", "record.*")
