"""Last-match lookups in dated dimension rows, with at most one joined row for each fact row.

A dimension row holds for the days strictly inside its validity interval, and rows may overlap. ``resolve`` turns the
rows of each key into disjoint day segments that carry the last valid row, so the fact side needs one hash join and
no regrouping. Its cost grows linearly with the dimension: a row is covered by at most two blocks of each power of two
days, blocks are pre-aggregated, and a segment start looks up one block of each size. No pair of rows is formed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pyspark.sql import Column, DataFrame, Window, functions as F

from spotshare.functions.temporal import moment
from spotshare.plans.staging import Spread, join_side

VALIDITY = ("fecha_ini", "fecha_fin")
# Segments are cut at multiples of this many days, a power of two. It bounds the segments a fact row probes and adds a time component
# to the join key, which spreads a hot key over partitions.
BUCKET_DAYS = 512
# Where no key has more segments, a fact row may probe all of its key: a broadcast side then holds each segment once, without buckets.
WHOLE_SEGMENTS = 64
# With more blocks than this they are joined by a shuffle: the planner judges exploded rows by the file they come from, and would broadcast millions.
MAX_PLANNED_BLOCKS = 100_000


def row_order(dim: DataFrame, order_by: Sequence[str] | None) -> list[str]:
    """Columns that make "last" reproducible: given, else ``ord``, else every column."""
    if order_by:
        return list(order_by)
    return ["ord"] if "ord" in dim.columns else sorted(dim.columns)


def _winner(order: Sequence[str], values: Mapping[str, Column]) -> Column:
    ranked = F.struct(*[F.col(c) for c in order])
    kept = F.struct(*[value.alias(name) for name, value in values.items()])
    return F.struct(ranked.alias("o"), kept.alias("v"))


def _days(dim: DataFrame, valid: tuple[str, str]) -> tuple[int, int, int]:
    """The first day on which a row of ``dim`` can hold, as days since 1970, how many follow up to the last one, and the number of rows."""
    ends = dim.agg(
        F.min(F.unix_date(F.to_date(_bound(dim, valid[0])))).alias("first"), F.max(F.unix_date(F.to_date(_bound(dim, valid[1])))).alias("last"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    if ends["first"] is None:
        return 0, 0, 0
    return ends["first"], max(0, ends["last"] - ends["first"]), ends["rows"]


def _bound(dim: DataFrame, name: str) -> Column:
    at = moment(dim, name)
    return F.coalesce(at, F.raise_error(F.lit(f"validity bound {name} must not be null")))


def resolve(
    dim: DataFrame,
    keys: Mapping[str, Column],
    values: Mapping[str, Column],
    order_by: Sequence[str] | None = None,
    valid: tuple[str, str] = VALIDITY,
) -> DataFrame:
    """Disjoint segments ``keys, __bucket, __first, __until, __w``; ``__w.v`` holds the values of the last valid row."""
    return _over_buckets(_segments(dim, keys, values, order_by, valid))


def dated_side(
    dim: DataFrame,
    keys: Mapping[str, Column],
    values: Mapping[str, Column],
    order_by: Sequence[str] | None = None,
    valid: tuple[str, str] = VALIDITY,
) -> DataFrame:
    """The segments of ``resolve`` as a join side, without ``__bucket`` where it is broadcast and each key has few of them."""
    few = (F.max("__nth") <= WHOLE_SEGMENTS) if keys else F.max(F.lit(False))
    copies = _bucket(F.col("__until") - 1) - _bucket(F.col("__first")) + 1
    return join_side(_segments(dim, keys, values, order_by, valid), spread=Spread(few, copies, _over_buckets)).drop("__nth")


def _segments(
    dim: DataFrame, keys: Mapping[str, Column], values: Mapping[str, Column], order_by: Sequence[str] | None, valid: tuple[str, str]
) -> DataFrame:
    """One row for each segment: ``keys, __first, __until, __w`` and ``__nth``, the number of its first day among the edges of the key."""
    origin, last, rows = _days(dim, valid)
    names = list(keys)
    start, end = _bound(dim, valid[0]), _bound(dim, valid[1])
    whole_day = end == F.date_trunc("day", end)
    lo = F.greatest(F.unix_date(F.to_date(start)) + 1 - origin, F.lit(0))
    hi = F.least(F.unix_date(F.to_date(end)) - F.when(whole_day, 1).otherwise(0) - origin, F.lit(last))
    spans = dim.select(
        *[key.alias(name) for name, key in keys.items()],
        _winner(row_order(dim, order_by), values).alias("w"),
        lo.alias("lo"),
        hi.alias("hi"),
    ).where((F.col("lo") <= F.col("hi")) & _all_known(names))

    level = F.explode(F.sequence(F.lit(0), F.lit(last.bit_length()))).alias("level")
    blocks = (
        spans.select(*names, "w", "lo", "hi", level)
        .withColumn("a", F.expr("shiftright(lo + shiftleft(1, level) - 1, level)"))
        .withColumn("b", F.expr("shiftright(hi + 1, level)"))
        .where("a < b")
        .select(
            *names, "w", "level",
            F.explode(F.expr("filter(array(if(a % 2 = 1, a, null), if(b % 2 = 1, b - 1, null)), x -> x is not null)")).alias("block"),
        )
        .groupBy(*names, "level", "block")
        .agg(F.max("w").alias("w"))
    )
    if rows * 2 * (last.bit_length() + 1) > MAX_PLANNED_BLOCKS:
        blocks = blocks.hint("merge")
    # One row per distinct edge day, so a key never has more rows here than the calendar has days.
    edges = spans.select(*names, F.explode(F.array(F.col("lo"), F.col("hi") + 1)).alias("first")).distinct()
    following = Window.partitionBy(*(names or [F.lit(0)])).orderBy("first")
    segments = (
        edges.withColumns({"until": F.lead("first").over(following), "nth": F.row_number().over(following)})
        .where(F.col("until").isNotNull())
        .select(*names, "first", "until", "nth", level)
        .withColumn("block", F.expr("shiftright(first, level)"))
        .join(blocks, [*names, "level", "block"])
        .groupBy(*names, "first", "until", "nth")
        .agg(F.max("w").alias("w"))
    )
    first, until = (F.col("first") + origin).alias("__first"), (F.col("until") + origin).alias("__until")
    return segments.select(*names, first, until, F.col("w").alias("__w"), F.col("nth").alias("__nth"))


def _over_buckets(segments: DataFrame) -> DataFrame:
    bucket = F.sequence(_bucket(F.col("__first")), _bucket(F.col("__until") - 1))
    return segments.withColumn("__bucket", F.explode(bucket)).drop("__nth")


def _bucket(day: Column) -> Column:
    return F.shiftright(day, BUCKET_DAYS.bit_length() - 1)


def _all_known(names: Sequence[str]) -> Column:
    known = F.lit(True)
    for name in names:
        known = known & F.col(name).isNotNull()
    return known


def last_match(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    values: Mapping[str, Column],
    out: str,
    day: str | None = "fecha_dia",
    order_by: Sequence[str] | None = None,
    valid: tuple[str, str] = VALIDITY,
) -> DataFrame:
    """Add struct ``out`` (``o`` order, ``v`` values) of the last row that matches the fact row, NULL without one.

    ``on`` maps fact columns to dimension columns. With ``day`` the row must also be valid on that day; the column is
    a date, or midnight as timestamp or epoch seconds. NULL keys, NULL days and days without a row match nothing.
    """
    keys = {f"__k{i}": F.col(name) for i, name in enumerate(on.values())}
    if day is not None:
        return attach(fact, dated_side(dim, keys, values, order_by, valid), list(on), out, day)
    rows = dim.select(
        *[key.alias(name) for name, key in keys.items()], _winner(row_order(dim, order_by), values).alias(out)
    ).where(_all_known(list(keys)))
    side = join_side(rows.groupBy(*keys).agg(F.max(out).alias(out)))
    return fact.join(side, _same(list(on)), "left").drop(*keys)


def _same(columns: Sequence[str]) -> Column:
    test = F.lit(True)
    for i, column in enumerate(columns):
        test = test & (F.col(column) == F.col(f"__k{i}"))
    return test


def attach(fact: DataFrame, side: DataFrame, on: Sequence[str], out: str, day: str) -> DataFrame:
    """Join resolved segments, whose keys are ``__k0, __k1, ...``, to the fact columns ``on``."""
    test = _same(on) & (F.col("__first") <= F.col("__day")) & (F.col("__day") < F.col("__until"))
    if "__bucket" in side.columns:
        test = test & (_bucket(F.col("__day")) == F.col("__bucket"))
    dated = fact.withColumn("__day", _day_number(fact, day))
    joined = dated.join(side.withColumnRenamed("__w", out), test, "left")
    return joined.drop(*[f"__k{i}" for i in range(len(on))], "__bucket", "__first", "__until", "__day")


def _day_number(fact: DataFrame, day: str) -> Column:
    at = moment(fact, day)
    timed = F.raise_error(F.lit(f"{day} must be a day, not a time of day"))
    return F.when(at.isNull() | (at == F.date_trunc("day", at)), F.unix_date(F.to_date(at))).otherwise(timed.cast("int"))


def last_row(dim: DataFrame, columns: Sequence[str], order_by: Sequence[str] | None = None) -> Column:
    """Named columns of the last row of ``dim`` as one struct constant, NULL when there are no rows."""
    winner = F.max(_winner(row_order(dim, order_by), {c: F.col(c) for c in columns}))
    return dim.agg(winner.getField("v").alias("row")).scalar()


def member(fact: DataFrame, column: str, codes: DataFrame, out: str) -> DataFrame:
    """Add boolean ``out``: the code is in the one-column frame ``codes``."""
    name = codes.columns[0]
    side = codes.where(F.col(name).isNotNull()).select(F.col(name).alias("__code")).distinct()
    joined = fact.join(join_side(side), F.col(column) == F.col("__code"), "left")
    return joined.withColumn(out, F.col("__code").isNotNull()).drop("__code")
