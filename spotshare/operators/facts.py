"""Fact scan, market scope, daily aggregate and code sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spotshare import model


def _after(day: str) -> str:
    """Smallest text above every text that starts with ``day``."""
    return day[:-1] + chr(ord(day[-1]) + 1)


def day_between(df: DataFrame, column: str, first: str, last: str) -> Column:
    """``first <= first ten characters <= last`` as a plain range on the column, so that the scan can skip row groups.

    For ten-character bounds the prefix test on text equals ``first <= text < successor(last)``.
    """
    if dict(df.dtypes)[column] == "string":
        return (F.col(column) >= first) & (F.col(column) < _after(last))
    end = F.date_add(F.to_date(F.lit(_clip(last))), 1)
    return (F.col(column) >= F.to_date(F.lit(first))) & (F.col(column) < end)


def _clip(day: str) -> str:
    """Last real day not after ``day`` (months are written up to the 31st)."""
    import calendar

    year, month, number = (int(part) for part in day.split("-"))
    return f"{year:04d}-{month:02d}-{min(number, calendar.monthrange(year, month)[1]):02d}"


def market_scope(
    facts: DataFrame,
    day: str = "dia_progrmd",
    section: str = model.EXCLUDED_SECTION,
    targets: tuple[int, ...] = model.TARGETS,
    first: str = model.FIRST_DAY,
    last: str = model.LAST_DAY,
) -> DataFrame:
    return facts.where(
        (F.col("nom_sect_geog") != section)
        & F.col("cod_target").isin(*targets)
        & day_between(facts, day, first, last)
    )


def process_month(facts: DataFrame, month: str, day: str = "dia_progrmd") -> DataFrame:
    """Rows of one ``yyyy-MM`` month."""
    return facts.where(day_between(facts, day, f"{month}-01", f"{month}-31"))


def scan_facts(facts: DataFrame, month: str | None = None, **scope) -> DataFrame:
    """Market rows with the 76 key columns and 13 measures, programme columns fixed."""
    rows = market_scope(facts if month is None else process_month(facts, month), **scope)
    fixed = {"fecha_dia": "dia_progrmd AS fecha_dia", "des_programa": "'' AS des_programa", "cod_programa": "0L AS cod_programa"}
    return rows.selectExpr(*[fixed.get(name, name) for name in model.KEYS + model.MEASURES])


def daily_aggregate(
    scanned: DataFrame, keys: list[str] = model.KEYS, measures: list[str] = model.MEASURES
) -> DataFrame:
    return scanned.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])


def codes_on_channel(facts: DataFrame, channel: int = model.CHILDREN_CHANNEL) -> DataFrame:
    """Distinct adverts shown on one channel."""
    return facts.where(F.col("cod_cadena") == channel).select("cod_anuncio").distinct()


def codes_in_group(channels: DataFrame, group: str = model.OWN_GROUP) -> DataFrame:
    """Distinct channels of one group."""
    return channels.where(F.col("des_grupo_n1") == group).select("cod_cadena").distinct()
