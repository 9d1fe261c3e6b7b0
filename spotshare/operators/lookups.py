"""The enrichment rules of the share table.

Two match policies are offered where rules reset on a miss: ``last_row`` looks only at the last eligible dimension
row (the historic behaviour), ``any`` takes the last *matching* row (the business meaning). A rule whose numeric input
is NULL yields NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from spotshare import model
from spotshare.functions.temporal import inside, moment
from spotshare.operators import params as parameters
from spotshare.operators.facts import codes_in_group, codes_on_channel
from spotshare.operators.intervals import VALIDITY, attach, dated_side, last_match, last_row, member, row_order

LAST_ROW = "last_row"
ANY = "any"


def _known(value: Column, *inputs: str) -> Column:
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in inputs])
    return F.when(known, value)


def _check(policy: str) -> None:
    if policy not in (LAST_ROW, ANY):
        raise ValueError(f"policy must be '{LAST_ROW}' or '{ANY}', not {policy!r}")


def _valid_on(fact: DataFrame, day: str, row: Column, dim: DataFrame) -> Column:
    def bound(name: str) -> Column:
        missing = F.raise_error(F.lit(f"validity bound {name} must not be null")).cast(dim.schema[name].dataType)
        return F.when(row.isNotNull(), F.coalesce(row.getField(name), missing))

    start, end = (bound(name) for name in VALIDITY)
    if dict(dim.dtypes)[VALIDITY[0]] == "bigint":
        start, end = F.timestamp_seconds(start), F.timestamp_seconds(end)
    return inside(moment(fact, day), start.cast("timestamp"), end.cast("timestamp"))


def _from_last(fact: DataFrame, dim: DataFrame, columns: Sequence[str], order_by: Sequence[str] | None) -> DataFrame:
    """Attach columns of the last dimension row as constant struct ``__row`` (NULL when there is no row)."""
    return fact.withColumn("__row", last_row(dim, columns, order_by))


# -- business line, category, computation type ---------------------------------------------------------------------

_LINE_INPUTS = ("cod_tipologia", "cod_comunicacion")
_LINE_VALUES = (
    "cod_tp_lineanegocio_km", "nom_tp_lineanegocio_km", "cod_tp_categr_km", "nom_tp_categr_km",
    "cod_tp_computo_km", "nom_tp_computo_km",
)


def _with_line(fact: DataFrame, lines: DataFrame, day: str, order_by: Sequence[str] | None, names: Sequence[str]) -> DataFrame:
    return last_match(
        fact, lines, {c: c for c in _LINE_INPUTS}, {c: F.col(c) for c in names}, "__line", day, order_by
    )


def _line_value(name: str, miss, day: str) -> Column:
    line = F.col("__line")
    return _known(F.when(line.isNotNull(), line["v"][name]).otherwise(F.lit(miss)), day, *_LINE_INPUTS)


def _line_columns(day: str) -> dict[str, Column]:
    return {
        "cod_tp_lineanegocio_km": _line_value("cod_tp_lineanegocio_km", model.DEFAULT_BUSINESS_LINE, day).cast("bigint"),
        "nom_tp_lineanegocio_km": _line_value("nom_tp_lineanegocio_km", model.UNSPECIFIED, day),
    }


def _category_columns(day: str) -> dict[str, Column]:
    return {
        "cod_tp_categr_km": _line_value("cod_tp_categr_km", model.DEFAULT_CATEGORY, day).cast("bigint"),
        "nom_tp_categr_km": _line_value("nom_tp_categr_km", model.UNSPECIFIED, day),
    }


def _computation_columns(day: str, params: DataFrame) -> dict[str, Column]:
    line = F.col("__line")
    limit = parameters.scalar_int(params, model.DURATION_PARAM)
    typologies = parameters.scalar_int_list(params, model.TYPOLOGIES_PARAM)
    by_duration = F.array_contains(typologies.cast("array<bigint>"), F.col("cod_tipologia").cast("bigint"))
    short = F.col("duracion") < limit

    def pick(index: int, name: str, miss) -> Column:
        timed = F.when(short, model.SHORT_FORMAT[index]).otherwise(model.LONG_FORMAT[index])
        matched = F.when(by_duration, timed).otherwise(line["v"][name])
        return _known(F.when(line.isNotNull(), matched).otherwise(F.lit(miss)), day, *_LINE_INPUTS, "duracion")

    return {
        "cod_tp_computo_km": pick(0, "cod_tp_computo_km", model.DEFAULT_COMPUTATION).cast("bigint"),
        "nom_tp_computo_km": pick(1, "nom_tp_computo_km", model.UNSPECIFIED),
    }


def business_line(fact: DataFrame, lines: DataFrame, day: str = "fecha_dia", order_by: Sequence[str] | None = None) -> DataFrame:
    return _with_line(fact, lines, day, order_by, _LINE_VALUES[:2]).withColumns(_line_columns(day)).drop("__line")


def category(fact: DataFrame, lines: DataFrame, day: str = "fecha_dia", order_by: Sequence[str] | None = None) -> DataFrame:
    return _with_line(fact, lines, day, order_by, _LINE_VALUES[2:4]).withColumns(_category_columns(day)).drop("__line")


def computation(
    fact: DataFrame, lines: DataFrame, params: DataFrame, day: str = "fecha_dia", order_by: Sequence[str] | None = None
) -> DataFrame:
    joined = _with_line(fact, lines, day, order_by, _LINE_VALUES[4:])
    return joined.withColumns(_computation_columns(day, params)).drop("__line")


def line_columns(
    fact: DataFrame, lines: DataFrame, params: DataFrame, day: str = "fecha_dia", order_by: Sequence[str] | None = None
) -> DataFrame:
    """All six business-line columns from one join."""
    joined = _with_line(fact, lines, day, order_by, _LINE_VALUES)
    columns = _line_columns(day) | _category_columns(day) | _computation_columns(day, params)
    return joined.withColumns(columns).drop("__line")


# -- channel flags -------------------------------------------------------------------------------------------------


def _channel_flag(
    fact: DataFrame, channels: DataFrame, eligible: Column, out: str, policy: str, day: str, order_by: Sequence[str] | None
) -> DataFrame:
    _check(policy)
    if policy == ANY:
        joined = last_match(
            fact, channels.where(eligible), {"cod_cadena": "cod_cadena"}, {"hit": F.lit(True)}, "__hit", day, order_by
        )
        matched = F.col("__hit").isNotNull()
    else:
        joined = _from_last(fact, channels.where(eligible), ("cod_cadena", *VALIDITY), order_by)
        row = F.col("__row")
        matched = (F.col("cod_cadena") == row["cod_cadena"]) & _valid_on(fact, day, row, channels)
    flag = _known(F.when(matched, 1).otherwise(0), day, "cod_cadena")
    return joined.withColumn(out, flag).drop("__hit", "__row")


def regional_flag(
    fact: DataFrame, channels: DataFrame, policy: str = LAST_ROW, group: int = model.REGIONAL_GROUP,
    day: str = "fecha_dia", order_by: Sequence[str] | None = None,
) -> DataFrame:
    return _channel_flag(fact, channels, F.col("cod_grupo_n2") == group, "cod_fg_autonomica", policy, day, order_by)


def forta_flag(
    fact: DataFrame, channels: DataFrame, policy: str = LAST_ROW, day: str = "fecha_dia", order_by: Sequence[str] | None = None
) -> DataFrame:
    return _channel_flag(fact, channels, F.col("cod_forta") == 1, "cod_fg_forta", policy, day, order_by)


def _dated_membership(
    fact: DataFrame, channels: DataFrame, membership: Column, out: str, empty: int, inputs: Sequence[str],
    policy: str, day: str, order_by: Sequence[str] | None,
) -> DataFrame:
    """Flag rows whose code is a member while a channel row (last, or any) is valid on the day."""
    _check(policy)
    joined = _from_last(fact, channels, VALIDITY, order_by)
    if policy == ANY:
        joined = last_match(joined, channels, {}, {"hit": F.lit(True)}, "__hit", day, order_by)
        valid = F.col("__hit").isNotNull()
    else:
        valid = _valid_on(fact, day, F.col("__row"), channels)
    flag = F.when(F.col("__row").isNull(), empty).when(membership & valid, 1).otherwise(0)
    return joined.withColumn(out, _known(flag, day, *inputs)).drop("__row", "__hit")


def children_flag(
    fact: DataFrame, channels: DataFrame, codes: DataFrame | None = None, policy: str = LAST_ROW,
    channel: int = model.CHILDREN_CHANNEL, day: str = "fecha_dia", order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Adverts that are also shown on the children channel; ``codes`` defaults to a scan of ``fact``."""
    codes = codes_on_channel(fact, channel) if codes is None else codes
    joined = member(fact, "cod_anuncio", codes, "__member")
    flagged = _dated_membership(
        joined, channels, F.col("__member"), "cod_fg_boing", 0, ("cod_cadena", "cod_anuncio"), policy, day, order_by
    )
    return flagged.drop("__member")


def own_group_flags(
    fact: DataFrame, channels: DataFrame, codes: DataFrame | None = None, policy: str = LAST_ROW,
    outs: Sequence[str] = ("cod_fg_campemimediaset", "cod_fg_anuncmediaset"), group: str = model.OWN_GROUP,
    day: str = "fecha_dia", order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Channels of the own group, once for campaigns and once for advertisers (they differ in their NULL inputs)."""
    inputs = {
        "cod_fg_campemimediaset": ("cod_anuncio", "cod_cadena"),
        "cod_fg_anuncmediaset": ("cod_anunciante_subsidiario", "cod_cadena"),
    }
    codes = codes_in_group(channels, group) if codes is None else codes
    first, *others = outs
    joined = member(fact, "cod_cadena", codes, "__member")
    flagged = _dated_membership(joined, channels, F.col("__member"), "__flag", -1, ("cod_cadena",), policy, day, order_by)
    columns = {out: _known(F.col("__flag"), day, *inputs[out]) for out in (first, *others)}
    return flagged.withColumns(columns).drop("__member", "__flag")


# -- rules on campaigns and advertisers ----------------------------------------------------------------------------

_BAND_INPUTS = ("cod_anuncio", "cod_anunc", "cod_anunciante_subsidiario")


def time_band(
    fact: DataFrame, rules: DataFrame, policy: str = LAST_ROW, day: str = "fecha_dia", order_by: Sequence[str] | None = None
) -> DataFrame:
    """Relabel rules: code and name of the action, else the row's own channel code and name."""
    _check(policy)
    relabel = rules.where(~F.col("des_accion").eqNullSafe(model.FILTER_ACTION))
    empty = F.col("__row").isNull()
    rule = ("cod_accion", "des_accion", "cod_campana", "cod_anunciante_pe", "cod_anunciante_kantar", *VALIDITY)
    joined = _from_last(fact, relabel, rule, order_by)
    row = F.col("__row")
    if policy == ANY:
        values = {"cod": F.col("cod_accion"), "nom": F.col("des_accion")}
        joined = last_match(
            joined, relabel, {"cod_anuncio": "cod_campana", "cod_anunc": "cod_anunciante_pe"}, values, "__campaign", day, order_by
        )
        joined = last_match(
            joined, relabel, {"cod_anunciante_subsidiario": "cod_anunciante_kantar"}, values, "__advertiser", day, order_by
        )
        best = F.greatest(F.col("__campaign"), F.col("__advertiser"))
        matched, code, name = best.isNotNull(), best["v"]["cod"], best["v"]["nom"]
    else:
        campaign = (row["cod_campana"] == F.col("cod_anuncio")) & (row["cod_anunciante_pe"] == F.col("cod_anunc"))
        advertiser = row["cod_anunciante_kantar"] == F.col("cod_anunciante_subsidiario")
        matched = (campaign | advertiser) & _valid_on(fact, day, row, rules)
        code, name = row["cod_accion"], row["des_accion"]
    cod = F.when(empty, 0).when(matched, code).otherwise(F.col("cod_cadena"))
    nom = F.when(empty, "").when(matched, name).otherwise(F.col("nom_cadena"))
    columns = {
        "cod_identif_franja": _known(cod, day, *_BAND_INPUTS, "cod_cadena").cast("bigint"),
        "nom_identif_franja": _known(nom, day, *_BAND_INPUTS),
    }
    return joined.withColumns(columns).drop("__row", "__campaign", "__advertiser")


def filtered_flag(fact: DataFrame, rules: DataFrame, day: str = "fecha_dia", order_by: Sequence[str] | None = None) -> DataFrame:
    """Filter rules: any match by advertiser and campaign on a channel, or by programme and typology on a channel."""
    drop = rules.where(F.lower("des_accion") == model.FILTER_ACTION.lower())
    campaign = {"cod_anuncio": "cod_campana", "cod_cadena": "cod_cadena"}
    branches = {
        "__by_advertiser": {"cod_anunc": "cod_anunciante_pe", **campaign},
        "__by_subsidiary": {"cod_anunciante_subsidiario": "cod_anunciante_kantar", **campaign},
        "__by_programme": {"cod_cadena": "cod_cadena", "cod_programa": "cod_programa", "cod_tipologia": "cod_tipologia"},
    }
    # The branches have three keys each, so one pass over the rules resolves them all.
    ways = [
        F.struct(F.lit(out).alias("__branch"), *[F.col(c).cast("bigint").alias(f"__k{i}") for i, c in enumerate(on.values())])
        for out, on in branches.items()
    ]
    keys = {name: F.col(f"__way.{name}") for name in ("__branch", "__k0", "__k1", "__k2")}
    order = row_order(drop, order_by)
    side = dated_side(drop.withColumn("__way", F.explode(F.array(*ways))), keys, {"hit": F.lit(True)}, order)
    joined = fact
    for out, on in branches.items():
        joined = attach(joined, side.where(F.col("__branch") == out).drop("__branch"), list(on), out, day)
    hit = reduce(lambda a, b: a | b, [F.col(out).isNotNull() for out in branches])
    inputs = ("cod_anunc", "cod_anunciante_subsidiario", "cod_anuncio", "cod_cadena", "cod_programa", "cod_tipologia")
    flag = _known(F.when(hit, 1).otherwise(0), day, *inputs).cast("bigint")
    return joined.withColumn("cod_fg_filtrado", flag).drop(*branches)


def purchase_target(
    fact: DataFrame, targets: DataFrame, policy: str = LAST_ROW, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Purchase target of a campaign on a channel; this rule has no validity dates."""
    _check(policy)
    if policy == ANY:
        on = {"cod_anuncio": "cod_anuncio", "cod_cadena": "cod_cadena"}
        joined = last_match(fact, targets, on, {"cod": F.col("cod_target")}, "__hit", None, order_by)
        matched, code = F.col("__hit").isNotNull(), F.col("__hit")["v"]["cod"]
    else:
        joined = _from_last(fact, targets, ("cod_anuncio", "cod_cadena", "cod_target"), order_by)
        row = F.col("__row")
        matched = (row["cod_anuncio"] == F.col("cod_anuncio")) & (row["cod_cadena"] == F.col("cod_cadena"))
        code = row["cod_target"]
    target = _known(F.when(matched, code).otherwise(0), "cod_anuncio", "cod_cadena").cast("bigint")
    return joined.withColumn("cod_target_compra", target).drop("__hit", "__row")


def programme_event(
    fact: DataFrame, events: DataFrame, policy: str = LAST_ROW, day: str = "fecha_dia", order_by: Sequence[str] | None = None
) -> DataFrame:
    _check(policy)
    inputs = ("cod_cadena", "cod_programa")
    if policy == ANY:
        values = {"cod": F.col("cod_evento"), "nom": F.col("des_evento")}
        joined = last_match(fact, events, {c: c for c in inputs}, values, "__hit", day, order_by)
        hit = F.col("__hit")
        matched, code, name = hit.isNotNull(), hit["v"]["cod"], hit["v"]["nom"]
    else:
        joined = _from_last(fact, events, (*inputs, "cod_evento", "des_evento", *VALIDITY), order_by)
        row = F.col("__row")
        matched = (
            (row["cod_cadena"] == F.col("cod_cadena"))
            & (row["cod_programa"] == F.col("cod_programa"))
            & _valid_on(fact, day, row, events)
        )
        code, name = row["cod_evento"], row["des_evento"]
    columns = {
        "cod_eventos": _known(F.when(matched, code).otherwise(0), day, *inputs).cast("bigint"),
        "nom_eventos": _known(F.when(matched, name).otherwise(""), day, *inputs),
    }
    return joined.withColumns(columns).drop("__hit", "__row")
