"""Raw dimension entities to typed tables: plain names, integer codes, day timestamps."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from spotshare.functions import casts
from spotshare.functions.temporal import day_to_timestamp


@dataclass(frozen=True)
class Entity:
    """Output columns in order. ``named`` is the code column that arrives as ``Name``.

    By rule ``fecha_*`` become timestamps, ``cod_*`` and ``flag`` integers (``long_codes`` BIGINT) and the rest stays
    text. ``doubles`` adds a numeric copy of a text column under a new name.
    """

    columns: tuple[str, ...]
    named: str | None = None
    long_codes: tuple[str, ...] = ()
    doubles: dict[str, str] = field(default_factory=dict)


_VALIDITY = ("fecha_fin", "fecha_ini")

# Columns of each entity.
ENTITIES = {
    "linea_negocio": Entity((
        "cod_comunicacion", "cod_tipologia", "cod_tp_categr_km", "cod_tp_computo_km", "cod_tp_lineanegocio_km",
        "des_comunicacion", "des_tipologia", *_VALIDITY, "nom_tp_categr_km", "nom_tp_computo_km", "nom_tp_lineanegocio_km")),
    "agrup_cadenas": Entity((
        "cod_cadena", "cod_grupo_n0", "cod_grupo_n1", "cod_grupo_n2", "des_cadena", "des_grupo_n0", "des_grupo_n1",
        "des_grupo_n2", *_VALIDITY, "cod_forta", "des_forta")),
    "parametros": Entity(("des_parametro", *_VALIDITY, "nom_param", "valor")),
    "coeficientes": Entity((
        "anyo", "coeficiente", "des_cadena", "fecha_act", *_VALIDITY, "flag", "indice", "max_rango", "mes", "min_rango")),
    "configuraciones": Entity((
        "cod_accion", "cod_anunciante_kantar", "cod_anunciante_pe", "cod_cadena", "cod_campana", "cod_programa",
        "cod_tipologia", "des_accion", "des_anunciante_kantar", "des_anunciante_pe", "des_cadena", "des_campana",
        "des_programa", "des_tipologia", *_VALIDITY, "iiee2_formato")),
    "eventos": Entity((
        "cod_cadena", "cod_evento", "cod_programa", "des_cadena", "des_evento", "des_programa", *_VALIDITY, "flag")),
    "cat_cadenas_n2": Entity(("cod_grupo_n2", "des_grupo_n2", *_VALIDITY), "cod_grupo_n2", ("cod_grupo_n2",)),
    "cat_cadenas_n1": Entity(("cod_grupo_n1", "des_grupo_n1", *_VALIDITY), "cod_grupo_n1"),
    "cat_cadenas_n0": Entity(("cod_grupo_n0", "des_grupo_n0", *_VALIDITY), "cod_grupo_n0"),
    "cat_eventos": Entity(
        ("cod_evento", "activo", "des_evento", *_VALIDITY, "indice"), "cod_evento", doubles={"indice_": "indice"}),
    "cat_coeficientes": Entity(("cod_coef", "des_coef", *_VALIDITY), "cod_coef"),
    "cat_nuevas_cadenas": Entity(("cod_cadena_nueva", "des_cadena_n", *_VALIDITY), "cod_cadena_nueva"),
}


def raw_name(entity: Entity, column: str) -> str:
    """Name of ``column`` in the raw entity (matched without regard to case)."""
    return "name" if column == entity.named else f"{column}__c"


def _value(entity: Entity, column: str, raw: Column) -> Column:
    if column.startswith("fecha_"):
        return day_to_timestamp(raw)
    if column in entity.long_codes:
        return casts.code(raw, "bigint")
    if column.startswith("cod_") or column == "flag":
        return casts.code(raw)
    return raw


def conform(raw: DataFrame, entity: str | Entity) -> DataFrame:
    spec = ENTITIES[entity] if isinstance(entity, str) else entity
    found = {name.lower(): name for name in raw.columns}
    texts = {c: F.col(f"`{found[raw_name(spec, c)]}`").cast("string") for c in spec.columns}
    columns = [_value(spec, c, text).alias(c) for c, text in texts.items()]
    copies = [casts.double(texts[source]).alias(name) for name, source in spec.doubles.items()]
    return raw.select(*columns, *copies)
