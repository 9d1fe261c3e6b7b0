"""Names and constants of the share data model."""

from __future__ import annotations

# Grouping columns of the daily fact, in output order.
KEYS = [
    "fecha_dia", "dia_progrmd", "cod_mes_com", "nom_mes_com", "aniomes", "cod_periodo", "nom_periodo",
    "cod_day_part", "des_day_part", "cod_cadena", "nom_cadena", "cod_anuncio", "nom_anuncio",
    "cod_anunciante_subsidiario", "nom_anunciante_subsidiario", "cod_sect_geog", "nom_sect_geog",
    "cod_tipologia", "nom_tipologia", "cod_comunicacion", "nom_comunicacion", "cod_producto", "nom_producto",
    "cod_grupo", "nom_grupo", "cod_sector", "nom_sector", "duracion", "cod_pos_pb2", "cod_pos_pb3",
    "num_spots_pb2", "num_spots_pb3", "cod_posicion_pb2", "nom_posicion_pb2", "cod_posicion_pb3",
    "nom_posicion_pb3", "cod_cualitativo", "nom_cualitativo", "cod_ejecutivo", "nom_ejecutivo",
    "cod_subdivision", "nom_subdivision", "cod_division", "nom_division", "cod_area", "nom_area",
    "cod_dir_comercial", "nom_dir_comercial", "cod_dir_general", "nom_dir_general", "cod_empresa",
    "nom_empresa", "cod_marca", "nom_marca", "cod_anunc", "nom_anunc", "cod_holding", "nom_holding",
    "cod_central", "nom_central", "cod_marca_h", "nom_marca_h", "cod_anunc_h", "nom_anunc_h", "cod_target",
    "nom_target", "cod_fg_anun_local", "nom_fg_anun_local", "cod_fg_televenta", "nom_fg_televenta",
    "cod_fg_pub_compartida", "nom_fg_pub_compartida", "cod_fg_autopromo", "nom_fg_autopromo",
    "des_programa", "cod_programa",
]

# Summed measures, in output order.
MEASURES = [
    "cant_pases", "grps_brutos", "grps_20", "grps_vosdal", "grps_20_vosdal", "grps_bruto_inv", "grps_20_inv",
    "grps_vosdal_inv", "grps_20_vosdal_inv", "grps_timeshift", "grps_20_timeshift", "grps_timeshift_inv",
    "grps_20_timeshift_inv",
]

# Derived columns of the share table, in output order.
DERIVED = [
    "cod_tp_lineanegocio_km", "nom_tp_lineanegocio_km", "cod_tp_categr_km", "nom_tp_categr_km",
    "cod_fg_autonomica", "nom_fg_autonomica", "cod_fg_forta", "nom_fg_forta", "cod_fg_boing", "nom_fg_boing",
    "cod_identif_franja", "nom_identif_franja", "cod_target_compra", "cod_fg_filtrado", "nom_fg_filtrado",
    "cod_fg_campemimediaset", "nom_fg_campemimediaset", "cod_tp_computo_km", "nom_tp_computo_km",
    "cod_eventos", "nom_eventos", "cod_fg_anuncmediaset", "nom_fg_anuncmediaset",
]

# Market scope of the fact scan.
EXCLUDED_SECTION = "PBC"
TARGETS = (5, 3, 2)
FIRST_DAY = "1999-01-01"
LAST_DAY = "2099-01-31"

# Codes and names used by the lookup rules.
UNSPECIFIED = "Sin Especificar"
DEFAULT_BUSINESS_LINE = 1003
DEFAULT_CATEGORY = 2006
DEFAULT_COMPUTATION = 3005
SHORT_FORMAT = (3002, "IIEE 12'")
LONG_FORMAT = (3003, "IIEE 3'")
REGIONAL_GROUP = 30006
CHILDREN_CHANNEL = 5176
OWN_GROUP = "MEDIASET"
FILTER_ACTION = "Filtrar"
DURATION_PARAM = "DURACION_IIEE"
TYPOLOGIES_PARAM = "TIPOLOGIAS_DURACION"
