"""Share queries: scan, aggregate, codes, parameters, lookups, flagship; each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from spotshare import model
from spotshare.functions.labels import yes_no
from spotshare.functions.temporal import day_to_timestamp, epoch_seconds, month_key
from spotshare.operators import facts as fact_ops, lookups, params
from spotshare.plans.share_job import Dimensions, share_table
from spotshare.plans.staging import new_folder, write_stage
from spotshare.sources import tables
from workload.views import CHANNEL, VIEWS, table, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str, *views: str) -> Callable[[Query], Query]:
    """Register a query with its SQL; ``views`` are the derived tables that the SQL reads."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        ORACLES[name] = with_views(views, sql)
        return run

    return register


def with_views(views, sql: str) -> str:
    parts = [f"{name} AS ({VIEWS[name]})" for name in views]
    if not parts:
        return sql
    return "WITH " + ",\n".join(parts) + (",\n" + sql.strip()[5:] if sql.strip().upper().startswith("WITH ") else "\n" + sql)


def market(spark: SparkSession, sf: str) -> DataFrame:
    return fact_ops.scan_facts(view(spark, sf, "fcts_mercado_lineal"))


def doubles(df: DataFrame) -> DataFrame:
    """Decimal sums as doubles, which both engines print alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns if c in model.MEASURES[1:]})


# -- SQL text ------------------------------------------------------------------------------------------------------

_SCOPE = """nom_sect_geog <> 'PBC' AND cod_target IN (5, 3, 2)
  AND substring(dia_progrmd, 1, 10) >= '1999-01-01' AND substring(dia_progrmd, 1, 10) <= '2099-01-31'"""
_FIXED = {"fecha_dia": "dia_progrmd AS fecha_dia", "des_programa": "'' AS des_programa", "cod_programa": "CAST(0 AS BIGINT) AS cod_programa"}
_KEYS_SQL = ", ".join(_FIXED.get(k, k) for k in model.KEYS)
_SCAN_SQL = f"SELECT {_KEYS_SQL}, {', '.join(model.MEASURES)} FROM fcts_mercado_lineal WHERE {_SCOPE}"
_AS_DOUBLE = "cant_pases, " + ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in model.MEASURES[1:])
_SUMS = "CAST(SUM(cant_pases) AS BIGINT) AS cant_pases, " + ", ".join(
    f"CAST(SUM({m}) AS DOUBLE) AS {m}" for m in model.MEASURES[1:]
)
_DAILY_SQL = f"SELECT {', '.join(model.KEYS)}, {_SUMS} FROM market GROUP BY {', '.join(model.KEYS)}"
_SRC = f"market AS ({_SCAN_SQL}), src AS (SELECT *, CAST(epoch(CAST(fecha_dia AS TIMESTAMP)) AS BIGINT) AS t FROM market)"


def _null_if_missing(inputs: str, value: str) -> str:
    test = " OR ".join(f"src.{c} IS NULL" for c in inputs.split())
    return f"CASE WHEN {test} THEN NULL ELSE {value} END"


_HIT = "k.t > d.fecha_ini AND k.t < d.fecha_fin"
_VALID = "src.t > {0}.fecha_ini AND src.t < {0}.fecha_fin"

# rule: (views, CTEs, joins, {column: expression})
RULES: dict[str, tuple[list[str], list[str], list[str], dict[str, str]]] = {}

_LINE_CTE = f"""line_hit AS (
  SELECT k.fecha_dia, k.cod_tipologia, k.cod_comunicacion, arg_max(struct_pack(ln := cod_tp_lineanegocio_km, ln_nom := nom_tp_lineanegocio_km,
    ct := cod_tp_categr_km, ct_nom := nom_tp_categr_km, cp := cod_tp_computo_km, cp_nom := nom_tp_computo_km), ord) AS w
  FROM (SELECT DISTINCT fecha_dia, t, cod_tipologia, cod_comunicacion FROM src) k JOIN dim_linea_negocio d
    ON d.cod_tipologia = k.cod_tipologia AND d.cod_comunicacion = k.cod_comunicacion AND {_HIT} GROUP BY ALL)"""
_LINE_JOIN = """LEFT JOIN line_hit ON line_hit.fecha_dia = src.fecha_dia AND line_hit.cod_tipologia = src.cod_tipologia
  AND line_hit.cod_comunicacion = src.cod_comunicacion"""
_PARAM_CTE = """p_limit AS (SELECT CAST(valor AS INT) AS v FROM tb_parametros WHERE nom_param = 'DURACION_IIEE'),
p_types AS (SELECT CAST(u AS INT) AS v FROM (SELECT unnest(string_split(valor, ';')) AS u FROM tb_parametros WHERE nom_param = 'TIPOLOGIAS_DURACION'))"""


def _line_sql(field: str, miss: str) -> str:
    return _null_if_missing("cod_tipologia cod_comunicacion", f"CASE WHEN w IS NULL THEN {miss} ELSE w.{field} END")


def _comp_sql(field: str, short: str, long: str, miss: str) -> str:
    return _null_if_missing(
        "cod_tipologia cod_comunicacion duracion",
        f"""CASE WHEN w IS NULL THEN {miss} WHEN src.cod_tipologia IN (SELECT v FROM p_types)
        THEN CASE WHEN duracion < (SELECT v FROM p_limit) THEN {short} ELSE {long} END ELSE w.{field} END""",
    )


RULES["lookup_linea_negocio"] = (["dim_linea_negocio"], [_LINE_CTE], [_LINE_JOIN], {
    "cod_tp_lineanegocio_km": _line_sql("ln", "1003"), "nom_tp_lineanegocio_km": _line_sql("ln_nom", "'Sin Especificar'")})
RULES["lookup_categr"] = (["dim_linea_negocio"], [_LINE_CTE], [_LINE_JOIN], {
    "cod_tp_categr_km": _line_sql("ct", "2006"), "nom_tp_categr_km": _line_sql("ct_nom", "'Sin Especificar'")})
RULES["lookup_computo"] = (["dim_linea_negocio", "tb_parametros"], [_LINE_CTE, _PARAM_CTE], [_LINE_JOIN], {
    "cod_tp_computo_km": _comp_sql("cp", "3002", "3003", "3005"),
    "nom_tp_computo_km": _comp_sql("cp_nom", "'IIEE 12'''", "'IIEE 3'''", "'Sin Especificar'")})

for _name, _eligible in {"autonomica": "cod_grupo_n2 = 30006", "forta": "cod_forta = 1"}.items():
    RULES[f"flag_{_name}"] = (
        ["dim_agrup_cadenas"],
        [f"last_{_name} AS (SELECT * FROM dim_agrup_cadenas WHERE {_eligible} ORDER BY ord DESC LIMIT 1)"],
        [f"LEFT JOIN last_{_name} ON TRUE"],
        {f"cod_fg_{_name}": _null_if_missing("cod_cadena", f"""CASE WHEN last_{_name}.cod_cadena = src.cod_cadena
            AND {_VALID.format('last_' + _name)} THEN 1 ELSE 0 END""")},
    )
    RULES[f"flag_{_name}_any"] = (
        ["dim_agrup_cadenas"], [], [],
        {f"cod_fg_{_name}": _null_if_missing("cod_cadena", f"""CASE WHEN EXISTS (SELECT 1 FROM dim_agrup_cadenas d
            WHERE {_eligible} AND d.cod_cadena = src.cod_cadena AND {_VALID.format('d')}) THEN 1 ELSE 0 END""")},
    )

_LAST_CHANNEL = "last_channel AS (SELECT * FROM dim_agrup_cadenas ORDER BY ord DESC LIMIT 1)"
_CHILDREN = f"children AS (SELECT DISTINCT cod_anuncio FROM market WHERE cod_cadena = {CHANNEL})"
_OWN = "own AS (SELECT DISTINCT cod_cadena FROM dim_agrup_cadenas WHERE des_grupo_n1 = 'MEDIASET')"
_LAST_VALID = _VALID.format("last_channel")
_ANY_VALID = f"EXISTS (SELECT 1 FROM dim_agrup_cadenas d WHERE {_VALID.format('d')})"
for _suffix, _test in {"": _LAST_VALID, "_any": _ANY_VALID}.items():
    RULES["flag_boing" + _suffix] = (
        ["dim_agrup_cadenas"], [_LAST_CHANNEL, _CHILDREN], ["LEFT JOIN last_channel ON TRUE"],
        {"cod_fg_boing": _null_if_missing("cod_cadena cod_anuncio", f"""CASE WHEN src.cod_anuncio IN (SELECT cod_anuncio FROM children)
            AND {_test} THEN 1 ELSE 0 END""")},
    )
    for _out, _input in {"campemimediaset": "cod_anuncio", "anuncmediaset": "cod_anunciante_subsidiario"}.items():
        RULES[f"flag_{_out}{_suffix}"] = (
            ["dim_agrup_cadenas"], [_LAST_CHANNEL, _OWN], ["LEFT JOIN last_channel ON TRUE"],
            {f"cod_fg_{_out}": _null_if_missing(f"cod_cadena {_input}", f"""CASE WHEN last_channel.ord IS NULL THEN -1
                WHEN src.cod_cadena IN (SELECT cod_cadena FROM own) AND {_test} THEN 1 ELSE 0 END""")},
        )

_BAND = """((d.cod_campana = {0}.cod_anuncio AND d.cod_anunciante_pe = {0}.cod_anunc)
  OR d.cod_anunciante_kantar = {0}.cod_anunciante_subsidiario)"""
_RELABEL = "des_accion IS DISTINCT FROM 'Filtrar'"


def _band(cod: str, nom: str, hit: str) -> dict[str, str]:
    none = f"NOT EXISTS (SELECT 1 FROM tb_configuraciones WHERE {_RELABEL})"
    return {
        "cod_identif_franja": _null_if_missing(
            "cod_anuncio cod_anunc cod_anunciante_subsidiario cod_cadena",
            f"CASE WHEN {none} THEN 0 WHEN {hit} THEN {cod} ELSE src.cod_cadena END"),
        "nom_identif_franja": _null_if_missing(
            "cod_anuncio cod_anunc cod_anunciante_subsidiario",
            f"CASE WHEN {none} THEN '' WHEN {hit} THEN {nom} ELSE src.nom_cadena END"),
    }


RULES["lookup_franja"] = (
    ["tb_configuraciones"], [f"last_rule AS (SELECT * FROM tb_configuraciones WHERE {_RELABEL} ORDER BY ord DESC LIMIT 1)"],
    ["LEFT JOIN last_rule d ON TRUE"], _band("d.cod_accion", "d.des_accion", f"{_BAND.format('src')} AND {_VALID.format('d')}"))
RULES["lookup_franja_any"] = (
    ["tb_configuraciones"],
    [f"""band_hit AS (SELECT k.fecha_dia, k.cod_anuncio, k.cod_anunc, k.cod_anunciante_subsidiario,
        arg_max(struct_pack(cod := cod_accion, nom := des_accion), ord) AS b
      FROM (SELECT DISTINCT fecha_dia, t, cod_anuncio, cod_anunc, cod_anunciante_subsidiario FROM src) k
      JOIN tb_configuraciones d ON {_RELABEL} AND {_BAND.format('k')} AND {_HIT} GROUP BY ALL)"""],
    ["""LEFT JOIN band_hit ON band_hit.fecha_dia = src.fecha_dia AND band_hit.cod_anuncio = src.cod_anuncio
      AND band_hit.cod_anunc = src.cod_anunc AND band_hit.cod_anunciante_subsidiario = src.cod_anunciante_subsidiario"""],
    _band("b.cod", "b.nom", "b IS NOT NULL"))

RULES["lookup_target_compra"] = (
    ["rel_campania_trgt"], ["last_target AS (SELECT * FROM rel_campania_trgt ORDER BY ord DESC LIMIT 1)"], ["LEFT JOIN last_target ON TRUE"],
    {"cod_target_compra": _null_if_missing("cod_anuncio cod_cadena", """CASE WHEN last_target.cod_anuncio = src.cod_anuncio
        AND last_target.cod_cadena = src.cod_cadena THEN last_target.cod_target ELSE 0 END""")})
RULES["lookup_target_compra_any"] = (
    ["rel_campania_trgt"],
    ["target_hit AS (SELECT cod_anuncio, cod_cadena, arg_max(struct_pack(v := cod_target), ord) AS g FROM rel_campania_trgt GROUP BY ALL)"],
    ["LEFT JOIN target_hit ON target_hit.cod_anuncio = src.cod_anuncio AND target_hit.cod_cadena = src.cod_cadena"],
    {"cod_target_compra": _null_if_missing("cod_anuncio cod_cadena", "CASE WHEN g IS NULL THEN 0 ELSE g.v END")})

RULES["flag_filtrado"] = (
    ["tb_configuraciones"], [], [],
    {"cod_fg_filtrado": _null_if_missing(
        "cod_anunc cod_anunciante_subsidiario cod_anuncio cod_cadena cod_programa cod_tipologia",
        f"""CASE WHEN EXISTS (SELECT 1 FROM tb_configuraciones d WHERE lower(des_accion) = 'filtrar' AND {_VALID.format('d')}
          AND d.cod_cadena = src.cod_cadena AND d.cod_campana = src.cod_anuncio
          AND (d.cod_anunciante_pe = src.cod_anunc OR d.cod_anunciante_kantar = src.cod_anunciante_subsidiario))
        OR EXISTS (SELECT 1 FROM tb_configuraciones d WHERE lower(des_accion) = 'filtrar' AND {_VALID.format('d')}
          AND d.cod_cadena = src.cod_cadena AND d.cod_programa = src.cod_programa AND d.cod_tipologia = src.cod_tipologia)
        THEN CAST(1 AS BIGINT) ELSE 0 END""")})

RULES["lookup_eventos"] = (
    ["tb_eventos"], ["last_event AS (SELECT * FROM tb_eventos ORDER BY ord DESC LIMIT 1)"], ["LEFT JOIN last_event e ON TRUE"],
    {c: _null_if_missing("cod_cadena cod_programa", f"""CASE WHEN e.cod_cadena = src.cod_cadena AND e.cod_programa = src.cod_programa
        AND {_VALID.format('e')} THEN e.{v} ELSE {miss} END""")
     for c, v, miss in [("cod_eventos", "cod_evento", "0"), ("nom_eventos", "des_evento", "''")]})
RULES["lookup_eventos_any"] = (
    ["tb_eventos"],
    [f"""event_hit AS (SELECT k.fecha_dia, k.cod_cadena, k.cod_programa, arg_max(struct_pack(cod := cod_evento, nom := des_evento), ord) AS x
      FROM (SELECT DISTINCT fecha_dia, t, cod_cadena, cod_programa FROM src) k JOIN tb_eventos d
      ON d.cod_cadena = k.cod_cadena AND d.cod_programa = k.cod_programa AND {_HIT} GROUP BY ALL)"""],
    ["""LEFT JOIN event_hit ON event_hit.fecha_dia = src.fecha_dia AND event_hit.cod_cadena = src.cod_cadena
      AND event_hit.cod_programa = src.cod_programa"""],
    {c: _null_if_missing("cod_cadena cod_programa", f"CASE WHEN x IS NULL THEN {miss} ELSE x.{v} END")
     for c, v, miss in [("cod_eventos", "cod", "0"), ("nom_eventos", "nom", "''")]})

LOOKUP_KEYS = [
    "fecha_dia", "cod_cadena", "nom_cadena", "cod_anuncio", "cod_anunc", "cod_anunciante_subsidiario", "cod_programa",
    "cod_tipologia", "cod_comunicacion", "duracion",
]


def _rule_sql(names: list[str], source: str, columns: str, extra: str = "") -> str:
    """SELECT of ``columns`` and the rules' columns over ``source`` (CTEs ending in ``src``)."""
    views = list(dict.fromkeys(["fcts_mercado_lineal", *(v for n in names for v in RULES[n][0])]))
    ctes = list(dict.fromkeys(c for n in names for c in RULES[n][1]))
    joins = list(dict.fromkeys(j for n in names for j in RULES[n][2]))
    rules = [f"{sql} AS {column}" for n in names for column, sql in RULES[n][3].items()]
    text = "WITH " + ",\n".join([source, *ctes]) + f"\nSELECT {columns}, " + ",\n".join(rules) + extra
    return with_views(views, text + "\nFROM src " + "\n".join(joins))


# -- scan, filters, aggregate --------------------------------------------------------------------------------------


@query("scan_facts", _SCAN_SQL.replace(", ".join(model.MEASURES), _AS_DOUBLE), "fcts_mercado_lineal")
def scan_facts(spark, sf):
    return doubles(market(spark, sf))


@query("filter_market_scope", f"SELECT {', '.join(LOOKUP_KEYS[1:6])}, dia_progrmd, nom_sect_geog, cod_target FROM fcts_mercado_lineal WHERE {_SCOPE}",
       "fcts_mercado_lineal")
def filter_market_scope(spark, sf):
    rows = fact_ops.market_scope(view(spark, sf, "fcts_mercado_lineal"))
    return rows.select(*LOOKUP_KEYS[1:6], "dia_progrmd", "nom_sect_geog", "cod_target")


@query("filter_process_month", """SELECT dia_progrmd, cod_cadena, cod_anuncio, cod_target FROM fcts_mercado_lineal
WHERE substring(dia_progrmd, 1, 10) >= '1998-05-01' AND substring(dia_progrmd, 1, 10) <= '1998-05-31'""", "fcts_mercado_lineal")
def filter_process_month(spark, sf):
    rows = fact_ops.process_month(view(spark, sf, "fcts_mercado_lineal"), "1998-05")
    return rows.select("dia_progrmd", "cod_cadena", "cod_anuncio", "cod_target")


@query("agg_daily_grps", f"WITH market AS ({_SCAN_SQL}) {_DAILY_SQL}", "fcts_mercado_lineal")
def agg_daily_grps(spark, sf):
    return doubles(fact_ops.daily_aggregate(market(spark, sf)))


@query("day_to_timestamp", "SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS fecha_dia FROM lineitem")
def day_to_timestamp_query(spark, sf):
    day = F.col("l_shipdate").cast("string")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", day_to_timestamp(day).alias("fecha_dia"))


@query("day_to_epoch", "SELECT l_orderkey, l_linenumber, CAST(epoch(CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)) AS BIGINT) AS t FROM lineitem")
def day_to_epoch_query(spark, sf):
    day = day_to_timestamp(F.col("l_shipdate").cast("string"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", epoch_seconds(day).alias("t"))


@query("month_partition", f"""WITH market AS ({_SCAN_SQL}), daily AS ({_DAILY_SQL})
SELECT substring(fecha_dia, 1, 7) AS fecha_part, count(*) AS n_rows, CAST(SUM(CAST(grps_brutos AS DECIMAL(28,2))) AS DOUBLE) AS grps_brutos FROM daily GROUP BY 1""",
       "fcts_mercado_lineal")
def month_partition(spark, sf):
    """Write the daily table partitioned by month, read it back, count by month."""
    daily = fact_ops.daily_aggregate(market(spark, sf)).withColumn("fecha_dia", day_to_timestamp(F.col("fecha_dia")))
    path = new_folder(spark, "share")
    name = "share_" + path[-32:]
    tables.save_table(daily.withColumn("fecha_part", month_key(F.col("fecha_dia"))), name, path, partition_by="fecha_part")
    spark.sql(f"DROP TABLE {name}")
    months = spark.read.option("basePath", path).parquet(path).groupBy(F.col("fecha_part").cast("string").alias("fecha_part"))
    return months.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("grps_brutos").cast("double").alias("grps_brutos"))


@query("param_scalar", "SELECT nom_param, CAST(arg_min(valor, ord) AS VARCHAR) AS valor FROM tb_parametros WHERE nom_param = 'DURACION_IIEE' GROUP BY nom_param",
       "tb_parametros")
def param_scalar(spark, sf):
    rows = params.parameter(view(spark, sf, "tb_parametros"), model.DURATION_PARAM, ["ord"])
    return rows.select(F.lit(model.DURATION_PARAM).alias("nom_param"), "valor")


@query("param_list", "SELECT nom_param, ord, CAST(unnest(string_split(valor, ';')) AS INT) AS code FROM tb_parametros",
       "tb_parametros")
def param_list(spark, sf):
    rows = view(spark, sf, "tb_parametros")
    return rows.select("nom_param", "ord", F.explode(params.as_int_list(F.col("valor"))).alias("code"))


@query("codes_on_channel", f"SELECT DISTINCT cod_anuncio FROM fcts_mercado_lineal WHERE {_SCOPE} AND cod_cadena = {CHANNEL}", "fcts_mercado_lineal")
def codes_on_channel(spark, sf):
    return fact_ops.codes_on_channel(market(spark, sf), CHANNEL)


@query("codes_in_group", "SELECT DISTINCT cod_cadena FROM dim_agrup_cadenas WHERE des_grupo_n1 = 'MEDIASET'", "dim_agrup_cadenas")
def codes_in_group(spark, sf):
    return fact_ops.codes_in_group(view(spark, sf, "dim_agrup_cadenas"))


# -- lookups -------------------------------------------------------------------------------------------------------


def _rules_table(spark: SparkSession, sf: str) -> DataFrame:
    return write_stage(view(spark, sf, "tb_configuraciones"), "rules")


LOOKUPS: dict[str, Callable[[SparkSession, str, DataFrame, str], DataFrame]] = {
    "lookup_linea_negocio": lambda s, sf, f, p: lookups.business_line(f, view(s, sf, "dim_linea_negocio")),
    "lookup_categr": lambda s, sf, f, p: lookups.category(f, view(s, sf, "dim_linea_negocio")),
    "lookup_computo": lambda s, sf, f, p: lookups.computation(f, view(s, sf, "dim_linea_negocio"), view(s, sf, "tb_parametros")),
    "flag_autonomica": lambda s, sf, f, p: lookups.regional_flag(f, view(s, sf, "dim_agrup_cadenas"), p),
    "flag_forta": lambda s, sf, f, p: lookups.forta_flag(f, view(s, sf, "dim_agrup_cadenas"), p),
    "flag_boing": lambda s, sf, f, p: lookups.children_flag(f, view(s, sf, "dim_agrup_cadenas"), None, p, CHANNEL),
    "flag_campemimediaset": lambda s, sf, f, p: lookups.own_group_flags(
        f, view(s, sf, "dim_agrup_cadenas"), None, p, ("cod_fg_campemimediaset",)),
    "flag_anuncmediaset": lambda s, sf, f, p: lookups.own_group_flags(
        f, view(s, sf, "dim_agrup_cadenas"), None, p, ("cod_fg_anuncmediaset",)),
    "lookup_franja": lambda s, sf, f, p: lookups.time_band(f, _rules_table(s, sf), p),
    "lookup_target_compra": lambda s, sf, f, p: lookups.purchase_target(f, view(s, sf, "rel_campania_trgt"), p),
    "lookup_eventos": lambda s, sf, f, p: lookups.programme_event(f, view(s, sf, "tb_eventos"), p),
    "flag_filtrado": lambda s, sf, f, p: lookups.filtered_flag(f, _rules_table(s, sf)),
}


def _lookup(name: str, policy: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return LOOKUPS[name](spark, sf, market(spark, sf).select(*LOOKUP_KEYS), policy)

    return run


for _name in RULES:
    QUERIES[_name] = _lookup(_name.removesuffix("_any"), lookups.ANY if _name.endswith("_any") else lookups.LAST_ROW)
    ORACLES[_name] = _rule_sql([_name], _SRC, ", ".join(f"src.{c}" for c in LOOKUP_KEYS))


@query("label_si_no", "SELECT doc_id, toxic, CASE WHEN toxic = 1 THEN 'si' ELSE 'no' END AS nom_toxic, CASE WHEN quality = 1 THEN 'si' ELSE 'no' END AS nom_quality FROM documents LEFT JOIN labels USING (doc_id)")
def label_si_no(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", "toxic", yes_no(F.col("toxic")).alias("nom_toxic"), yes_no(F.col("quality")).alias("nom_quality"))


# -- flagship ------------------------------------------------------------------------------------------------------


def dimensions(spark: SparkSession, sf: str) -> Dimensions:
    return Dimensions(
        business_lines=view(spark, sf, "dim_linea_negocio"),
        channels=view(spark, sf, "dim_agrup_cadenas"),
        rules=_rules_table(spark, sf),
        campaign_targets=view(spark, sf, "rel_campania_trgt"),
        events=view(spark, sf, "tb_eventos"),
        parameters=view(spark, sf, "tb_parametros"),
    )


def _share(policy: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        facts = view(spark, sf, "fcts_mercado_lineal")
        share = share_table(facts, dimensions(spark, sf), policy=policy, children_channel=CHANNEL)
        return doubles(share).withColumn("fecha_dia", F.date_format("fecha_dia", "yyyy-MM-dd"))

    return run


def _share_sql(suffix: str) -> str:
    names = [
        "lookup_linea_negocio", "lookup_categr", "lookup_computo", "flag_filtrado",
        *(n + suffix for n in ("flag_autonomica", "flag_forta", "flag_boing", "flag_campemimediaset", "flag_anuncmediaset",
                               "lookup_franja", "lookup_target_compra", "lookup_eventos")),
    ]
    source = f"""market AS ({_SCAN_SQL}), daily AS ({_DAILY_SQL}),
src AS (SELECT *, CAST(epoch(CAST(fecha_dia AS TIMESTAMP)) AS BIGINT) AS t FROM daily)"""
    columns = ", ".join(f"src.{c}" for c in model.KEYS + model.MEASURES)
    inner = _rule_sql(names, source, columns, ", substring(src.fecha_dia, 1, 7) AS fecha_part")
    labels = ", ".join(
        f"CASE WHEN {c.replace('nom_', 'cod_')} = 1 THEN 'si' ELSE 'no' END AS {c}" for c in model.DERIVED if c.startswith("nom_fg")
    )
    return f"SELECT *, {labels} FROM ({inner})"


QUERIES["share_grps"], ORACLES["share_grps"] = _share(lookups.LAST_ROW), _share_sql("")
QUERIES["share_grps_any"], ORACLES["share_grps_any"] = _share(lookups.ANY), _share_sql("_any")
