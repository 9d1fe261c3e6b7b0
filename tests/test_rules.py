"""Stated cases of every rule: empty dimension, match, miss, ineligible row."""

import pytest

from spotshare.operators import lookups

DAY = 86400
T = 10650 * DAY  # a day inside the default calendar
INI, FIN = T - DAY, T + DAY
CHANNELS = "cod_cadena BIGINT, cod_grupo_n2 BIGINT, des_grupo_n1 STRING, cod_forta BIGINT, fecha_ini BIGINT, fecha_fin BIGINT, ord BIGINT"
RULES = (
    "cod_accion BIGINT, des_accion STRING, cod_anunciante_kantar BIGINT, cod_anunciante_pe BIGINT, cod_campana BIGINT, "
    "cod_cadena BIGINT, cod_programa BIGINT, cod_tipologia BIGINT, fecha_ini BIGINT, fecha_fin BIGINT, ord BIGINT"
)
EVENTS = "cod_cadena BIGINT, cod_programa BIGINT, cod_evento BIGINT, des_evento STRING, fecha_ini BIGINT, fecha_fin BIGINT, ord BIGINT"
FACT = (
    "fecha_dia BIGINT, cod_cadena BIGINT, nom_cadena STRING, cod_anuncio BIGINT, cod_anunc BIGINT, "
    "cod_anunciante_subsidiario BIGINT, cod_programa BIGINT, cod_tipologia BIGINT, cod_comunicacion BIGINT, duracion INT"
)
POLICIES = ("last_row", "any")


def fact(spark, *cases):
    """One fact row for each case, all inputs 0 unless given."""
    base = dict(fecha_dia=T, cod_cadena=0, nom_cadena="nom_cadena", cod_anuncio=0, cod_anunc=0, cod_anunciante_subsidiario=0,
                cod_programa=0, cod_tipologia=0, cod_comunicacion=0, duracion=0)
    data = [(*{**base, **case}.values(), n) for n, case in enumerate(cases)]
    return spark.createDataFrame(data, FACT + ", n INT").coalesce(1)


def rows(spark, schema, *dicts):
    names = [part.split()[0] for part in schema.split(", ")]
    base = dict(fecha_ini=INI, fecha_fin=FIN, ord=0)
    return spark.createDataFrame([tuple({**base, **d}.get(n) for n in names) for d in dicts], schema)


def values(df, *names):
    found = sorted(df.select("n", *names).collect())
    return [row[1] if len(names) == 1 else tuple(row)[1:] for row in found]


@pytest.mark.parametrize("policy", POLICIES)
def test_time_band(spark, policy):
    codes = dict(cod_accion=123, cod_anunciante_kantar=0, cod_anunciante_pe=0, cod_campana=0)

    def run(rules, *cases):
        facts = fact(spark, *[{"cod_cadena": 999, **case} for case in cases])
        return values(lookups.time_band(facts, rows(spark, RULES, *rules), policy), "cod_identif_franja", "nom_identif_franja")

    assert run([], {}) == [(0, "")]
    found = run(
        [{**codes, "des_accion": "NO ES FILTRAR"}],
        {},
        dict(cod_anuncio=1, cod_anunc=1, cod_anunciante_subsidiario=1),
        dict(cod_anunc=1, cod_anunciante_subsidiario=1),  # the campaign alone is not enough
        dict(cod_anuncio=1),  # the subsidiary alone is
        dict(cod_anunc=None),
        dict(cod_cadena=None),
    )
    hit, miss = (123, "NO ES FILTRAR"), (999, "nom_cadena")
    assert found == [hit, miss, miss, hit, (None, None), (None, "NO ES FILTRAR")]
    assert run([{**codes, "des_accion": "Filtrar"}], {}) == [(0, "")]
    # Only the exact spelling is excluded from relabelling; a missing action still relabels.
    assert run([{**codes, "des_accion": "FILTRAR"}], {}) == [(123, "FILTRAR")]
    assert run([{**codes, "des_accion": None}], {}) == [(123, None)]


@pytest.mark.parametrize("policy", POLICIES)
def test_regional_and_forta(spark, policy):
    cases = ({}, dict(cod_cadena=10), dict(cod_cadena=None))

    def run(*channels):
        channels = rows(spark, CHANNELS, *channels)
        both = lookups.forta_flag(lookups.regional_flag(fact(spark, *cases), channels, policy), channels, policy)
        return values(both, "cod_fg_autonomica", "cod_fg_forta")

    unknown = (None, None)
    assert run() == [(0, 0), (0, 0), unknown]
    assert run(dict(cod_grupo_n2=30006, cod_forta=2, cod_cadena=0)) == [(1, 0), (0, 0), unknown]
    assert run(dict(cod_grupo_n2=4000006, cod_forta=1, cod_cadena=0)) == [(0, 1), (0, 0), unknown]
    assert run(dict(cod_grupo_n2=30006, cod_forta=1, cod_cadena=None)) == [(0, 0), (0, 0), unknown]


@pytest.mark.parametrize("policy", POLICIES)
def test_own_group(spark, policy):
    codes = spark.createDataFrame([(10,), (50,), (30,)], "cod_cadena BIGINT")
    cases = (dict(cod_cadena=10), dict(cod_cadena=100), dict(cod_cadena=10, cod_anuncio=None), dict(cod_cadena=10, cod_anunciante_subsidiario=None))

    def run(*channels):
        out = lookups.own_group_flags(fact(spark, *cases), rows(spark, CHANNELS, *channels), codes, policy)
        return values(out, "cod_fg_campemimediaset", "cod_fg_anuncmediaset")

    one = dict(cod_cadena=7, des_grupo_n1="x")
    assert run() == [(-1, -1), (-1, -1), (None, -1), (-1, None)]
    assert run(one) == [(1, 1), (0, 0), (None, 1), (1, None)]
    assert run({**one, "fecha_fin": T}) == [(0, 0), (0, 0), (None, 0), (0, None)]


@pytest.mark.parametrize("policy", POLICIES)
def test_children(spark, policy):
    codes = spark.createDataFrame([(555,), (666,), (777,)], "cod_anuncio BIGINT")
    cases = (dict(cod_anuncio=555), dict(cod_anuncio=555666777), dict(cod_anuncio=None), dict(cod_anuncio=555, cod_cadena=None))

    def run(*channels):
        return values(lookups.children_flag(fact(spark, *cases), rows(spark, CHANNELS, *channels), codes, policy), "cod_fg_boing")

    assert run() == [0, 0, None, None]
    assert run(dict(cod_cadena=7)) == [1, 0, None, None]


@pytest.mark.parametrize("policy", POLICIES)
def test_purchase_target(spark, policy):
    schema = "cod_anuncio BIGINT, cod_cadena BIGINT, cod_target BIGINT, ord BIGINT"
    cases = (dict(cod_anuncio=555, cod_cadena=999), dict(cod_anuncio=555, cod_cadena=1), dict(cod_anuncio=None))

    def run(*targets):
        return values(lookups.purchase_target(fact(spark, *cases), spark.createDataFrame(targets, schema), policy), "cod_target_compra")

    assert run() == [0, 0, None]
    assert run((0, 0, 0, 0)) == [0, 0, None]
    assert run((555, 999, 888, 0)) == [888, 0, None]
    assert run((555, 999, 888, 1), (1, 1, 5, 2)) == [0 if policy == "last_row" else 888, 0, None]


def test_filtered(spark):
    zero = dict(cod_anunciante_kantar=0, cod_anunciante_pe=0, cod_campana=0, cod_cadena=0, cod_programa=0, cod_tipologia=0)

    def run(rules, *cases):
        return values(lookups.filtered_flag(fact(spark, *cases), rows(spark, RULES, *rules)), "cod_fg_filtrado")

    other = dict(cod_anuncio=555, cod_cadena=999)
    assert run([], other) == [0]
    assert run([{**zero, "des_accion": "Filtrar"}], {}, other, dict(cod_programa=None), dict(cod_tipologia=3)) == [1, 0, None, 1]
    # Spelled in another case it filters as well; another or a missing action does not.
    assert run([{**zero, "des_accion": "FILTRAR"}], {}) == [1]
    assert run([{**zero, "des_accion": "NO ES Filtrar"}, {**zero, "des_accion": None}], {}) == [0]
    advertiser = {**zero, "des_accion": "Filtrar", "cod_programa": None}
    found = run([advertiser], dict(cod_anunc=9), dict(cod_anunciante_subsidiario=9), dict(cod_anunc=9, cod_anunciante_subsidiario=9))
    assert found == [1, 1, 0]
    assert run([{**zero, "des_accion": "Filtrar", "cod_campana": None}], {}, dict(cod_tipologia=3)) == [1, 0]
    # A later row that misses does not reset the flag.
    assert run([{**zero, "des_accion": "Filtrar"}, {**advertiser, "cod_campana": 4, "ord": 9}], {}) == [1]


@pytest.mark.parametrize("policy", POLICIES)
def test_events(spark, policy):
    cases = (dict(cod_programa=888), dict(cod_programa=888999), dict(cod_programa=None))

    def run(*events):
        facts = fact(spark, *[{"cod_cadena": 999, **case} for case in cases])
        return values(lookups.programme_event(facts, rows(spark, EVENTS, *events), policy), "cod_eventos", "nom_eventos")

    one = dict(cod_cadena=999, cod_programa=888, cod_evento=1000, des_evento="BBB")
    none, unknown = (0, ""), (None, None)
    assert run() == [none, none, unknown]
    assert run(one) == [(1000, "BBB"), none, unknown]
    assert run(one, {**one, "cod_programa": 1, "ord": 5}) == [none if policy == "last_row" else (1000, "BBB"), none, unknown]


LINES = (
    "cod_tipologia BIGINT, cod_comunicacion BIGINT, cod_tp_lineanegocio_km BIGINT, nom_tp_lineanegocio_km STRING, cod_tp_categr_km BIGINT, "
    "nom_tp_categr_km STRING, cod_tp_computo_km BIGINT, nom_tp_computo_km STRING, fecha_ini BIGINT, fecha_fin BIGINT, ord BIGINT"
)


def line_row(**values):
    return dict(cod_tipologia=0, cod_comunicacion=0, cod_tp_lineanegocio_km=100, nom_tp_lineanegocio_km="GOL", cod_tp_categr_km=200,
                nom_tp_categr_km="eeee", cod_tp_computo_km=3001, nom_tp_computo_km="CONVENCIONAL") | values


def parameters(spark, limit="100", types="4;5"):
    return spark.createDataFrame([("DURACION_IIEE", limit), ("TIPOLOGIAS_DURACION", types)], "nom_param STRING, valor STRING")


def test_business_line_and_category(spark):
    # One key for each situation.
    lines = rows(
        spark, LINES,
        line_row(),
        line_row(cod_tipologia=1, fecha_ini=T), line_row(cod_tipologia=2, fecha_fin=T),  # both ends are outside
        line_row(cod_tipologia=3, fecha_ini=T - 1, fecha_fin=T + 1),
        line_row(cod_tipologia=4), line_row(cod_tipologia=4, nom_tp_lineanegocio_km=None, cod_tp_lineanegocio_km=101, ord=1),
        line_row(cod_tipologia=5), line_row(cod_tipologia=5, fecha_ini=FIN, fecha_fin=FIN + DAY, ord=1),
        line_row(cod_tipologia=None),
    )
    names = ("cod_tp_lineanegocio_km", "nom_tp_lineanegocio_km", "cod_tp_categr_km", "nom_tp_categr_km")

    def run(lines, *cases):
        return values(lookups.category(lookups.business_line(fact(spark, *cases), lines), lines), *names)

    miss, hit = (1003, "Sin Especificar", 2006, "Sin Especificar"), (100, "GOL", 200, "eeee")
    assert run(rows(spark, LINES), {}) == [miss]
    found = run(lines, *[dict(cod_tipologia=k) for k in (0, 1, 2, 3, 4, 5, 6)], dict(cod_comunicacion=1), dict(cod_comunicacion=None), dict(cod_tipologia=None))
    # The last matching row wins even with a null name; a later row that does not match changes nothing.
    assert found == [hit, miss, miss, hit, (101, None, 200, "eeee"), hit, miss, miss, (None,) * 4, (None,) * 4]


def test_computation(spark):
    lines = rows(spark, LINES, *[line_row(cod_tipologia=k) for k in (0, 4, 5)])
    cases = [dict(cod_tipologia=4, duracion=99), dict(cod_tipologia=5, duracion=100), dict(duracion=1), dict(cod_tipologia=4, duracion=None), dict(cod_tipologia=9)]
    out = lookups.computation(fact(spark, *cases), lines, parameters(spark))
    miss = (3005, "Sin Especificar")
    assert values(out, "cod_tp_computo_km", "nom_tp_computo_km") == [
        (3002, "IIEE 12'"), (3003, "IIEE 3'"), (3001, "CONVENCIONAL"), (None, None), miss]
    empty = lookups.computation(fact(spark, {}), rows(spark, LINES), parameters(spark))
    assert values(empty, "cod_tp_computo_km", "nom_tp_computo_km") == [miss]


def test_missing_parameter_fails(spark):
    lines = rows(spark, LINES, line_row())
    for bad in (parameters(spark, limit="x"), parameters(spark, types="4;x"), parameters(spark).where("nom_param <> 'DURACION_IIEE'")):
        with pytest.raises(Exception, match="missing or not numeric"):
            lookups.computation(fact(spark, {}), lines, bad).collect()


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="policy"):
        lookups.regional_flag(fact(spark, {}), rows(spark, CHANNELS), "first")
