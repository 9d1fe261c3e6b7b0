"""Lookups against plain loops over the same random rows."""

import random

import pytest
from pyspark.sql import functions as F

from spotshare.operators import lookups
from spotshare.operators.intervals import last_match, resolve
from spotshare.plans import staging
from tests.test_rules import CHANNELS, EVENTS, FACT, RULES

DAY = 86400
ORIGIN = 10592 * DAY  # 1999-01-01


def random_day(rng, days=1200):
    return ORIGIN + rng.randrange(days) * DAY


def random_span(rng, days=1200):
    a = ORIGIN + rng.randrange(-50, days) * DAY + rng.choice([0, 0, 1, DAY - 1, 3600])
    return a, a + rng.choice([0, 1, DAY, 2 * DAY, rng.randrange(1, 900) * DAY, 40000 * DAY])


def maybe(rng, limit):
    return None if rng.random() < 0.08 else rng.randrange(limit)


def facts(rng, n):
    return [
        (random_day(rng), maybe(rng, 4), rng.choice(["x", "y", None]), maybe(rng, 4), maybe(rng, 4), maybe(rng, 4), 0, maybe(rng, 3), maybe(rng, 3), 5)
        for _ in range(n)
    ]


def named(schema, rows):
    names = [part.split()[0] for part in schema.split(", ")]
    return [dict(zip(names, row)) for row in rows]


def same(a, b):
    return a is not None and b is not None and a == b


def valid(fact, row):
    return row["fecha_ini"] < fact["fecha_dia"] < row["fecha_fin"]


@pytest.mark.parametrize("seed", range(3))
def test_events_equal_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(maybe(rng, 4), maybe(rng, 2), rng.randrange(99), rng.choice(["a", "b", None]), *random_span(rng), i) for i in range(40 * seed)]
    data = facts(rng, 150)
    df = spark.createDataFrame(data, FACT).withColumn("n", F.monotonically_increasing_id())
    out = lookups.programme_event(df, spark.createDataFrame(rows, EVENTS), "any").orderBy("n").collect()
    last = lookups.programme_event(df, spark.createDataFrame(rows, EVENTS), "last_row").orderBy("n").collect()
    events = named(EVENTS, rows)
    for fact, got, got_last in zip(named(FACT, data), out, last):
        hits = [e for e in events if same(e["cod_cadena"], fact["cod_cadena"]) and same(e["cod_programa"], fact["cod_programa"]) and valid(fact, e)]
        want = (hits[-1]["cod_evento"], hits[-1]["des_evento"]) if hits else (0, "")
        want_last = want if hits and hits[-1] is events[-1] else (0, "")
        if fact["cod_cadena"] is None:
            want = want_last = (None, None)
        assert (got["cod_eventos"], got["nom_eventos"]) == want
        assert (got_last["cod_eventos"], got_last["nom_eventos"]) == want_last


@pytest.mark.parametrize("seed", range(3))
def test_rules_equal_a_loop(spark, seed):
    rng = random.Random(100 + seed)
    kinds = ["Filtrar", "FILTRAR", "Otra", None]
    rows = [
        (rng.randrange(99), rng.choice(kinds), maybe(rng, 4), maybe(rng, 4), maybe(rng, 4), maybe(rng, 4), rng.choice([0, 0, None]), maybe(rng, 3),
         *random_span(rng), i)
        for i in range(30 + 30 * seed)
    ]
    data = facts(rng, 150)
    df = spark.createDataFrame(data, FACT).withColumn("n", F.monotonically_increasing_id())
    table = spark.createDataFrame(rows, RULES)
    out = lookups.time_band(lookups.filtered_flag(df, table), table, "any").orderBy("n").collect()
    for fact, got in zip(named(FACT, data), out):
        band, filtered = None, 0
        for rule in named(RULES, rows):
            if not valid(fact, rule):
                continue
            campaign = same(rule["cod_campana"], fact["cod_anuncio"])
            advertiser = same(rule["cod_anunciante_pe"], fact["cod_anunc"])
            subsidiary = same(rule["cod_anunciante_kantar"], fact["cod_anunciante_subsidiario"])
            channel = same(rule["cod_cadena"], fact["cod_cadena"])
            if rule["des_accion"] != "Filtrar" and ((campaign and advertiser) or subsidiary):
                band = rule
            programme = same(rule["cod_programa"], fact["cod_programa"]) and same(rule["cod_tipologia"], fact["cod_tipologia"])
            if (rule["des_accion"] or "").lower() == "filtrar" and channel and ((campaign and (advertiser or subsidiary)) or programme):
                filtered = 1
        codes = [fact[c] for c in ("cod_anuncio", "cod_anunc", "cod_anunciante_subsidiario")]
        nom = band["des_accion"] if band else fact["nom_cadena"]
        cod = band["cod_accion"] if band else fact["cod_cadena"]
        assert got["nom_identif_franja"] == (None if None in codes else nom)
        assert got["cod_identif_franja"] == (None if None in codes or fact["cod_cadena"] is None else cod)
        assert got["cod_fg_filtrado"] == (None if None in (*codes, fact["cod_cadena"], fact["cod_tipologia"]) else filtered)


@pytest.mark.parametrize("limit", [None, 0])
def test_keyless_flags_equal_a_loop(spark, monkeypatch, limit):
    """Every channel row counts, without a key; with and without broadcast of the side."""
    if limit is not None:
        monkeypatch.setattr(staging.join_side, "__defaults__", (limit, limit))
    rng = random.Random(7)
    rows = [(i, 30006, "MEDIASET" if i % 2 else "x", 1, *random_span(rng, 300), i) for i in range(6)]
    data = facts(rng, 200)
    df = spark.createDataFrame(data, FACT).withColumn("n", F.monotonically_increasing_id())
    table = spark.createDataFrame(rows, CHANNELS)
    out = lookups.own_group_flags(lookups.regional_flag(df, table, "any"), table, None, "any").orderBy("n").collect()
    for fact, got in zip(named(FACT, data), out):
        channels = named(CHANNELS, rows)
        own = fact["cod_cadena"] in [c["cod_cadena"] for c in channels if c["des_grupo_n1"] == "MEDIASET"]
        want = int(own and any(valid(fact, c) for c in channels))
        unknown = fact["cod_cadena"] is None
        assert got["cod_fg_campemimediaset"] == (None if unknown or fact["cod_anuncio"] is None else want)
        regional = int(any(same(c["cod_cadena"], fact["cod_cadena"]) and valid(fact, c) for c in channels))
        assert got["cod_fg_autonomica"] == (None if unknown else regional)


def test_segments_are_disjoint_and_hot_keys_stay_bounded(spark):
    """20,000 overlapping rows of one key give no more segments than the days they touch."""
    dim = spark.range(20000).selectExpr(
        "1L AS k", "id AS ord", f"{ORIGIN} + (id % 700) * {DAY} AS fecha_ini", f"{ORIGIN} + (id % 700 + 2 + id % 37) * {DAY} AS fecha_fin"
    )
    segments = resolve(dim, {"k": F.col("k")}, {"ord": F.col("ord")}).collect()
    assert len(segments) <= 2 * 740
    days = {}
    for s in segments:
        for day in range(s["__first"], s["__until"]):
            if day // 512 == s["__bucket"]:
                assert day not in days
                days[day] = s["__w"]["v"]["ord"]
    want = {}
    for i in range(20000):
        for day in range(i % 700 + 1, i % 700 + 2 + i % 37):
            want[ORIGIN // DAY + day] = i
    assert days == want


def test_null_bounds_and_times_fail_and_foreign_days_miss(spark):
    dim = spark.createDataFrame([(1, 2, None, 0)], "k BIGINT, fecha_ini BIGINT, fecha_fin BIGINT, ord INT")
    fact = spark.createDataFrame([(1, ORIGIN)], "k BIGINT, fecha_dia BIGINT")
    with pytest.raises(Exception, match="must not be null"):
        last_match(fact, dim, {"k": "k"}, {"v": F.col("ord")}, "w").collect()
    good = spark.createDataFrame([(1, ORIGIN, ORIGIN + 9 * DAY, 0)], "k BIGINT, fecha_ini BIGINT, fecha_fin BIGINT, ord INT")
    days = spark.createDataFrame([(1, d * DAY) for d in (-9000, 0, 40000)], "k BIGINT, fecha_dia BIGINT")
    assert [r["w"] for r in last_match(days, good, {"k": "k"}, {"v": F.col("ord")}, "w").collect()] == [None] * 3
    old = spark.createDataFrame([(1, -9001 * DAY, -8990 * DAY, 3)], "k BIGINT, fecha_ini BIGINT, fecha_fin BIGINT, ord INT")
    out = last_match(days, old, {"k": "k"}, {"v": F.col("ord")}, "w").collect()
    assert [r["w"] and r["w"]["v"]["v"] for r in sorted(out, key=lambda r: r["fecha_dia"])] == [3, None, None]
    noon = spark.createDataFrame([(1, ORIGIN + DAY // 2)], "k BIGINT, fecha_dia BIGINT")
    with pytest.raises(Exception, match="time of day"):
        last_match(noon, good, {"k": "k"}, {"v": F.col("ord")}, "w").collect()


def test_day_types(spark):
    """Dates, timestamps, day text and epoch seconds name the same day."""
    dim = spark.createDataFrame([(1, "2001-03-01", "2001-03-05", 7)], "k BIGINT, ini STRING, fin STRING, ord INT").selectExpr(
        "k", "to_timestamp(ini) AS fecha_ini", "to_timestamp(fin) AS fecha_fin", "ord")
    days = spark.createDataFrame([(1, "2001-03-01"), (1, "2001-03-02"), (1, "2001-03-04"), (1, "2001-03-05"), (1, None)], "k BIGINT, d STRING")
    for text in ("d", "to_date(d)", "to_timestamp(d)", "unix_seconds(to_timestamp(d))"):
        fact = days.selectExpr("k", "d", f"{text} AS fecha_dia")
        out = last_match(fact, dim, {"k": "k"}, {"v": F.col("ord")}, "w").collect()
        assert {r["d"]: r["w"] and r["w"]["v"]["v"] for r in out} == {
            "2001-03-01": None, "2001-03-02": 7, "2001-03-04": 7, "2001-03-05": None, None: None}
