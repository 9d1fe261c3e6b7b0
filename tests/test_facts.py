import pytest
from pyspark.sql import functions as F

from spotshare import model
from spotshare.functions.labels import yes_no
from spotshare.functions.temporal import current_month, day_to_timestamp, epoch_seconds, month_key
from spotshare.operators import facts, params
from spotshare.plans.share_job import Dimensions, share_table
from workload import share
from workload.views import view

SF = "/root/testdata/sf0.001"
SCOPE = "dia_progrmd STRING, nom_sect_geog STRING, cod_target BIGINT"


def test_model_widths():
    assert (len(model.KEYS), len(model.MEASURES), len(model.DERIVED)) == (76, 13, 23)
    assert len(set(model.KEYS + model.MEASURES + model.DERIVED)) == 112


def test_market_scope(spark):
    rows = [
        ("1999-01-01", "NAC", 5), ("2099-01-31 23:59:59", "NAC", 3), ("2099-01-31", "NAC", 2), ("2010-05-05", "NAC", 5),
        ("1998-12-31", "NAC", 5), ("2099-02-01", "NAC", 5), ("2010-05-05", "PBC", 5), ("2010-05-05", None, 5),
        ("2010-05-05", "NAC", 4), ("2010-05-05", "NAC", None), (None, "NAC", 5),
    ]
    kept = facts.market_scope(spark.createDataFrame(rows, SCOPE)).collect()
    assert sorted(tuple(r) for r in kept) == sorted(rows[:4])


def test_scope_on_dates_and_months(spark):
    rows = spark.createDataFrame(
        [("1999-01-01",), ("2010-02-28",), ("2010-02-28 10:00:00",), ("2010-03-01",), ("2010-01-31",)], "d STRING")
    for kind in ("d", "to_date(d)", "to_timestamp(d)"):
        typed = rows.selectExpr(f"{kind} AS dia_progrmd")
        assert facts.process_month(typed, "2010-02").count() == 2


def test_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.createDataFrame([("2010-05-05", "NAC", 5)], SCOPE).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = facts.market_scope(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    for part in ("GreaterThanOrEqual(dia_progrmd,1999-01-01)", "LessThan(dia_progrmd,2099-01-32)", "In(cod_target", "Not(EqualTo(nom_sect_geog,PBC))"):
        assert part in pushed


def test_scan_and_aggregate(spark):
    source = view(spark, SF, "fcts_mercado_lineal")
    scanned = facts.scan_facts(source)
    assert scanned.columns == model.KEYS + model.MEASURES
    first = scanned.first()
    assert (first["des_programa"], first["cod_programa"], first["fecha_dia"]) == ("", 0, first["dia_progrmd"])
    daily = facts.daily_aggregate(scanned)
    assert daily.columns == model.KEYS + model.MEASURES
    total, rows = scanned.agg(F.sum("cant_pases"), F.count("*")).first()
    assert daily.agg(F.sum("cant_pases")).first()[0] == total == rows
    assert daily.count() < rows
    month = first["fecha_dia"][:7]
    days = facts.scan_facts(source, month).select("fecha_dia").distinct().collect()
    assert {r[0][:7] for r in days} == {month}


def test_days(spark):
    rows = spark.createDataFrame([("2019-01-05 10:11:12",), ("2019-01-05",), ("",), ("n/a",), (None,)], "d STRING")
    out = rows.select(day_to_timestamp(F.col("d")).alias("t")).select(epoch_seconds(F.col("t")), month_key(F.col("t"))).collect()
    assert [tuple(r) for r in out] == [(1546646400, "2019-01")] * 2 + [(None, None)] * 3


def test_current_month(spark):
    out = spark.range(1).select(current_month(), F.expr("date_format(from_utc_timestamp(now(), 'Europe/Madrid'), 'yyyy-MM')")).first()
    assert out[0] == out[1]


def test_labels(spark):
    rows = spark.createDataFrame([(0,), (1,), (None,)], "c INT")
    assert [r[0] for r in rows.select(yes_no(F.col("c"))).collect()] == ["no", "si", "no"]


def test_parameters(spark):
    table = spark.createDataFrame([("P", "7", 2), ("P", "5", 1), ("L", "4;x;5", 1)], "nom_param STRING, valor STRING, ord INT")
    assert params.parameter(table, "P", ["ord"]).first()[0] == "5"
    assert params.parameter(table, "absent").collect() == [(None,)]
    listed = params.parameter(table, "L").select(params.as_int_list(F.col("valor"))).first()[0]
    assert listed == [4, None, 5]


@pytest.mark.parametrize("policy", ["last_row", "any"])
def test_share_table_shape_and_plan(spark, policy):
    dims = share.dimensions(spark, SF)
    out = share_table(view(spark, SF, "fcts_mercado_lineal"), dims, policy=policy, children_channel=3)
    assert out.columns == model.KEYS + model.MEASURES + model.DERIVED + ["fecha_part"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("PythonUDF", "ArrowEval", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert unwanted not in plan
    # One exchange of the wide rows: the aggregate's. Everything else is a scalar or a measured broadcast.
    assert plan.count("hashpartitioning(fecha_dia") == 1
    kinds = dict(out.dtypes)
    assert kinds["cod_fg_autonomica"] == "int" and kinds["cod_fg_filtrado"] == "bigint" and kinds["cod_tp_computo_km"] == "bigint"
    daily = facts.daily_aggregate(facts.scan_facts(view(spark, SF, "fcts_mercado_lineal")))
    assert out.count() == daily.count()


def test_share_table_with_empty_dimensions(spark):
    dims = share.dimensions(spark, SF)
    none = Dimensions(*[d.limit(0) for d in (dims.business_lines, dims.channels, dims.rules, dims.campaign_targets, dims.events)], dims.parameters)
    out = share_table(view(spark, SF, "fcts_mercado_lineal").limit(500), none)
    found = out.where("cod_comunicacion IS NOT NULL AND cod_anunc IS NOT NULL").select(*model.DERIVED).distinct().collect()
    assert [tuple(r) for r in found] == [(
        1003, "Sin Especificar", 2006, "Sin Especificar", 0, "no", 0, "no", 0, "no", 0, "", 0, 0, "no", -1, "no", 3005,
        "Sin Especificar", 0, "", -1, "no")]
