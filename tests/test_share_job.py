"""The whole job over raw entities, from configured inputs to the month-partitioned table."""

from pyspark.sql import functions as F

from spotshare import model
from spotshare.operators import conform
from spotshare.plans import share_job
from spotshare.plans.staging import new_folder
from workload import share
from workload.views import view

SF = "/root/testdata/sf0.001"
VIEWS = {
    "business_lines": ("dim_linea_negocio", "linea_negocio"), "channels": ("dim_agrup_cadenas", "agrup_cadenas"),
    "rules": ("tb_configuraciones", "configuraciones"), "events": ("tb_eventos", "eventos"), "parameters": ("tb_parametros", "parametros"),
}


def raw(df, entity):
    """A typed fixture table as the remote text entity it would come from."""
    columns = []
    for name in conform.ENTITIES[entity].columns:
        value = F.lit(None).cast("string")
        if name in df.columns:
            value = F.col(name).cast("string")
            if name.startswith("fecha_"):
                value = F.date_format(F.timestamp_seconds(name), "yyyy-MM-dd'T'00:00:00.000'Z'")
        elif name.startswith("fecha_"):
            value = F.lit("2000-01-01")
        columns.append(value.alias(name.upper() + "__c"))
    return df.select(*columns)


def test_job(spark):
    folder = new_folder(spark, "job")
    config = {
        "share_table": "fctd_share_grps", "share_path": f"{folder}/share", "channels_table": "dim_agrup_cadenas",
        "channels_path": f"{folder}/typed_channels", "children_channel": "3", "facts": f"{folder}/facts", "campaign_targets": f"{folder}/targets",
    }
    facts = view(spark, SF, "fcts_mercado_lineal")
    facts.write.parquet(config["facts"])
    view(spark, SF, "rel_campania_trgt").write.parquet(config["campaign_targets"])
    for name, (source, entity) in VIEWS.items():
        config[name] = f"{folder}/{name}"
        raw(view(spark, SF, source), entity).write.parquet(config[name])
    spark.sql("DROP VIEW IF EXISTS fctd_share_grps")
    written = share_job.run(spark, config)
    assert written.columns == model.KEYS + model.MEASURES + model.DERIVED + ["fecha_part"]
    want = share_job.share_table(facts, share.dimensions(spark, SF), children_channel=3)
    # Entities carry no order column, so of several valid rows another one may be last; the flags cannot differ.
    flags = [c for c in model.DERIVED if "fg_" in c] + ["fecha_part"]
    assert sorted(written.groupBy(*flags).count().collect(), key=str) == sorted(want.groupBy(*flags).count().collect(), key=str)
    assert spark.table("dim_agrup_cadenas").count() == view(spark, SF, "dim_agrup_cadenas").count()
    for name in ("fctd_share_grps", "dim_agrup_cadenas"):
        spark.sql(f"DROP TABLE {name}")


def test_current_month(spark):
    assert share_job.month_argument(spark, "2019-02") == "2019-02"
    assert share_job.month_argument(spark, None) is None
    assert len(share_job.month_argument(spark, "current")) == 7
