"""The share job: scan, daily aggregate, enrichment, month-partitioned table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from spotshare import model
from spotshare.functions.labels import yes_no
from spotshare.functions.temporal import current_month, day_to_timestamp, month_key
from spotshare.operators import facts as fact_ops, lookups
from spotshare.operators.conform import conform
from spotshare.plans.staging import one_plan
from spotshare.sources.tables import read_table, save_table


LOOKUP_INPUTS = [
    "fecha_dia", "cod_cadena", "nom_cadena", "cod_anuncio", "cod_anunc", "cod_anunciante_subsidiario", "cod_programa",
    "cod_tipologia", "cod_comunicacion", "duracion",
]


@dataclass(frozen=True)
class Dimensions:
    business_lines: DataFrame
    channels: DataFrame
    rules: DataFrame
    campaign_targets: DataFrame
    events: DataFrame
    parameters: DataFrame


def share_table(
    facts: DataFrame,
    dims: Dimensions,
    month: str | None = None,
    policy: str = lookups.LAST_ROW,
    children_channel: int = model.CHILDREN_CHANNEL,
    own_group: str = model.OWN_GROUP,
    order_by: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row for each day and key combination: 76 keys, 13 sums, 23 derived columns and the month.

    ``order_by`` names, by dimension, the columns by which its last row is the last (default: see ``lookups``).

    The wide rows are shuffled once, by the aggregate. The advert codes of the children channel come from their own
    narrow scan (the aggregate keeps every key, so the codes are the same), and each lookup joins a measured side.
    """
    order = order_by or {}
    scanned = fact_ops.scan_facts(facts, month)
    codes = fact_ops.codes_on_channel(scanned, children_channel)
    daily = fact_ops.daily_aggregate(scanned).withColumn("fecha_dia", day_to_timestamp(F.col("fecha_dia")))
    # The lookups read ten of the 89 columns. Packed into one struct the others cross each join as a single value.
    share = daily.select(F.struct(*model.KEYS, *model.MEASURES).alias("__fact"), *LOOKUP_INPUTS)
    with one_plan():
        share = lookups.line_columns(share, dims.business_lines, dims.parameters, order_by=order.get("business_lines"))
        share = lookups.regional_flag(share, dims.channels, policy, order_by=order.get("channels"))
        share = lookups.forta_flag(share, dims.channels, policy, order_by=order.get("channels"))
        share = lookups.children_flag(share, dims.channels, codes, policy, order_by=order.get("channels"))
        share = lookups.time_band(share, dims.rules, policy, order_by=order.get("rules"))
        share = lookups.purchase_target(share, dims.campaign_targets, policy, order.get("campaign_targets"))
        share = lookups.filtered_flag(share, dims.rules, order_by=order.get("rules"))
        share = lookups.own_group_flags(share, dims.channels, policy=policy, group=own_group, order_by=order.get("channels"))
        share = lookups.programme_event(share, dims.events, policy, order_by=order.get("events"))
    labels = {c: yes_no(F.col(c.replace("nom_fg", "cod_fg"))) for c in model.DERIVED if c.startswith("nom_fg")}
    share = share.withColumns(labels | {"fecha_part": month_key(F.col("fecha_dia"))})
    return share.select("__fact.*", *model.DERIVED, "fecha_part")


def month_argument(spark: SparkSession, month: str | None) -> str | None:
    """A ``yyyy-MM`` month, None for all days; "current" is the month of now."""
    return spark.range(1).select(current_month()).first()[0] if month == "current" else month


def run(
    spark: SparkSession,
    config: Mapping[str, str],
    month: str | None = None,
    policy: str = lookups.LAST_ROW,
    replace_partitions: bool = False,
    order_by: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Read, enrich and write the share table.

    ``config`` names the inputs as ``db.table`` or path: ``facts``, ``campaign_targets`` and the raw entities
    ``business_lines``, ``channels``, ``rules``, ``events``, ``parameters``. The outputs are ``share_table`` at
    ``share_path`` and the typed channel dimension ``channels_table`` at ``channels_path``; ``format`` and
    ``compression`` apply to both. ``month`` limits the facts (``yyyy-MM`` or "current"). With ``month`` or
    ``replace_partitions`` only the months that were computed are replaced. ``order_by`` as in ``share_table``, by typed columns.
    """
    entities = {
        "business_lines": "linea_negocio", "channels": "agrup_cadenas", "rules": "configuraciones", "events": "eventos",
        "parameters": "parametros",
    }
    typed = {name: conform(read_table(spark, config, name), entity) for name, entity in entities.items()}
    stored = {"file_format": config.get("format", "parquet"), "compression": config.get("compression", "none")}
    save_table(typed["channels"], config["channels_table"], config["channels_path"], **stored)
    dims = Dimensions(
        business_lines=typed["business_lines"],
        channels=spark.table(config["channels_table"]),
        rules=typed["rules"],
        campaign_targets=read_table(spark, config, "campaign_targets"),
        events=typed["events"],
        parameters=typed["parameters"],
    )
    share = share_table(
        read_table(spark, config, "facts"),
        dims,
        month_argument(spark, month),
        policy,
        int(config.get("children_channel", model.CHILDREN_CHANNEL)),
        config.get("own_group", model.OWN_GROUP),
        order_by,
    )
    save_table(
        share, config["share_table"], config["share_path"], partition_by="fecha_part",
        replace_partitions=replace_partitions or month is not None, **stored
    )
    return spark.table(config["share_table"])
