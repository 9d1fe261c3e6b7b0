"""Catalog tables: read by configured name, overwrite, append, month partitions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, config: Mapping[str, str], name: str) -> DataFrame:
    """Logical ``name`` to a table: ``config`` holds ``<name>`` as ``db.table`` or as a parquet path."""
    target = config[name]
    return spark.read.parquet(target) if "/" in target else spark.table(target)


def register_view(df: DataFrame, name: str = "fctd_share_grps") -> str:
    df.createOrReplaceTempView(name)
    return name


def save_table(
    df: DataFrame,
    table: str,
    path: str,
    mode: str = "overwrite",
    partition_by: str | None = None,
    file_format: str = "parquet",
    compression: str = "none",
    replace_partitions: bool = False,
) -> None:
    """Write ``df`` as an external table.

    Partitioned writes are rebalanced by the partition column first: adaptive execution packs small partitions
    together and splits a large one, so a month gets few right-sized files whatever its share of the rows.
    ``replace_partitions`` overwrites only the partitions present in ``df`` and keeps the others, also those of a folder that is
    not in the catalog yet; a table that is there keeps its own location.
    """
    if partition_by is not None:
        df = df.hint("rebalance", F.col(partition_by))
    writer = df.write.format(file_format).option("compression", compression)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if replace_partitions and partition_by is not None:
        spark = df.sparkSession
        known = spark.catalog.tableExists(table)
        if known:
            path = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").save(path)
        if not known:
            spark.catalog.createTable(table, path=path, source=file_format)
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
        return
    writer.option("path", path).mode(mode).saveAsTable(table)


def dataset_mode(mode: str | None, upsert: bool = False) -> str:
    """Write mode of a dataset export: the upsert flag wins, unknown modes append."""
    if upsert:
        return "upsert"
    return "overwrite" if (mode or "").lower() == "overwrite" else "append"


def object_operation(mode: str | None, upsert: bool = False) -> str:
    """Operation on a keyed object: upsert by flag, overwrite means update, anything else inserts."""
    if upsert:
        return "upsert"
    return "update" if (mode or "").lower() == "overwrite" else "insert"
