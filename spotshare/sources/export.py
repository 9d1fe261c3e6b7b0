"""CSV exports: a dataset with metadata and parts, and headed batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from spotshare.functions.csvtext import csv_row
from spotshare.operators.sizing import MAX_BUNDLE_BYTES, size_repartition
from spotshare.sources import files
from spotshare.sources.metadata import dataset_metadata


def _text(spark: SparkSession, path: str) -> str | None:
    """The text stored at ``path``, None if there is none."""
    if not files.listed(spark, path):
        return None
    found = spark.read.text(path, wholetext=True).first()
    return found and found["value"].rstrip("\n")


def export_dataset(
    df: DataFrame,
    path: str,
    dataset: str,
    mode: str = "append",
    metadata: str | None = None,
    types: Mapping[str, Mapping[str, object]] | None = None,
    max_bytes: int = MAX_BUNDLE_BYTES,
    operation: str | None = None,
) -> None:
    """Metadata below ``path/metadata``, then numbered CSV parts without header below ``path/data``.

    ``operation`` (default: the mode) says below ``path/operation`` how the consumer has to apply the parts. Parts are appended
    only to parts of the same metadata. The parts count as committed when Spark has written the ``_SUCCESS`` marker next to them.
    """
    text = metadata if metadata is not None else dataset_metadata(df.schema, dataset, types)
    if mode == "append" and _text(df.sparkSession, f"{path}/metadata") not in (None, text):
        raise ValueError(f"the parts below {path} have other metadata")
    for name, value in (("metadata", text), ("operation", operation or mode)):
        df.sparkSession.range(1).select(F.lit(value).alias("value")).write.mode("overwrite").text(f"{path}/{name}")
    parts = size_repartition(df, max_bytes)
    parts.select(csv_row(parts).alias("value")).write.mode(mode).text(f"{path}/data")


def export_batches(df: DataFrame, path: str, max_bytes: int = MAX_BUNDLE_BYTES, by: str | None = None) -> None:
    """Headed CSV files of about ``max_bytes`` each, in folders ``by=<value>`` if a column is named.

    In folders a file is closed after as many rows as surely fit, by the longest row.
    """
    rows = size_repartition(df, max_bytes) if by is None else df.hint("rebalance", F.col(by))
    writer = rows.write.options(
        header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    if by is not None:
        longest = df.agg(F.max(F.octet_length(csv_row(df)))).first()[0] or 1
        writer = writer.option("maxRecordsPerFile", max(1, max_bytes // (longest + 1))).partitionBy(by)
    writer.csv(path)
