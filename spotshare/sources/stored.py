"""Keyed tables that are kept in partitions: batches of records are inserted, updated or upserted in place.

A table is a folder of Parquet files in folders ``<column>=<value>`` with its schema beside them. A batch rewrites only the
partitions that hold one of its keys or take one of its rows. Its result is staged first; then a plan names the files that it
replaces; then the new files are renamed into the table, under names that carry the batch, and the old ones deleted; then the
batch is marked as done. A batch that failed at any point is taken up there by giving it again; one that is done does nothing.
Batches of one table come one after the other, and a reader between the plan and the mark may see a part of a batch.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from spotshare.operators import merge
from spotshare.sources import files

# A batch names its partitions in a filter; so many are few enough for a plan.
MAX_PARTITIONS = 10_000


def _schema_file(path: str) -> str:
    return f"{path}/_schema"


def create(spark: SparkSession, path: str, schema: T.StructType, partition_by: str) -> None:
    """An empty table; its columns are all nullable and stay as they are."""
    if partition_by not in schema.names:
        raise ValueError(f"no column {partition_by} to keep the table by")
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    files.put_text(spark, _schema_file(path), json.dumps({"partition_by": partition_by, "schema": T.StructType(fields).jsonValue()}))


def _described(spark: SparkSession, path: str) -> tuple[T.StructType, str] | None:
    text = files.text_of(spark, _schema_file(path))
    if text is None:
        return None
    stated = json.loads(text)
    return T.StructType.fromJson(stated["schema"]), stated["partition_by"]


def read(spark: SparkSession, path: str) -> DataFrame:
    found = _described(spark, path)
    if found is None:
        raise ValueError(f"no table below {path}")
    return spark.read.schema(found[0]).parquet(path) if files.listed(spark, path) else spark.createDataFrame([], found[0])


def _values(df: DataFrame, column: str) -> list:
    """The different values of a column, of which there must not be too many."""
    found = [row[0] for row in df.select(F.col(column)).distinct().limit(MAX_PARTITIONS + 1).collect()]
    if len(found) > MAX_PARTITIONS:
        raise ValueError(f"a batch may touch {MAX_PARTITIONS} partitions at most")
    return found


def _among(column: str, values: list) -> Column:
    inside = F.col(column).isin([v for v in values if v is not None])
    return inside | F.col(column).isNull() if None in values else inside


def _touched(table: DataFrame, source: DataFrame, operation: str, key: str, kept_by: str, located: bool) -> list:
    """The partitions whose rows a batch changes, or that take rows of it."""
    placed = kept_by in source.columns
    own = _values(source, kept_by) if placed and (located or operation == "upsert") else []
    if located:
        return own
    # the key and the partition are all that is read of the table
    hits = table.select(key, F.col(kept_by).alias("__old")).join(
        source.select(key, *([F.col(kept_by).alias("__new")] if placed else [])), key)
    found = set(own) | set(_values(hits, "__old"))
    return list(found | set(_values(hits, "__new")) if placed else found)


def apply_batch(
    spark: SparkSession, path: str, source: DataFrame, operation: str, key: str, batch: str, partition_by: str | None = None,
    located: bool = False,
) -> bool:
    """Applies the records of ``source`` to the table below ``path`` once, and says whether this call did it.

    ``operation`` is insert, update or upsert by ``key``, as in ``merge``: source keys must be unique for the latter two, columns
    that the source lacks keep their values, a row whose partition column changes moves. ``batch`` names the batch; the source of a
    batch that is given again is not read once it is staged. Without a table the first insert or upsert creates one, kept by
    ``partition_by``. With ``located`` the source names the partition in which each of its keys lies, or will, so that the table
    is read in these alone. A column that the table lacks is an error, values are cast to its types.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.-]*", batch):
        raise ValueError("a batch is named by letters, digits, dots and dashes")
    if operation not in ("insert", "update", "upsert"):
        raise ValueError(f"operation must be insert, update or upsert, not {operation!r}")
    state = f"{path}/_batches/{batch}"
    if files.exists(spark, f"{state}/done"):
        return False
    if files.text_of(spark, f"{state}/plan") is None:
        _stage(spark, path, state, source, operation, key, partition_by, located)
    _swap(spark, path, state, batch)
    files.put_text(spark, f"{state}/done", "")
    return True


def _stage(spark: SparkSession, path: str, state: str, source: DataFrame, operation: str, key: str, partition_by: str | None, located: bool) -> None:
    files.delete(spark, state)  # what an earlier call of this batch left before it had a plan
    found = _described(spark, path)
    if found is None:
        if operation == "update" or partition_by is None:
            raise ValueError(f"no table below {path} to {operation}")
        create(spark, path, source.schema, partition_by)
        found = _described(spark, path)
    schema, kept_by = found
    if partition_by not in (None, kept_by):
        raise ValueError(f"the table is kept by {kept_by}, not by {partition_by}")
    kinds = {f.name: f.dataType for f in schema.fields}
    if unknown := [c for c in source.columns if c not in kinds]:
        raise ValueError(f"the table has no columns {unknown}")
    if operation != "insert" and key not in source.columns:
        raise ValueError(f"the records have no key {key}")
    if kept_by not in source.columns and (operation != "update" or located):
        raise ValueError(f"the records do not say which {kept_by} they belong to")
    source = source.select(*(F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in source.columns))
    replaced: list[str] = []
    if operation == "insert":
        result = spark.createDataFrame([], schema).unionByName(source, allowMissingColumns=True)
    else:
        table = read(spark, path)
        touched = _touched(table, source, operation, key, kept_by, located)
        rows = table.where(_among(kept_by, touched))
        if files.listed(spark, path):
            names = rows.select("_metadata.file_path").distinct().collect()
            replaced = [files.below(spark, path, files.of_uri(spark, row[0])) for row in names]
        result = merge.apply(rows, source, operation, key)
    result.select(*schema.names).hint("rebalance", F.col(kept_by)).write.partitionBy(kept_by).parquet(f"{state}/rows")
    files.put_text(spark, f"{state}/plan", json.dumps({"operation": operation, "replaced": replaced}))


def _swap(spark: SparkSession, path: str, state: str, batch: str) -> None:
    """Moves the staged files into the table, then deletes those they replace; what is done already is left out."""
    staged = f"{state}/rows"
    for file in files.listed(spark, staged):
        folder, _, name = files.below(spark, staged, file).rpartition("/")
        files.move(spark, file, f"{path}/{folder}/{batch}_{name}")
    for name in json.loads(files.text_of(spark, f"{state}/plan"))["replaced"]:
        files.delete(spark, f"{path}/{name}")
    files.delete(spark, staged)


def batches(spark: SparkSession, path: str) -> dict[str, str]:
    """The operations of the batches that are done."""
    folder = f"{path}/_batches"
    done = [files.below(spark, folder, f).rpartition("/")[0] for f in files.listed(spark, folder) if f.endswith("/done")]
    return {batch: json.loads(files.text_of(spark, f"{folder}/{batch}/plan"))["operation"] for batch in done}
