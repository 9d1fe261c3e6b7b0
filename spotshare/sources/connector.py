"""Option-driven read and write, the entry points for jobs configured by key/value options."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from spotshare.operators import merge, paging
from spotshare.sources import dataset, options as opt, records, stored, tables
from spotshare.sources.export import export_dataset
from spotshare.sources.metadata import dataset_metadata


def load(
    spark: SparkSession, options: Mapping[str, str], schema: T.StructType | None = None, batches: DataFrame | None = None
) -> DataFrame:
    """Read records.

    Exactly one of ``recordPages`` and ``resultPages`` names the folder of pages. ``bulk=true`` reads ``recordPages``
    as CSV result batches of ``object``, where ``batches`` holds the batch states and ``pkChunking=true`` adds key
    chunks of ``chunkSize`` by ``chunkKey``. ``inferSchema``, ``dateFormat`` and ``encodeFields`` apply to the pages.
    ``committed`` names, instead of pages, the folder of a dataset with a commit log, which is read after all its uploads.
    """
    if options.get("committed") is not None:
        if options.get("recordPages") is not None or options.get("resultPages") is not None:
            raise ValueError("only one of 'committed' and pages may be specified")
        return dataset.resolved(spark, options["committed"])
    kind = opt.exactly_one(options, "recordPages", "resultPages")
    infer = opt.flag(options, "inferSchema")
    if opt.flag(options, "bulk"):
        opt.required(options, "object", "when reading result batches")
        if kind != "recordPages" or batches is None:
            raise ValueError("result batches need 'recordPages' and the table of batch states")
        rows = records.read_csv_batches(spark, options[kind], batches, schema, infer)
        if not opt.flag(options, "pkChunking"):
            return rows
        key = opt.required(options, "chunkKey", "with pkChunking")
        return paging.key_chunks(rows, key, opt.integer(options, "chunkSize", 100_000))
    field = records.PLAIN if kind == "recordPages" else records.WRAPPED
    pages = records.read_pages(spark, options[kind], field, multi_line=opt.flag(options, "multiLine"))
    return records.typed_records(
        records.flatten(pages), schema, infer, options.get("dateFormat") or None, opt.names(options, "encodeFields")
    )


def save(
    df: DataFrame, options: Mapping[str, str], mode: str | None = None, target: DataFrame | None = None
) -> DataFrame | None:
    """Write records.

    With ``dataset`` the rows go to ``path`` as CSV parts with metadata; an upsert needs ``metadata``. ``metadataConfig``, a JSON
    object of type descriptions by Spark type name, replaces built-in ones. ``commitLog=true`` makes them an upload of the commit
    log there, named by ``upload`` if it must count once, keyed by ``externalIdFieldName`` if it is an upsert. With
    ``object`` they are applied to the keyed table ``target`` and the resulting table is returned; with ``path`` and ``batch``
    they are applied in place, once, to the table stored there, which the first batch makes, kept by ``partitionBy``.
    """
    kind = opt.exactly_one(options, "dataset", "object")
    upsert = opt.flag(options, "upsert")
    key = options.get("externalIdFieldName", "Id")
    if kind == "object" and options.get("path"):
        spark, batch = df.sparkSession, opt.required(options, "batch", "when applying records to a stored table")
        stored.apply_batch(spark, options["path"], df, tables.object_operation(mode, upsert), key, batch, options.get("partitionBy"))
        return stored.read(spark, options["path"])
    if kind == "object":
        if target is None:
            raise ValueError("applying records needs the target table")
        return merge.apply(target, df, tables.object_operation(mode, upsert), key)
    if upsert and not options.get("metadata"):
        raise ValueError("metadata has to be provided for upsert")
    write_mode = tables.dataset_mode(mode, upsert)
    path = opt.required(options, "path", "when writing a dataset")
    types = json.loads(options["metadataConfig"]) if options.get("metadataConfig") else None
    if opt.flag(options, "commitLog"):
        dataset.register(df.sparkSession)
        metadata = options.get("metadata") or dataset_metadata(df.schema, options["dataset"], types)
        given = {"path": path, "operation": write_mode, "key": key, "upload": options.get("upload"), "metadata": metadata}
        df.write.format(dataset.NAME).mode("append").options(**{n: v for n, v in given.items() if v is not None}).save()
        return None
    # An upsert is resolved by its consumer, by the recorded operation; its parts are added like an append.
    export_dataset(
        df, path, options["dataset"], "overwrite" if write_mode == "overwrite" else "append", options.get("metadata"), types,
        operation=write_mode,
    )
    return None
