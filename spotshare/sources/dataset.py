"""A Spark data source for datasets of numbered CSV parts with a commit log.

``spark.read.format("spotshare")`` and ``df.write.format("spotshare")`` once ``register`` was called. A write is an upload: every
task writes its rows as parts of bounded size and reports them; the commit numbers the parts and writes one manifest, last, that
names their files, rows, bytes and checksums and the operation. Parts without a manifest are never seen. A failed write leaves a
record of which tasks had an outcome. Reads plan tasks over the parts that count, hold each part against its checksum, and can
leave out parts by the bounds of their columns. Filters come as an option, because Spark keeps those it pushes to such a source
for later queries of the same frame, which then lose rows.
"""

from __future__ import annotations

import io
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv, fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from spotshare.operators.sizing import MAX_BUNDLE_BYTES
from spotshare.plans.staging import join_side
from spotshare.sources.metadata import dataset_metadata

NAME = "spotshare"
TASK_BYTES = 128 * 1024 * 1024
OPERATIONS = ("append", "overwrite", "upsert")
# Where a row stands, for those who ask with the option ``positions``.
POSITION = T.StructType().add("__upload", "integer").add("__part", "integer").add("__row", "long")
_LONGEST_BOUND = 64


def _store(path: str) -> tuple[fs.FileSystem, str]:
    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, root.rstrip("/")


def _json_files(path: str, folder: str) -> list[dict]:
    system, root = _store(path)
    found = system.get_file_info(fs.FileSelector(f"{root}/{folder}", allow_not_found=True))
    out = []
    for name in sorted(f.path for f in found if f.path.endswith(".json")):
        with system.open_input_stream(name) as stream:
            out.append(json.loads(stream.read()))
    return out


def _put_json(path: str, name: str, value: dict) -> None:
    system, root = _store(path)
    system.create_dir(f"{root}/{name.rpartition('/')[0]}")
    # written beside its place and renamed, so that no reader sees a half of it
    half = f"{root}/{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(half) as out:
        out.write(json.dumps(value).encode())
    system.move(half, f"{root}/{name}")


def manifests(path: str) -> list[dict]:
    """The commits of a dataset in their order."""
    return _json_files(path, "log")


def live(path: str) -> list[dict]:
    """The commits from the last overwrite on."""
    found = manifests(path)
    last = max((i for i, m in enumerate(found) if m["operation"] == "overwrite"), default=0)
    return found[last:]


# -- writing -----------------------------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    """The outcome of a task: its number, and a description of each part that it wrote."""

    task: int
    parts: list[dict]


def _lines(batch: pa.RecordBatch) -> bytes:
    out = io.BytesIO()
    csv.write_csv(batch, out, csv.WriteOptions(include_header=False, quoting_style="needed"))
    return out.getvalue()


def _bounds(batch: pa.RecordBatch, into: dict[str, list]) -> None:
    """Widens the least and greatest values of the columns that have short ones."""
    for name, column in zip(batch.schema.names, batch.columns):
        kind = column.type
        if not (pa.types.is_integer(kind) or pa.types.is_string(kind)) or into.get(name, ()) is None or column.null_count == len(column):
            continue
        low, high = (v.as_py() for v in pc.min_max(column).values())
        if isinstance(high, str) and max(len(low), len(high)) > _LONGEST_BOUND:
            into[name] = None
        elif name in into:
            into[name] = [min(low, into[name][0]), max(high, into[name][1])]
        else:
            into[name] = [low, high]


class DatasetWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: T.StructType, overwrite: bool):
        if "path" not in options:
            raise ValueError("a dataset needs a path")
        self.path, self.schema = options["path"], schema
        self.operation = options.get("operation", "overwrite" if overwrite else "append")
        if self.operation not in OPERATIONS:
            raise ValueError(f"operation must be one of {OPERATIONS}, not {self.operation!r}")
        self.key = options.get("key")
        if self.operation == "upsert" and self.key not in schema.names:
            raise ValueError("an upsert needs the 'key' column of its records")
        self.upload = options.get("upload") or uuid.uuid4().hex
        self.folder = f"uploads/{self.upload}/{uuid.uuid4().hex}"  # of this attempt alone
        self.metadata = options.get("metadata") or dataset_metadata(schema, options.get("dataset", "dataset"))
        self.max_bytes = int(options.get("maxbytes", MAX_BUNDLE_BYTES))
        earlier = live(self.path)
        known = T.StructType.fromJson(json.loads(earlier[-1]["schema"])) if earlier else schema
        if self.operation != "overwrite" and known.simpleString() != schema.simpleString():
            raise ValueError(f"the dataset below {self.path} has other columns")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _store(self.path)
        task, parts = TaskContext.get().partitionId(), []
        held, size, rows, bounds = [], 0, 0, {}
        system.create_dir(f"{root}/{self.folder}")

        def flush() -> None:
            nonlocal held, size, rows, bounds
            if not rows:
                return
            data, name = b"".join(held), f"{self.folder}/{task:06d}-{len(parts):06d}-{uuid.uuid4().hex}.csv"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            parts.append({"file": name, "rows": rows, "bytes": size, "crc": zlib.crc32(data),
                          "bounds": {c: b for c, b in bounds.items() if b is not None}})
            held, size, rows, bounds = [], 0, 0, {}

        def add(batch: pa.RecordBatch) -> None:
            """Rows are halved until they fit; a part is over the bound only if it is one row."""
            nonlocal size, rows
            data = _lines(batch)
            if size + len(data) > self.max_bytes and batch.num_rows > 1:
                half = batch.num_rows // 2
                add(batch.slice(0, half))
                add(batch.slice(half))
                return
            if size + len(data) > self.max_bytes:
                flush()
            held.append(data)
            size += len(data)
            rows += batch.num_rows
            _bounds(batch, bounds)

        try:
            for batch in iterator:
                if batch.num_rows:
                    add(batch)
            flush()
        except BaseException:
            for part in parts:
                system.delete_file(f"{root}/{part['file']}")
            raise
        return Written(task, parts)

    def commit(self, messages: list[Written | None]) -> None:
        earlier = manifests(self.path)
        done = sorted((m for m in messages if m is not None), key=lambda m: m.task)
        if any(m["upload"] == self.upload for m in earlier):
            self._remove()  # this upload counts already
            return
        parts = [p for m in done for p in m.parts]
        number = earlier[-1]["number"] + 1 if earlier else 1
        _put_json(self.path, f"log/{number:08d}-{self.upload}.json", {
            "number": number, "upload": self.upload, "operation": self.operation, "key": self.key, "schema": T.StructType([T.StructField(f.name, f.dataType) for f in self.schema.fields]).json(),
            "metadata": self.metadata, "parts": [{"number": i, **p} for i, p in enumerate(parts, 1)],
            "tasks": [{"task": m.task, "ok": True, "rows": sum(p["rows"] for p in m.parts)} for m in done]})

    def abort(self, messages: list[Written | None]) -> None:
        """Records the outcomes; tasks that Spark has no word of have failed, if there are none at all the write itself has."""
        self._remove()
        known = {m.task: m for m in messages if m is not None}
        tasks = [{"task": i, "ok": i in known, "rows": sum(p["rows"] for p in known[i].parts) if i in known else 0} for i in range(len(messages))]
        if all(t["ok"] for t in tasks):
            tasks.append({"task": None, "ok": False, "rows": 0})
        _put_json(self.path, f"failed/{self.upload}-{uuid.uuid4().hex}.json", {"upload": self.upload, "operation": self.operation, "tasks": tasks})

    def _remove(self) -> None:
        system, root = _store(self.path)
        if system.get_file_info(f"{root}/{self.folder}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.folder}")


# -- reading -----------------------------------------------------------------------------------------------------------


@dataclass
class Parts(InputPartition):
    """Neighbouring parts that one task reads."""

    parts: list[tuple[int, dict]]


class DatasetReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.path, self.schema = options["path"], schema
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))
        self.between: dict[str, list] = json.loads(options.get("between", "{}"))

    def partitions(self) -> list[Parts]:
        tasks, size = [Parts([])], 0
        for manifest in live(self.path):
            for part in manifest["parts"]:
                if not self._may_hold(part["bounds"]):
                    continue
                if tasks[-1].parts and size + part["bytes"] > self.task_bytes:
                    tasks.append(Parts([]))
                    size = 0
                tasks[-1].parts.append((manifest["number"], part))
                size += part["bytes"]
        return tasks

    def _may_hold(self, bounds: dict[str, list]) -> bool:
        for name, (low, high) in self.between.items():
            if name in bounds and (low is not None and bounds[name][1] < low or high is not None and bounds[name][0] > high):
                return False
        return True

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        system, root = _store(self.path)
        wanted = to_arrow_schema(self.schema)
        own = [f for f in wanted if f.name not in POSITION.names]
        options = csv.ConvertOptions(column_types={f.name: f.type for f in own}, strings_can_be_null=True, quoted_strings_can_be_null=False)
        for upload, part in partition.parts:
            with system.open_input_stream(f"{root}/{part['file']}") as stream:
                data = stream.read()
            if len(data) != part["bytes"] or zlib.crc32(data) != part["crc"]:
                raise ValueError(f"part {part['number']} of upload {upload} below {self.path} is not what was committed")
            rows = csv.read_csv(
                io.BytesIO(data), csv.ReadOptions(column_names=[f.name for f in own], block_size=len(data) + 1),
                csv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False), options)
            if rows.num_rows != part["rows"]:
                raise ValueError(f"part {part['number']} of upload {upload} below {self.path} has not its number of rows")
            first = 0
            for batch in rows.to_batches(max_chunksize=8192):
                n = batch.num_rows
                place = {"__upload": pa.array([upload] * n, pa.int32()), "__part": pa.array([part["number"]] * n, pa.int32()),
                         "__row": pa.array(range(first, first + n), pa.int64())}
                first += n
                columns = [place[f.name] if f.name in place else batch.column(f.name).cast(f.type) for f in wanted]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)


class DatasetSource(DataSource):
    """Options: ``path``; to write, ``operation`` (default: the mode), ``key`` of an upsert, ``upload`` (a name under which a write
    counts once), ``dataset`` or ``metadata``, ``maxBytes`` of a part; to read, ``positions`` (adds where a row stands),
    ``taskBytes``, ``between`` (see ``rows_between``)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        commits = live(self.options["path"])
        if not commits:
            raise ValueError(f"no dataset is committed below {self.options['path']}")
        own = T.StructType.fromJson(json.loads(commits[-1]["schema"]))
        return T.StructType(own.fields + POSITION.fields) if self.options.get("positions") == "true" else own

    def _lowered(self) -> dict[str, str]:
        return {name.lower(): value for name, value in self.options.items()}

    def reader(self, schema: T.StructType) -> DatasetReader:
        return DatasetReader(self._lowered(), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DatasetWriter:
        return DatasetWriter(self._lowered(), schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DatasetSource)


# -- whole datasets ----------------------------------------------------------------------------------------------------


def rows_between(spark: SparkSession, path: str, column: str, low=None, high=None) -> DataFrame:
    """The rows whose ``column``, of integers or text, lies between the bounds, which belong to them; None leaves a side open.

    Parts whose least and greatest values show that they hold no such row are not planned. For datasets without upserts.
    """
    register(spark)
    if any(m["operation"] == "upsert" for m in live(path)):
        raise ValueError(f"the rows below {path} have to be resolved")
    rows = spark.read.format(NAME).options(path=path, between=json.dumps({column: [low, high]})).load()
    value = F.col(f"`{column}`")
    inside = value.isNotNull()
    inside = inside if low is None else inside & (value >= low)
    return rows.where(inside if high is None else inside & (value <= high))


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a dataset after all its commits.

    An overwrite starts anew, an append adds rows. An upsert replaces all earlier rows of its keys, appended ones too; of equal
    keys in it the last row counts. A NULL key replaces nothing.
    """
    register(spark)
    commits = live(path)
    upserts = [m["number"] for m in commits if m["operation"] == "upsert"]
    rows = spark.read.format(NAME).options(path=path, positions="true").load()
    own = [c for c in rows.columns if c not in POSITION.names]
    if upserts:
        keys = {m["key"] for m in commits if m["operation"] == "upsert"}
        if len(keys) > 1:
            raise ValueError(f"the upserts below {path} have different keys {sorted(keys)}")
        key, place = keys.pop(), F.struct("__upload", "__part", "__row")
        last = rows.where(F.col("__upload").isin(upserts) & F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("__key")).agg(
            F.max(place).alias("__last"))
        rows = rows.join(join_side(last), F.col(f"`{key}`") == F.col("__key"), "left")
        rows = rows.where(F.col("__last").isNull() | (F.col("__upload") > F.col("__last.__upload")) | (place == F.col("__last")))
    return rows.select(*(F.col(f"`{c}`") for c in own))


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """``upload, committed, task, ok, rows``: the outcome of each task of each upload, failed ones too."""
    found = [(m["upload"], True, t["task"], t["ok"], t["rows"]) for m in manifests(path) for t in m["tasks"]]
    found += [(m["upload"], False, t["task"], t["ok"], t["rows"]) for m in _json_files(path, "failed") for t in m["tasks"]]
    return spark.createDataFrame(found, "upload STRING, committed BOOLEAN, task INT, ok BOOLEAN, rows BIGINT")


def verdicts(spark: SparkSession, path: str) -> DataFrame:
    """One row for each upload: whether it is committed, and the fold of its tasks' outcomes; a task without rows is no failure."""
    return outcomes(spark, path).groupBy("upload").agg(
        F.bool_or("committed").alias("committed"), F.bool_and(F.col("ok") | F.col("committed")).alias("ok"),
        F.coalesce(F.sum(F.when(F.col("committed"), F.col("rows"))), F.lit(0)).alias("n_rows"))
