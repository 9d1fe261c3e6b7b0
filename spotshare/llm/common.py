"""Helpers that the operators of this subpackage share: reading, batches of texts, and vectorised hashes of byte spans."""

from __future__ import annotations

import contextlib
import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Texts are handled together up to this many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket_of_id(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; an id of NULL gives NULL."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def chunks(texts: Iterable[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``limit`` bytes together, with the index of the first."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


# Labelled texts of more bytes are not learned from; they are scored like all others.
SAMPLE_BYTES = 1 << 18


def one_text(picked: DataFrame) -> DataFrame:
    """Of labelled rows (``doc_id``, ``label``, ``text``) one for each id: its smallest text of at most SAMPLE_BYTES bytes; NULL is empty."""
    text = F.coalesce("text", F.lit(""))
    short = picked.withColumn("text", text).where(F.octet_length("text") <= SAMPLE_BYTES)
    return short.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text")).select("doc_id", "label", "text")


def _give_back() -> None:
    """Returns freed memory to the system: a worker lives on after its task, beside the executor's."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of a task, after which its worker keeps no memory that it doesn't use."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return wrapped


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of few rows: what a task makes of texts at once stays small whatever the session's batch size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encoded(column: pa.Array, lower: bool = False) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; NULL is empty."""
    values = column.to_pylist()
    if lower:
        return [b"" if v is None else v.lower().encode() for v in values]
    return [b"" if v is None else v.encode() for v in values]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1024)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if size <= 2 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[:n]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash of ``buf``, one longer than it."""
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[buf] * _powers(_INVERSE, len(buf)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of buf[start:end]; equal bytes give equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _powers(_BASE, len(sums))[starts])


def byte_classes(**members: bytes) -> np.ndarray:
    """A table of 256 classes: 0, or 1, 2, ... for the bytes of each argument in turn."""
    classes = np.zeros(256, dtype=np.uint8)
    for k, chars in enumerate(members.values(), 1):
        classes[list(chars)] = k
    return classes


LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))
SPACES = b" \t\n\r\x0b\x0c"
MARKS = bytes(b for b in range(33, 127) if b not in LETTERS + DIGITS)


def tokens(texts: list[bytes], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes of one class other than 0, over all texts: hash, index of the text, class, start and end in the text."""
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    firsts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(lengths, out=firsts[1:])
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    kinds = classes[buf]
    change = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
    starts = np.concatenate((np.zeros(1, dtype=np.int64), change))
    ends = np.concatenate((change, np.array([len(buf)], dtype=np.int64)))
    keep = kinds[starts] != 0
    starts, ends = starts[keep], ends[keep]
    owner = np.searchsorted(firsts, starts, side="right") - 1
    return span_hashes(prefix_sums(buf), starts, ends), owner, kinds[starts], starts - firsts[owner], ends - firsts[owner]


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type) for n, c in columns.items()], schema=schema
    )
