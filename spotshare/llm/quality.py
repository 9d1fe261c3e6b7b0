"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated output.

Random indexing gives every token a sparse ternary index vector; a token's context vector is the sum of the index vectors of its
neighbours over the whole corpus. Tokens share ``BUCKETS`` hashed rows, so the table of vectors has a fixed size however
large the vocabulary. Partial sums are made for each partition and added up by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from spotshare.llm.common import DIGITS, LETTERS, MARKS, batch_of, bucket_of_id, byte_classes, chunks, encoded, lean, one_text, slices, tokens

BUCKETS = 1 << 13
SIZE = 24
NONZERO = 4  # of each index vector
REACH = 2  # neighbours on each side
SAMPLE = 16_000  # labelled rows that the network is fitted on, at most
HIDDEN = 32
EPOCHS = 60
_CLASSES = byte_classes(letters=LETTERS, digits=DIGITS, marks=MARKS)


def _index_vectors() -> np.ndarray:
    rng = np.random.default_rng(7)
    vectors = np.zeros((BUCKETS, SIZE), dtype=np.float32)
    for row in vectors:
        row[rng.choice(SIZE, NONZERO, replace=False)] = rng.choice((-1.0, 1.0), NONZERO)
    return vectors


def _buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    hashes, owner, *_ = tokens(texts, _CLASSES)
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), owner


def _neighbour_sums(vectors: np.ndarray, bucket: np.ndarray, owner: np.ndarray) -> np.ndarray:
    sums = np.zeros((len(bucket), vectors.shape[1]), dtype=np.float32)
    rows = vectors[bucket]
    for step in range(1, REACH + 1):
        same = (owner[step:] == owner[:-step])[:, None]
        sums[step:] += rows[:-step] * same
        sums[:-step] += rows[step:] * same
    return sums


def context_vectors(docs: DataFrame) -> np.ndarray:
    """The context vectors of all buckets, from every text of ``docs``: sums over the corpus, scaled to unit length.

    What reaches the driver is one row for each bucket, so BUCKETS rows of SIZE numbers at most.
    """
    index = _index_vectors()
    schema = pa.schema([("bucket", pa.int32()), ("sums", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((BUCKETS, SIZE), dtype=np.float64), np.zeros(BUCKETS, dtype=bool)
        for batch in slices(batches):
            for _, part in chunks(encoded(batch.column(0))):
                bucket, owner = _buckets(part)
                if not len(bucket):
                    continue
                sums = _neighbour_sums(index, bucket, owner)
                for d in range(SIZE):
                    total[:, d] += np.bincount(bucket, weights=sums[:, d], minlength=BUCKETS)
                seen[bucket] = True
        at = np.flatnonzero(seen)
        yield batch_of(schema, bucket=at.astype(np.int32), sums=list(total[at].astype(np.float32)))

    parts = docs.select(F.col("text").cast("string")).mapInArrow(lean(run), "bucket int, sums array<float>")
    sums = parts.groupBy("bucket").agg(*(F.sum(F.col("sums")[d].cast("double")).alias(f"d{d}") for d in range(SIZE))).collect()
    vectors = np.zeros((BUCKETS, SIZE), dtype=np.float32)
    for row in sums:
        vectors[row[0]] = row[1:]
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Features of each text: mean and spread of its tokens' vectors, how far neighbours are apart, and its log length."""
    n, size = len(texts), vectors.shape[1]
    out = np.zeros((n, 3 * size + 2), dtype=np.float32)
    bucket, owner = _buckets(texts)
    if not len(bucket):
        return out
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    who, count = owner[first], np.diff(np.r_[first, len(owner)]).astype(np.float32)[:, None]
    rows = vectors[bucket]
    apart = np.zeros_like(rows)
    apart[1:] = np.abs(rows[1:] - rows[:-1]) * (owner[1:] == owner[:-1])[:, None]
    mean = np.add.reduceat(rows, first) / count
    spread = np.sqrt(np.maximum(np.add.reduceat(rows * rows, first) / count - mean * mean, 0))
    out[who, :size] = mean
    out[who, size : 2 * size] = spread
    out[who, 2 * size : 3 * size] = np.add.reduceat(apart, first) / count
    out[who, 3 * size] = np.log1p(count[:, 0])
    out[who, 3 * size + 1] = 1
    return out


@dataclass
class Network:
    """Standardised features, a hidden layer of tanh units, a logistic output divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 11) -> Network:
    """Adam on the cross entropy over four fifths of the rows; the temperature minimises it over the other fifth.

    Without rows the score is one half everywhere; with one class it tends to that class.
    """
    rng = np.random.default_rng(seed)
    size = x.shape[1]
    net = Network(np.zeros(size), np.ones(size), rng.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    if not len(x):
        return net
    order = rng.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    net.mean, net.scale = x[used].mean(0).astype(np.float64), x[used].std(0) + 1e-3
    state = [net.w1, net.b1, net.w2, np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in state]
    step = 0
    for epoch in range(EPOCHS):
        rate = 0.005 * (1 - epoch / EPOCHS) + 1e-4
        for rows in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
            a = (x[rows] - net.mean) / net.scale
            h = np.tanh(a @ state[0] + state[1])
            error = 1 / (1 + np.exp(-np.clip(h @ state[2] + state[3], -60, 60))) - y[rows]
            back = np.outer(error, state[2]) * (1 - h * h)
            grads = [a.T @ back, back.sum(0), h.T @ error, np.array([error.sum()])]
            step += 1
            for p, g, (m, v) in zip(state, grads, moments):
                g = g / len(rows) + 1e-4 * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(state[3][0])
    if len(held):
        logits = net.logits(x[held])

        def loss(t: float) -> float:
            return float(np.mean(np.logaddexp(0, -(2 * y[held] - 1) * logits / t)))

        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


def labelled_features(docs: DataFrame, labels: DataFrame, vectors, limit: int) -> DataFrame:
    """``label`` and ``features`` of up to ``limit`` labelled documents, by a hash of the id; two labels of an id average, and an id counts
    once (see ``one_text``)."""
    chosen = (
        labels.where("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    schema = pa.schema([("label", pa.float64()), ("features", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for first, part in chunks(encoded(batch.column(1))):
                yield batch_of(schema, label=batch.column(0).slice(first, len(part)), features=list(pooled(part, vectors.value)))

    # ``limit`` rows of two numbers: a proven bound for the broadcast
    picked = one_text(docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id"))
    return picked.select("label", "text").mapInArrow(lean(run), "label double, features array<float>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Vectors from all of ``docs`` and a network fitted on at most ``sample`` rows of ``labels`` (``doc_id``, ``label``)."""
    vectors = context_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    rows = labelled_features(docs, labels, shared, sample).toPandas()
    width = 3 * SIZE + 2
    x = np.stack(rows["features"].to_numpy()).astype(np.float32) if len(rows) else np.zeros((0, width), dtype=np.float32)
    y = rows["label"].to_numpy(dtype=np.float64)
    order = np.lexsort((y, *x.T))  # the fit doesn't depend on the order in which rows arrive
    return vectors, fit_network(x[order], y[order])


def score(docs: DataFrame, vectors: np.ndarray, net: Network) -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1) for every row; a column of that name is replaced.

    Only the text counts. NULL, empty and blank texts all get the score of a text without tokens; repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))
    names = [c for c in docs.columns if c.lower() != "quality_score"]
    at = {c: i for i, c in enumerate(docs.columns)}
    schema = StructType([*docs.select(*(f"`{c}`" for c in names)).schema.fields, StructField("quality_score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, network = shared.value
        for batch in slices(batches):
            scores = [network.scores(pooled(part, known)) for _, part in chunks(encoded(batch.column(at["text"])))]
            column = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(at[c]) for c in names), column], names=[*names, "quality_score"])

    return docs.mapInArrow(lean(run), schema)


def training_labels(labels: DataFrame, column: str, modulus: int, held_out: int) -> DataFrame:
    """``doc_id`` and ``label`` of the rows whose id doesn't fall into the held-out part."""
    return labels.where(bucket_of_id("doc_id", modulus) != held_out).select("doc_id", F.col(column).cast("double").alias("label"))
