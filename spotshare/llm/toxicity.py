"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every coordinate has its own learning rate, and L1 leaves most weights at exactly zero, so the model is a short list of
features and weights that is broadcast for scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from spotshare.llm.common import DIGITS, LETTERS, batch_of, byte_classes, chunks, encoded, mix, one_text, tokens

BITS = 22
SAMPLE = 12_000  # labelled rows that the weights are learned from, at most
LEAST = 5  # of these, rows that a feature must be in to get a weight
EPOCHS = 5
ALPHA, BETA, L1, L2 = 0.6, 1.0, 10.0, 1.0
_CLASSES = byte_classes(word=LETTERS + DIGITS)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and the text of each: words, neighbours, and pairs with one or two words between (skip-grams)."""
    words, owner, *_ = tokens(texts, _CLASSES)
    kinds, owners = [words], [owner]
    for gap in (1, 2, 3):
        same = owner[gap:] == owner[:-gap]
        pair = mix(words[:-gap] * np.uint64(0x9E3779B97F4A7C15) + words[gap:] + np.uint64(gap))
        kinds.append(pair[same])
        owners.append(owner[gap:][same])
    return (np.concatenate(kinds) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


@dataclass
class Weights:
    """The features that have a weight, in rising order, their weights, and the bias."""

    at: np.ndarray
    weight: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        feature, owner = features(texts)
        place = np.minimum(np.searchsorted(self.at, feature), max(0, len(self.at) - 1))
        known = self.at[place] == feature if len(self.at) else np.zeros(len(feature), dtype=bool)
        pairs = np.unique(owner[known] * (1 << BITS) + place[known])  # a feature counts once in a text
        total = self.bias + np.bincount(pairs >> BITS, weights=self.weight[pairs & (1 << BITS) - 1], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def fit(rows: Iterator[tuple[np.ndarray, float]], epochs: int = EPOCHS) -> Weights:
    """FTRL-proximal, one update for each row and coordinate; the bias has no penalty. Without rows all weights are zero."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == size, 0.0, L1)
        step = (BETA + np.sqrt(n[at])) / ALPHA + np.where(at == size, 0.0, L2)
        return np.where(np.abs(z[at]) <= l1, 0.0, (np.sign(z[at]) * l1 - z[at]) / step)

    held = list(rows)
    seen = np.zeros(size, dtype=np.int64)
    for at, _ in held:
        seen[at] += 1
    held = [(np.append(at[seen[at] >= LEAST], size), y) for at, y in held]
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for i in rng.permutation(len(held)):
            at, y = held[i]
            w = weights(at)
            error = 1 / (1 + np.exp(-np.clip(w.sum(), -60, 60))) - y
            sigma = (np.sqrt(n[at] + error * error) - np.sqrt(n[at])) / ALPHA
            z[at] += error - sigma * w
            n[at] += error * error
    w = weights(np.arange(size + 1))
    at = np.flatnonzero(w[:size])
    return Weights(at, w[at], float(w[size]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Weights:
    """Learns from at most ``sample`` rows of ``labels`` (``doc_id``, ``label``), chosen by a hash of the id.

    Features are hashed where the texts are; one task gets them (a bounded number of rows) and returns the weights that
    are not zero. Rows without id, label or document don't count; two labels of an id average. An id counts once, by the smallest
    of its texts of at most ``SAMPLE_BYTES`` bytes, so that the task's rows and bytes are both bounded.
    """
    chosen = (
        labels.where("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.float64()), ("features", pa.list_(pa.int32()))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(encoded(batch.column(2), lower=True)):
                feature, owner = features(part)
                pairs = np.unique(owner * (1 << BITS) + feature)
                ends = np.searchsorted(pairs >> BITS, np.arange(len(part) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((pairs & (1 << BITS) - 1).astype(np.int32)))
                yield batch_of(schema, doc_id=batch.column(0).slice(first, len(part)), label=batch.column(1).slice(first, len(part)), features=lists)

    found = pa.schema([("at", pa.int32()), ("weight", pa.float64())])

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column(0)[i].as_py(), y, b.column(2)[i].values.to_numpy()) for b in batches for i, y in enumerate(b.column(1).to_pylist())]
        rows.sort(key=lambda r: (r[0], r[1], len(r[2]), r[2].tobytes()))  # the result doesn't depend on the order of arrival
        model = fit((at, y) for _, y, at in rows)
        yield batch_of(found, at=np.append(model.at, -1).astype(np.int32), weight=np.append(model.weight, model.bias))

    # ``sample`` rows of two numbers: a proven bound for the broadcast
    picked = one_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id"))
    rows = (
        picked.select("doc_id", F.col("label").cast("double"), "text").mapInArrow(hashed, "doc_id long, label double, features array<int>")
        .repartition(1).mapInArrow(learned, "at int, weight double").orderBy("at").toPandas()
    )
    if not len(rows):
        return Weights(np.zeros(0, dtype=np.int64), np.zeros(0), 0.0)
    return Weights(rows["at"].to_numpy(dtype=np.int64)[1:], rows["weight"].to_numpy()[1:], float(rows["weight"][0]))


def score(docs: DataFrame, model: Weights) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) for every row; a column of that name is replaced.

    Only the whole text counts, lower-cased. NULL, empty and blank texts get the score of the bias; repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c.lower() != "toxicity"]
    at = {c: i for i, c in enumerate(docs.columns)}
    schema = StructType([*docs.select(*(f"`{c}`" for c in names)).schema.fields, StructField("toxicity", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.scores(part) for _, part in chunks(encoded(batch.column(at["text"]), lower=True))]
            column = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(at[c]) for c in names), column], names=[*names, "toxicity"])

    return docs.mapInArrow(run, schema)
