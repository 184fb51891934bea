"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct hashes of its words, of its pairs of
neighbouring words, and of its pairs with one word between. Training keeps a
learning rate for each coordinate, and the L1 term leaves most weights at
exactly zero, so that the model is a short sorted list of slots and weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .text import blobs, slices, words

#: Documents that a model learns from at most, chosen by a hash of their id.
SAMPLE = 16_000
_CACHED = 100_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class Features:
    """Word n-gram and skip-gram slots of texts; remembers the hashes of words up to a bound."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        """Slots with repeats, in no order. None and texts without words have none."""
        found = words(text)
        if not found:
            return np.empty(0, np.int64)
        if len(self.known) > _CACHED:
            self.known.clear()
        known = self.known
        for w in set(found).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        one = h * _A
        two = (h[:-1] * _B + (h[1:] ^ (h[1:] >> np.uint64(29)))) * _A
        skip = (h[:-2] * _C + (h[2:] ^ (h[2:] >> np.uint64(31)))) * _B
        return (np.concatenate([one, two, skip]) >> self.shift).astype(np.int64)


@dataclass
class Model:
    """Slots in ascending order with their weights, and the weight that every text has."""

    bits: int
    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        """A function from a text's bytes to the probability that it is toxic."""
        features, bitmap = Features(self.bits), np.zeros(1 << self.bits, bool)
        bitmap[self.slots] = True

        def score(text: bytes | None) -> float:
            got = features(text)
            got = np.unique(got[bitmap[got]])
            z = self.bias + float(self.weights[np.searchsorted(self.slots, got)].sum()) if len(got) else self.bias
            return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))

        return score


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int = 24, alpha: float = 1.0, beta: float = 1.0, l1: float = 5.0, l2: float = 0.0, epochs: int = 5) -> Model:
    """Fit on (distinct slots, label) rows in the given order, ``epochs`` times over; ``rows`` is used up.

    A gradient is below 1, so a slot that ``l1 / epochs`` rows or fewer have
    never gets a weight. Such slots are left out before training, and the
    others are numbered, so memory follows what can matter.
    """
    seen = np.zeros(1 << bits, np.uint8)
    for slots, _ in rows:
        seen[slots] += seen[slots] < 255
    live = np.flatnonzero(seen > l1 / epochs).astype(np.int32)
    # Few large arrays, not one a row: those go back to the system when they are freed.
    sizes = [int((seen[slots] > l1 / epochs).sum()) for slots, _ in rows]
    packed, at = np.empty(sum(sizes), np.int32), 0
    for i, (slots, label) in enumerate(rows):
        packed[at : at + sizes[i]] = np.searchsorted(live, slots[seen[slots] > l1 / epochs])
        rows[i] = packed[at : at + sizes[i]], label
        at += sizes[i]
    del seen
    z, n = np.zeros(len(live), np.float32), np.zeros(len(live), np.float32)
    zb = nb = 0.0

    def weights(slots: np.ndarray) -> np.ndarray:
        a = z[slots]
        return np.where(np.abs(a) <= l1, np.float32(0), -(a - np.sign(a) * np.float32(l1)) / ((beta + np.sqrt(n[slots])) / alpha + l2))

    def bias() -> float:
        return -zb / ((beta + nb**0.5) / alpha)

    for _ in range(epochs):
        for slots, label in rows:
            w, wb = weights(slots), bias()
            p = 1 / (1 + np.exp(-np.clip(wb + float(w.sum()), -35, 35)))
            g = np.float32(p - label)
            old = n[slots]
            new = old + g * g
            z[slots] += g - (np.sqrt(new) - np.sqrt(old)) / np.float32(alpha) * w
            n[slots] = new
            zb += float(g) - ((nb + float(g) ** 2) ** 0.5 - nb**0.5) / alpha * wb
            nb += float(g) ** 2
    slots = np.flatnonzero(np.abs(z) > l1)
    return Model(bits, live[slots].astype(np.int64), weights(slots).astype(np.float64), bias())


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = 24, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5) -> Model:
    """Learn from at most ``sample`` labelled documents whose ``crc32(id) mod folds`` is not 0.

    The sample is the labelled ids with the smallest hashes, so it does not
    depend on how the tables are partitioned. Null ids and null labels, and
    ids that are labelled both ways, are left out; a document that occurs in
    several rows counts in each. Without any label the model says 0.5.
    """
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
        .filter(F.col("_id").isNotNull() & F.col("_y").isNotNull())
        .filter(F.crc32(F.col("_id").cast("string").cast("binary")) % folds != 0)
        .groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_top"))
        .filter("_y = _top").select("_id", "_y", F.xxhash64("_id").alias("_h"))
        .orderBy("_h", "_id").limit(sample)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_t"))
    one = texts.join(F.broadcast(chosen), "_id").select("_h", "_id", "_y", "_t").repartition(1).sortWithinPartitions("_h", "_id", F.xxhash64("_t"))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, parts, sizes, labels = Features(bits), [np.empty(0, np.int32)], [], []
        for batch in slices(batches, "_t"):
            some = [np.unique(make(t)).astype(np.int32) for t in blobs(batch.column("_t"))]
            parts.append(np.concatenate(some))
            sizes += map(len, some)
            labels += batch.column("_y").to_pylist()
        flat = np.concatenate(parts)
        del parts
        ends = np.cumsum(sizes).tolist()
        rows = [(flat[b - n : b], int(y)) for n, b, y in zip(sizes, ends, labels, strict=True)]
        del flat
        model = ftrl(rows, bits)
        yield pa.RecordBatch.from_pydict({"slots": pa.array([model.slots.astype("<i8").tobytes()]), "weights": pa.array([model.weights.tobytes()]), "bias": [model.bias]})

    row = one.mapInArrow(train, "slots binary, weights binary, bias double").collect()
    if not row:
        return Model(bits, np.empty(0, np.int64), np.empty(0), 0.0)
    return Model(bits, np.frombuffer(row[0]["slots"], "<i8"), np.frombuffer(row[0]["weights"], "<f8"), row[0]["bias"])


def score(model: Model, text: Column) -> Column:
    """The probability, 0 to 1, that a text is toxic; null and empty texts have that of the bias alone."""

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = model.scorer()
        for part in parts:
            yield pd.Series([one(t) for t in part], dtype="float64")

    return scored(text.cast("binary"))


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """All of ``docs`` with ``score`` and ``predicted``; columns of those names are replaced."""
    model = fit(docs, labels, **options)
    return docs.withColumn("score", score(model, F.col(options.get("text_col", "text")))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``."""
    scored = score_documents(docs.select("doc_id", "text"), labels)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")
