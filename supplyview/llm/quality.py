"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes hashed counts of three kinds: trigrams of byte classes (which show case,
digits and each punctuation mark but not the letters), byte trigrams, and repetition
(of adjacent words, words, lines). Square roots of shares times inverse document
frequency, scaled to length one per kind, are projected by the leading singular
vectors of the labelled sample. All labelled vectors are broadcast, and every document's
cosines with all of them are computed in blocks; the ``neighbours`` closest vote with
weights that grow with similarity.

The fit is on at most ``SAMPLE`` labelled training rows, picked by a hash of their id, so what is
broadcast has a fixed size. Labels that are null do not count; an id labelled twice
counts with its higher label. Null and empty texts, and texts with no positive cosine,
get the sample's mean label; without any labelled row the score is 0.5. Of neighbours
tied for the last vote those with the smaller doc_id vote. Of several texts of one labelled doc_id the one
with the least counts stands for it. Very long texts are scored whole. Repeated rows are scored
each; an empty table gives no rows; extra columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyview.llm.common import free_name, schema_of

SAMPLE = 4000
SHAPES, GRAMS, REPEATS = 1024, 1024, 4
FEATURES = SHAPES + GRAMS + REPEATS
KINDS = ((0, SHAPES, 1.0), (SHAPES, SHAPES + GRAMS, 0.3), (SHAPES + GRAMS, FEATURES, 1.0))
RANK = 64
NEIGHBOURS = 15
SHARPNESS = 8
BLOCK_ROWS = 128
# Bytes of a text that are counted at a time.
SLICE = 1 << 18


def byte_classes() -> np.ndarray:
    """Letters by case, digits, white space and other controls; punctuation marks stay apart."""
    out = np.arange(256, dtype=np.uint32)
    out[:33] = 1
    out[10] = 10
    out[48:58] = 2
    out[65:91] = 3
    out[97:123] = 4
    out[128:] = 4
    return out


CLASSES = byte_classes()


def raw_counts(text: str | None) -> np.ndarray:
    """Counts of the three kinds, as shares within their kind."""
    out = np.zeros(FEATURES, np.float32)
    if not text:
        return out
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) > 2:
        counts = np.zeros((2, SHAPES), np.int64)
        for start in range(0, len(data) - 2, SLICE):
            some = data[start : start + SLICE + 2]
            for row, values in enumerate((CLASSES[some], some.astype(np.uint32))):
                mixed = values[:-2] * np.uint32(0x9E3779B1) + values[1:-1] * np.uint32(0x85EBCA77) + values[2:] * np.uint32(0xC2B2AE3D)
                mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                counts[row] += np.bincount(mixed >> np.uint32(22), minlength=SHAPES)
        out[: SHAPES + GRAMS] = counts.ravel() / (len(data) - 2)
    words = text.split()
    if words:
        lines = text.split("\n")
        n = len(words)
        out[SHAPES + GRAMS :] = (
            sum(map(eq, words, words[1:])) / n,
            sum(map(eq, words, words[2:])) / n,
            1 - len(set(words)) / n if n > 20 else 0,
            1 - len(set(lines)) / len(lines),
        )
    return out


def closest(cosine: np.ndarray, k: int) -> np.ndarray:
    """(n, k) places of the k largest of each row; of equal ones the first places."""
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(cosine, near, axis=1).min(axis=1, keepdims=True)
    more = np.flatnonzero((cosine >= least).sum(axis=1) > k)
    if len(more):
        above = cosine[more] > least[more]
        tied = cosine[more] == least[more]
        chosen = above | (tied & (np.cumsum(tied, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        near[more] = np.nonzero(chosen)[1].reshape(len(more), k)
    return near


class Model:
    """Projection, neighbours and their labels: of fixed size."""

    def __init__(self, shares: np.ndarray, labels: np.ndarray, rank: int = RANK):
        self.prior = float(labels.mean()) if len(labels) else 0.5
        df = (shares > 0).sum(axis=0)
        self.idf = np.log((1 + len(shares)) / (1 + df)).astype(np.float32) + np.float32(0.1)
        weighted = self._weighted(shares)
        # The leading right singular vectors, by subspace iteration.
        axes = np.random.default_rng(5).standard_normal((FEATURES, rank + 16)).astype(np.float32)
        for _ in range(6):
            axes = np.linalg.qr(weighted.T @ (weighted @ axes))[0]
        turn = np.linalg.svd(weighted @ axes, full_matrices=False)[2]
        self.axes = np.ascontiguousarray((axes @ turn.T)[:, :rank], np.float32)
        latent = self._unit(weighted @ self.axes)
        used = np.abs(latent).sum(axis=1) > 0
        self.neighbours, self.labels = latent[used], labels[used].astype(np.float32)

    def _weighted(self, shares: np.ndarray) -> np.ndarray:
        out = np.sqrt(shares) * self.idf
        for a, b, weight in KINDS[:2]:
            out[:, a:b] = self._unit(out[:, a:b]) * np.float32(weight)
        a, b, weight = KINDS[2]
        out[:, a:b] = np.sqrt(shares[:, a:b]) * np.float32(weight)
        return out

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return np.where(norm > 0, x / np.where(norm > 0, norm, 1), 0).astype(np.float32)

    def score(self, shares: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.neighbours):
            return np.full(len(shares), self.prior)
        latent = self._unit(self._weighted(shares) @ self.axes)
        cosine = latent @ self.neighbours.T
        k = min(neighbours, cosine.shape[1])
        near = closest(cosine, k)
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(float) ** SHARPNESS
        total = weight.sum(axis=1)
        empty = (shares.sum(axis=1) == 0) | (total <= 0)
        voted = (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.clip(np.where(empty, self.prior, voted), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str, train: Column, sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled rows of ``docs`` where ``train`` holds on doc_id."""
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", label).filter(train)
        .groupBy("doc_id").agg(F.max(label).alias("_label"))
    )
    # An id that has no document takes no place in the sample.
    found = known.join(docs.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct(), "doc_id")
    picked = found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [raw_counts(x).tobytes() for x in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_label").cast(pa.float64()), pa.array(rows, pa.binary())],
                ["doc_id", "label", "shares"],
            )

    # The picked rows are bounded, so they are broadcast to the texts.
    rows = (
        docs.select("doc_id", F.col("text").cast("string").alias("_text"))
        .join(F.broadcast(picked), "doc_id")
        .mapInArrow(shares, "doc_id long, label double, shares binary")
        .groupBy("doc_id").agg(F.min(F.struct("shares", "label")).alias("least"))
        .select("doc_id", "least.*").toPandas()
        .sort_values("doc_id")
    )
    matrix = np.array([np.frombuffer(x, np.float32) for x in rows["shares"]]).reshape(-1, FEATURES)
    return Model(matrix, rows["label"].to_numpy(dtype=float))


def score(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """``keep`` columns and the score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep)
    text = "text" if "text" in keep else free_name(kept, "_text")
    read = kept if "text" in keep else docs.select(*keep, F.col("text").alias(text))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(text).to_pylist()
            out = [
                model.score(np.array([raw_counts(x) for x in texts[i : i + BLOCK_ROWS]]))
                for i in range(0, len(texts), BLOCK_ROWS)
            ]
            columns = [batch.column(c) for c in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.concatenate(out) if out else [], pa.float64())], [*keep, name]
            )

    return read.mapInArrow(scored, f"{schema_of(kept)}, `{name}` double")
