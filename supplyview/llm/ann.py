"""Nearest neighbours by randomly rotated one-bit codes.

Every vector is taken relative to the nearest of a few centres (k-means on a bounded
sample, ``SAMPLE`` rows), scaled to length one, rotated at random into ``bits`` dimensions, and
stored as the signs, packed 64 to a word, with two scalars: its distance to the centre and
the inner product of the signs with the rotated vector. From them the inner product
with a query is estimated, with an error bound that holds with high probability
(``confidence`` standard deviations). A vector is reranked by its exact distance if its
lower bound is not above the query's limit: the k-th smallest upper bound in the chunk or the
k-th smallest exact distance in the sample, whichever is smaller.

Queries and vectors meet in blocks: chunks of one centre's vectors against blocks of
queries. Each pair of blocks returns at most k rows per query; a window keeps the best.

Vectors that are null, zero, without an id, or hold null or non-finite components take
no part, nor do those of another length than most. Rows that share a vec_id are all
candidates, except for the query of that id; such a query is asked once, with its
smallest vector. Equal distances go to the smaller vec_id. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyview.session import stage
from supplyview.llm.common import parts, valid_vectors

SAMPLE = 4096
CHUNK_ROWS = 8192
QUERY_ROWS = 1024


class Model:
    """Centres, rotation and sample; bounded by ``SAMPLE`` vectors."""

    def __init__(self, sample: np.ndarray, bits: int = 256, centres: int = 16, seed: int = 11):
        random = np.random.default_rng(seed)
        length = sample.shape[1]
        self.sample, self.bits = sample, max(bits, -(-length // 64) * 64)
        square = random.standard_normal((self.bits, self.bits))
        # Orthonormal columns: a rotation of the vector padded with zeros.
        self.rotation = np.linalg.qr(square)[0][:, :length]
        c = sample[random.permutation(len(sample))[:centres]].copy()
        for _ in range(10):
            near = self._nearest(sample, c)
            for i in range(len(c)):
                if (near == i).any():
                    c[i] = sample[near == i].mean(axis=0)
        self.centres = c

    @staticmethod
    def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Centre, packed signs (n, bits / 64), distance to the centre, inner product."""
        centre = self._nearest(x, self.centres)
        rest = x - self.centres[centre]
        norm = np.sqrt((rest * rest).sum(axis=1))
        turned = (rest / np.where(norm > 0, norm, 1)[:, None]) @ self.rotation.T
        codes = np.packbits(turned > 0, axis=1, bitorder="little").view("<u8")
        inner = np.abs(turned).sum(axis=1) / np.sqrt(self.bits)
        return centre, codes, norm, np.where(norm > 0, inner, 1)

    def bounds(
        self, queries: np.ndarray, centre: int, codes: np.ndarray, norm: np.ndarray,
        inner: np.ndarray, confidence: float,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of squared distances, (queries, vectors)."""
        rest = queries - self.centres[centre]
        length = np.sqrt((rest * rest).sum(axis=1))[:, None]
        turned = (rest @ self.rotation.T).astype(np.float32)
        signs = np.unpackbits(codes.view(np.uint8).reshape(len(codes), -1), axis=1, bitorder="little")
        product = 2 * (turned @ signs.T.astype(np.float32)) - turned.sum(axis=1)[:, None]
        estimate = product / np.sqrt(self.bits) / inner
        spread = np.sqrt(np.maximum(1 - inner * inner, 0)) / inner / np.sqrt(self.bits - 1)
        error = confidence * length * spread + 1e-5 * length
        base = norm * norm + length * length
        return base - 2 * norm * (estimate + error), base - 2 * norm * (estimate - error)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - q) ** 2).sum(axis=1))


def search(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    bits: int = 256,
    confidence: float = 3.0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query."""
    spark = rows.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    chosen = rows.withColumn("_query", F.coalesce(is_query, F.lit(False)))
    all_valid = valid_vectors(chosen, key, vector).select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("embedding"), "_query",
    )
    lengths = all_valid.groupBy(F.size("embedding").alias("n")).count()
    usual = lengths.orderBy(F.desc("count"), "n").limit(1).collect()
    if not usual:
        return spark.createDataFrame([], out)
    valid = all_valid.filter(F.size("embedding") == usual[0]["n"])
    total = usual[0]["count"]
    picked = valid.orderBy(F.xxhash64("vec_id", "embedding")).limit(SAMPLE).select("vec_id", "embedding").toPandas()
    sample_ids = picked["vec_id"].to_numpy()
    model = Model(np.array(picked["embedding"].tolist(), dtype=np.float64), bits)
    shared = spark.sparkContext.broadcast((model, sample_ids))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value[0]
        for batch in batches:
            if not batch.num_rows:
                continue
            centre, codes, norm, inner = model.encode(_matrix(batch.column("embedding")))
            words = codes.shape[1]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, codes.size + 1, words, dtype=np.int32)), pa.array(codes.view(np.int64).ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("embedding"), pa.array(centre, pa.int32()), lists,
                 pa.array(norm), pa.array(inner)],
                ["vec_id", "embedding", "centre", "codes", "norm", "inner"],
            )

    index = valid.select("vec_id", "embedding").mapInArrow(
        encoded,
        "vec_id long, embedding array<double>, centre int, codes array<long>, norm double, inner double",
    )
    n_chunks = parts(total, CHUNK_ROWS)
    queries = stage(
        valid.filter("_query").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("query")),
        "ann-queries",
    )
    n_blocks = parts(queries.count(), QUERY_ROWS)
    part = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n_chunks)).cast("int")
    # A stated query set against all rows, in blocks: each side is dealt to every block of the other.
    vectors = index.withColumn("chunk", part).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    )
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)))
    )

    def best(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(q) or not len(v):
            return pd.DataFrame({n: [] for n in names})
        model, sample_ids = shared.value
        asked = np.array(q["query"].tolist(), dtype=np.float64)
        asked_ids = q["query_id"].to_numpy()
        # The k-th smallest distance to sampled vectors but the query's own limits the search.
        limit = np.full(len(asked), np.inf)
        if len(sample_ids) > 2 * k:
            for i, x in enumerate(asked):
                d = _exact(x, model.sample)[sample_ids != asked_ids[i]]
                if len(d) >= k:
                    limit[i] = np.partition(d, k - 1)[k - 1] ** 2 * (1 + 1e-9)
        found = []
        for centre, own in v.groupby("centre"):
            x = np.array(own["embedding"].tolist(), dtype=np.float64)
            ids = own["vec_id"].to_numpy()
            codes = np.array(own["codes"].tolist(), dtype=np.int64).view(np.uint64)
            low, high = model.bounds(
                asked, centre, codes, own["norm"].to_numpy(), own["inner"].to_numpy(), confidence
            )
            for i in range(len(asked)):
                other = ids != asked_ids[i]
                upper = high[i][other]
                most = limit[i]
                if len(upper) >= k:
                    most = min(most, np.partition(upper, k - 1)[k - 1])
                some = np.flatnonzero(other & (low[i] <= most))
                if not len(some):
                    continue
                d = _exact(asked[i], x[some])
                order = np.lexsort((ids[some], d))[:k]
                limit[i] = min(limit[i], d[order[-1]] ** 2 * (1 + 1e-9)) if len(order) == k else limit[i]
                found.append((np.full(len(order), asked_ids[i]), ids[some][order], d[order]))
        if not found:
            return pd.DataFrame({n: [] for n in names})
        return pd.DataFrame({n: np.concatenate([f[c] for f in found]) for c, n in enumerate(names)})

    near = (
        asked.groupBy("block", "chunk")
        .cogroup(vectors.groupBy("block", "chunk"))
        .applyInPandas(best, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
