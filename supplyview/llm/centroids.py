"""Exact centroid clustering (Lloyd's rounds) with heap-ordered bounds.

Vectors become integers, so that sums, means and distances are exact, and are stored in blocks of
``BLOCK_ROWS`` in a table bucketed by block. Every block keeps one heap per centroid with its vectors'
gaps: the distance to the second nearest centroid less that to the own one. When centroids move, a
gap shrinks by no more than the own centroid's move and the largest move of another; these
sums accumulate per centroid and are added to a gap when it is pushed, so a heap need not be
touched until its least gap falls to what has accumulated. Only vectors popped then are compared with all
centroids again and pushed with a new gap. Gaps are rounded down and moves up, and a gap
of zero (a tie) always expires, so every assignment equals the full scan's.

A round joins the heaps (a table bucketed alike, some 12 bytes a vector) with the blocks that have
an expired gap; neither side is shuffled. Changes of sums return as one row per block, added up by
position; the driver sees (vectors + 1) numbers per centroid, whatever the input.

Vectors kept have exactly ``length`` components, none null or non-finite; a component x counts as
floor(scale * x), held within +-2^40. Distances and inertias beyond 64 bits are given as the largest
long. Rows with the same or no id are clustered each for itself; they are seeds in the order of hash,
then components, ids that are null last. Fewer vectors than centroids: each is one. Equal seeds
leave the later centroid empty, and empty ones stay where they are. An empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyview.session import current_folder, run_folder
from supplyview.llm.common import parts, prepared

BLOCK_ROWS = 4096
# Buckets of about so many bytes; Spark allows a table this many.
BUCKET_BYTES = 128 << 20
MOST_BUCKETS = 100_000
LARGEST = 1 << 40
# Sums of so large components' squares are exact in doubles, and in longs.
IN_DOUBLES, IN_LONGS = 1 << 21, 1 << 27
LONG = (1 << 63) - 1
# Relative slack for what square roots and additions round off.
SLACK = 1e-12

BLOCKS = "block long, ids array<long>, data binary"
HEAPS = "block long, gaps binary, items binary, sizes array<int>, least array<double>, change array<long>"


def floors(column: pa.Array, length: int, scale: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(scale * flat), -LARGEST, LARGEST).astype(np.int64).reshape(-1, length)


def packed(x: np.ndarray) -> bytes:
    narrow = len(x) == 0 or np.abs(x).max() < 1 << 31
    return x.astype("<i4" if narrow else "<i8").tobytes()


def unpacked(data: bytes, n: int, length: int) -> np.ndarray:
    kind = "<i4" if len(data) == 4 * n * length else "<i8"
    return np.frombuffer(data, kind).reshape(n, length).astype(np.int64)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, (vectors, centroids): of doubles, longs or Python's integers."""
    most = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0))
    if most < IN_DOUBLES:
        x, c = x.astype(np.float64), centroids.astype(np.float64)
        return (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * (x @ c.T)
    kind = np.int64 if most < IN_LONGS else object
    x = x.astype(kind)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids.astype(kind)], axis=1)


def nearest(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid (the smaller number of equal ones) and the gap, rounded down."""
    own = found.argmin(axis=1)
    at = np.arange(len(found))
    upper = np.sqrt(found[at, own].astype(np.float64))
    rest = found.astype(np.float64)
    rest[at, own] = np.inf
    lower = np.sqrt(rest.min(axis=1))
    gap = np.where(np.isinf(lower), np.inf, lower - upper - SLACK * (lower + upper))
    return own, gap


class Heaps:
    """One heap of (gap, vector's place in the block) per centroid."""

    def __init__(self, k: int):
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]

    @classmethod
    def stored(cls, gaps: bytes, items: bytes, sizes: list[int]) -> Heaps:
        out, at = cls(len(sizes)), 0
        keys, places = np.frombuffer(gaps, "<f8").tolist(), np.frombuffer(items, "<i4").tolist()
        for c, n in enumerate(sizes):
            out.heaps[c] = list(zip(keys[at : at + n], places[at : at + n]))
            at += n
        return out

    def expired(self, accumulated: np.ndarray) -> tuple[list[int], list[int]]:
        """Pop what has no gap left: places and the centroids they had."""
        places, had = [], []
        for c, heap in enumerate(self.heaps):
            while heap and heap[0][0] <= accumulated[c]:
                places.append(heapq.heappop(heap)[1])
                had.append(c)
        return places, had

    def push(self, places: list[int], own: np.ndarray, gap: np.ndarray, accumulated: np.ndarray) -> None:
        keys = (gap + accumulated[own]) * (1 - SLACK)
        for place, c, key in zip(places, own.tolist(), keys.tolist()):
            heapq.heappush(self.heaps[c], (key, place))

    def owners(self) -> np.ndarray:
        out = np.empty(sum(map(len, self.heaps)), np.int64)
        for c, heap in enumerate(self.heaps):
            out[[place for _, place in heap]] = c
        return out

    def row(self) -> tuple:
        entries = [x for heap in self.heaps for x in heap]
        return (
            np.array([key for key, _ in entries], "<f8").tobytes(),
            np.array([place for _, place in entries], "<i4").tobytes(),
            [len(heap) for heap in self.heaps],
            [heap[0][0] if heap else math.inf for heap in self.heaps],
        )


def _changes(x: np.ndarray, had: np.ndarray | None, own: np.ndarray, k: int) -> list[int] | None:
    """What vectors that changed their centroid add to its sums and number."""
    out = np.zeros((k, x.shape[1] + 1), np.int64)
    ones = np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1)
    if had is not None:
        moved = had != own
        ones, own = ones[moved], own[moved]
        np.subtract.at(out, had[moved], ones)
    np.add.at(out, own, ones)
    return out.ravel().tolist() if out.any() else None


def _heap_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int64())]
    names = [x.split()[0] for x in HEAPS.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


class _Tables:
    """Tables bucketed by block in the run's folder, gone from the catalog at the end."""

    def __init__(self, spark, folder: str, buckets: int):
        self.spark, self.folder, self.buckets, self.names = spark, folder, buckets, []

    def write(self, df: DataFrame, what: str, spread: bool) -> DataFrame:
        name = f"centroids_{what}_{uuid.uuid4().hex}"
        self.names.append(name)
        rows = df.repartition(self.buckets, "block") if spread else df
        (
            rows.write.bucketBy(self.buckets, "block").format("parquet")
            .option("path", f"{self.folder}/{name}").saveAsTable(name)
        )
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _blocks(rows: DataFrame, key: str, vector: str, length: int, scale: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number = 0

        def block(held: list[tuple[list, np.ndarray]]) -> pa.RecordBatch:
            ids = [i for keys, _ in held for i in keys]
            data = packed(np.concatenate([x for _, x in held]))
            return pa.RecordBatch.from_arrays(
                [pa.array([first + number]), pa.array([ids], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                names=["block", "ids", "data"],
            )

        held: list[tuple[list, np.ndarray]] = []
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                held.append((part.column(0).to_pylist(), floors(part.column(1), length, scale)))
                if sum(len(keys) for keys, _ in held) >= BLOCK_ROWS:
                    yield block(held)
                    held, number = [], number + 1
        if held:
            yield block(held)

    return rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).mapInArrow(cut, BLOCKS)


def kept(rows: DataFrame, vector: str, length: int) -> DataFrame:
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter((F.size(v) == length) & good)


def seeds(rows: DataFrame, key: str, vector: str, k: int, length: int, scale: int, salt: str) -> np.ndarray:
    """The k vectors whose salted ids have the smallest hashes."""
    chosen = rows.select(
        F.sha2(F.concat(F.lit(salt), F.col(key).cast("long").cast("string")), 256).alias("_hash"),
        F.col(vector).cast("array<double>").alias("_vector"),
    ).orderBy(F.asc_nulls_last("_hash"), "_vector").limit(k)
    found = [r["_vector"] for r in chosen.collect()]
    return floors(pa.array(found, pa.list_(pa.float64())), length, scale)


def _assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The heaps of the first assignment."""
    k, length = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, ids, data in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "data"))):
                x = unpacked(data, len(ids), length)
                own, gap = nearest(distances(x, centroids))
                heaps = Heaps(k)
                for place, (c, key) in enumerate(zip(own.tolist(), gap.tolist())):
                    heaps.heaps[c].append((key, place))
                for heap in heaps.heaps:
                    heapq.heapify(heap)
                rows.append((block, *heaps.row(), _changes(x, None, own, k)))
            yield _heap_batch(rows)

    return blocks.mapInArrow(run, HEAPS)


def _rescanned(joined: DataFrame, centroids: np.ndarray, accumulated: np.ndarray) -> DataFrame:
    """The heaps after the centroids moved; blocks without an expired gap pass through."""
    k, length = centroids.shape
    names = ("block", "gaps", "items", "sizes", "least", "ids", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, gaps, items, sizes, least, ids, data in zip(*(batch.column(c).to_pylist() for c in names)):
                if data is None:
                    rows.append((block, gaps, items, sizes, least, None))
                    continue
                heaps = Heaps.stored(gaps, items, sizes)
                places, had = heaps.expired(accumulated)
                x = unpacked(data, len(ids), length)[places]
                own, gap = nearest(distances(x, centroids))
                heaps.push(places, own, gap, accumulated)
                rows.append((block, *heaps.row(), _changes(x, np.array(had, np.int64), own, k)))
            yield _heap_batch(rows)

    return joined.mapInArrow(run, HEAPS)


def _with_blocks(heaps: DataFrame, blocks: DataFrame, accumulated: np.ndarray) -> DataFrame:
    """Heaps with their vectors where a gap has expired."""
    limits = F.array(*[F.lit(float(x)) for x in accumulated])
    out = F.exists(F.zip_with("least", limits, lambda a, b: a <= b), lambda x: x)
    # The heaps are hashed, so the vectors need no sort.
    left = heaps.drop("change").withColumn("_block", F.when(out, F.col("block")))
    right = blocks.withColumnRenamed("block", "_of")
    return left.hint("shuffle_hash").join(
        right, (F.col("block") == F.col("_of")) & F.col("_block").isNotNull(), "left"
    ).drop("_of", "_block")


def _add_changes(heaps: DataFrame, sums: np.ndarray) -> np.ndarray:
    total = (
        heaps.filter(F.col("change").isNotNull()).select(F.posexplode("change").alias("at", "x"))
        .groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    )
    flat = sums.ravel().copy()
    for r in total.collect():  # centroids * (length + 1) rows
        flat[r["at"]] += int(r["x"])
    return flat.reshape(sums.shape)


def _means(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    new = centroids.copy()
    for c, (*total, n) in enumerate(sums.tolist()):
        if n:
            new[c] = [x // n for x in total]
    return new


def _moves(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What each centroid's gaps lose at most: its own move and the largest of another, rounded up."""
    square = [sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for x, y in zip(before, after)]
    own = np.array([math.sqrt(s) for s in square]) * (1 + SLACK)
    others = [max((m for j, m in enumerate(own) if j != c), default=0.0) for c in range(len(own))]
    return (own + others) * (1 + SLACK)


def _labelled(joined: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    length = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gaps, items, sizes, ids, data in zip(
                *(batch.column(c).to_pylist() for c in ("gaps", "items", "sizes", "ids", "data"))
            ):
                own = Heaps.stored(gaps, items, sizes).owners()
                x = unpacked(data, len(ids), length)
                found = np.empty(len(ids), object)
                for c in range(len(centroids)):
                    found[own == c] = distances(x[own == c], centroids[c : c + 1])[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(own, pa.int32()),
                     pa.array([min(int(d), LONG) for d in found], pa.int64())],
                    names=["id", "cluster", "distance"],
                )

    return joined.mapInArrow(run, "id long, cluster int, distance long")


def cluster(
    rows: DataFrame,
    k: int = 8,
    rounds: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    length: int = 64,
    scale: int = 1024,
    salt: str = "3:",
) -> DataFrame:
    """One row per kept vector: the key, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = rows.sparkSession
    prepared(spark)
    out = f"{key} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    good = kept(rows.select(key, vector), vector, length)
    centroids = seeds(good, key, vector, k, length, scale, salt)
    if not len(centroids):
        return spark.createDataFrame([], out)
    k = len(centroids)
    size = good.count() * length * 4
    buckets = min(MOST_BUCKETS, max(spark.sparkContext.defaultParallelism, parts(size, BUCKET_BYTES)))
    with run_folder(spark, f"{current_folder(spark)}/centroids-{uuid.uuid4().hex}") as folder:
        tables = _Tables(spark, folder, buckets)
        try:
            blocks = tables.write(_blocks(good, key, vector, length, scale), "blocks", spread=True)
            accumulated = np.zeros(k)
            heaps = tables.write(_assign(blocks, centroids), "heaps", spread=False)
            sums = _add_changes(heaps, np.zeros((k, length + 1), object))
            for n in range(rounds):
                moved = _means(centroids, sums)
                if (moved == centroids).all():
                    break
                accumulated = (accumulated + _moves(centroids, moved)) * (1 + SLACK)
                centroids = moved
                joined = _with_blocks(heaps, blocks, accumulated)
                heaps = tables.write(_rescanned(joined, centroids, accumulated), "heaps", spread=False)
                sums = _add_changes(heaps, sums)
            everything = np.full(k, np.inf)
            labelled = _labelled(_with_blocks(heaps, blocks, everything), centroids)
            labelled.write.parquet(f"{folder}-labels")
        finally:
            tables.drop()
    labels = spark.read.schema("id long, cluster int, distance long").parquet(f"{folder}-labels")
    total = labels.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n"))
    each = {r["cluster"]: int(r["n"]) for r in total.collect()}  # a row per centroid
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(c, min(each.get(c, 0), LONG), min(sum(each.values()), LONG), hashes[c]) for c in range(k)]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return labels.join(F.broadcast(named), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def cluster_sql(k: int = 8, rounds: int = 10, length: int = 64, scale: int = 1024, salt: str = "3:") -> str:
    """The same by full scans of ``embeddings``: a table expression for every round."""
    steps = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, embedding,
         [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
  FROM embeddings
  WHERE len(embedding) = {length} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {length}),
c0 AS MATERIALIZED (
  SELECT CAST(place - 1 AS INTEGER) AS cluster, x
  FROM (SELECT x, row_number() OVER (ORDER BY sha256('{salt}' || vec_id) NULLS LAST, embedding) AS place FROM v)
  WHERE place <= {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT row, cluster, d AS distance FROM (
    SELECT v.row, c.cluster,
           list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v.x, c.x)]) AS d
    FROM v, c{n} AS c)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, cluster) = 1)""")
        if n < rounds:
            # Integer division rounds towards zero, but means are rounded down.
            steps.append(f"""
m{n} AS MATERIALIZED (
  SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY place) AS x
  FROM (SELECT a.cluster, r.place, sum(v.x[r.place]) AS total, count(*) AS n
        FROM a{n} AS a JOIN v USING (row) CROSS JOIN range(1, {length + 1}) AS r(place) GROUP BY ALL)
  GROUP BY cluster),
c{n + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{n} AS c LEFT JOIN m{n} AS m USING (cluster))""")
    return "WITH" + ",".join(steps) + f"""
SELECT v.vec_id, a.cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN v USING (row) JOIN c{rounds} AS c USING (cluster)"""
