"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are scaled to length one, where cosine >= t means a distance of at most
sqrt(2 - 2 t). A hash is floor((a . v + b) / width) for a random normal a and a random
shift b; a table's key joins ``k`` of them. Vectors that share a key in any table
are compared by their exact cosine in double precision.

``shape`` chooses k so that unrelated vectors share a bucket with about ``bucket``
others at any number of rows, and the number of tables so that a pair just at the threshold is
found with probability ``recall``; closer pairs are found almost surely.

Tables hold no vectors but codes: components in a byte each, with the vector's scale and how far the
code is from it. They give an upper bound of a cosine, and only vectors that some other one in
their bucket may link to are fetched, once per bucket, for the exact cosines.

Equal vectors are one class from the start. Buckets beyond ``chunk`` are compared by
pairs of chunks. A pair that meets in several tables counts in the first alone, which
both vectors' keys tell. Results are counts and stars, never lists of pairs.

Vectors that are null, zero, without an id, or hold null or non-finite components link
with nothing. Vectors of different lengths do not link. Repeated rows are vectors of
their own (rows with the same vec_id share its component). An empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyview.session import stage
from supplyview.llm.common import components, group_chunks, valid_vectors
from supplyview.llm.simhash import smallest_reachable

WIDTH = 2.0
# What names a list of vectors to compare: table, length, key, and the two chunks of its bucket.
LIST = ("tab", "dim", "key", "part_i", "part_j")
LIST_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32())


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that two vectors at this distance share one hash."""
    x = width / distance
    normal = 0.5 * (1 + math.erf(-x / math.sqrt(2)))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def shape(rows: int, threshold: float, recall: float = 0.97, bucket: int = 64) -> tuple[int, int]:
    """Hashes per key and number of tables."""
    k = max(4, math.ceil(math.log(max(rows, bucket) / bucket) / -math.log(collision(math.sqrt(2)))))
    found = collision(math.sqrt(2 - 2 * threshold)) ** k
    return k, math.ceil(math.log(1 - recall) / math.log(1 - found))


@lru_cache(maxsize=8)
def projections(length: int, hashes: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions, shifts and mixers; they follow from the seed."""
    random = np.random.default_rng([seed, length])
    a = random.standard_normal((length, hashes))
    b = random.uniform(0, WIDTH, hashes)
    return a, b, random.integers(1, 1 << 62, hashes, dtype=np.int64) | 1


def keys_of(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """(n, tables) keys of unit vectors."""
    a, b, mixer = projections(unit.shape[1], tables * k)
    hashes = np.floor((unit @ a + b) / WIDTH).astype(np.int64)
    with np.errstate(over="ignore"):
        mixed = (hashes * mixer).reshape(-1, tables, k).sum(axis=2)
    return mixed ^ (mixed >> 29)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    # By the largest component first, so squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def codes_of(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as (n, length) bytes, the step of each, and the length of what they leave out."""
    step = np.abs(unit).max(axis=1) / 127
    code = np.rint(unit / step[:, None]).astype(np.int8)
    rest = unit - code * step[:, None]
    return code, step, np.sqrt((rest * rest).sum(axis=1)) + 1e-7 * (10 + unit.shape[1])


def may_link(code: np.ndarray, step: np.ndarray, rest: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each two vectors' cosine can reach the threshold, by their codes.

    With u = u' + e and v = v' + f, u . v = u' . v' + u' . f + e . v is at most
    u' . v' + (1 + |e|) |f| + |e|.
    """
    # In single precision: its error is below what every rest has on top.
    x = code.astype(np.float32) * step.astype(np.float32)[:, None]
    most = rest[:, None] + rest[None, :] + rest[:, None] * rest[None, :]
    return x @ x.T >= threshold - most


def _keyed(k: int, tables: int):
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = vectors.value_lengths().to_numpy()
            for length in np.unique(lengths):
                rows = batch.filter(pa.array(lengths == length))
                unit = _matrix(rows.column("embedding"))
                keys = keys_of(unit, k, tables)
                code, step, rest = codes_of(unit)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32)), pa.array(keys.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [rows.column("node"), pa.array([x.tobytes() for x in code], pa.binary()),
                     pa.array(step), pa.array(rest), lists],
                    ["node", "code", "step", "rest", "keys"],
                )

    return keyed


def _sides(members: pa.StructArray, part_i: int, part_j: int) -> np.ndarray | bool:
    """Which pairs of members meet here: those of different sides, or all in a chunk of its own."""
    if part_i == part_j:
        return True
    side = members.field("side").to_numpy()
    return side[:, None] != side[None, :]


def _sifted(threshold: float):
    """The members of each list that another one may link to, by their codes."""
    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in range(batch.num_rows):
                at = [batch.column(c)[g].as_py() for c in LIST]
                members = batch.column("members").slice(g, 1).flatten()
                code = np.frombuffer(b"".join(members.field("code").to_pylist()), np.int8).reshape(len(members), -1)
                near = may_link(code, members.field("step").to_numpy(), members.field("rest").to_numpy(), threshold)
                np.fill_diagonal(near, False)
                near &= _sides(members, at[3], at[4])
                some = pa.array(near.any(axis=1))
                node, side = members.field("node").filter(some), members.field("side").filter(some)
                if len(node):
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([x] * len(node), t) for x, t in zip(at, LIST_TYPES)), node, side],
                        [*LIST, "node", "side"],
                    )

    return sifted


def _compared(threshold: float, k: int, tables: int):
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in range(batch.num_rows):
                tab, _, _, part_i, part_j = (batch.column(c)[g].as_py() for c in LIST)
                members = batch.column("members").slice(g, 1).flatten()
                unit = _matrix(members.field("embedding"))
                node = members.field("node").to_numpy()
                size = members.field("n").to_numpy()
                close = np.triu(unit @ unit.T >= threshold, 1) & _sides(members, part_i, part_j)
                i, j = np.nonzero(close)
                if not len(i):
                    continue
                some = np.unique(np.concatenate([i, j]))
                unit, node, size = unit[some], node[some], size[some]
                i, j = np.searchsorted(some, i), np.searchsorted(some, j)
                keys = keys_of(unit, k, tables)[:, :tab]
                new = ~(keys[i] == keys[j]).any(axis=1)
                a, b = i[new], j[new]
                links = np.bincount(a, size[b], len(node)) + np.bincount(b, size[a], len(node))
                root = smallest_reachable(node, i, j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(links.astype(np.int64)), pa.array(root)], ["node", "links", "root"]
                )

    return compared


def near_duplicates(
    rows: DataFrame,
    threshold: float = 0.9,
    key: str = "vec_id",
    vector: str = "embedding",
    recall: float = 0.97,
    chunk: int = 1000,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    vectors = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    classes = stage(
        valid_vectors(vectors, "vec_id", "embedding")
        .groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n")),
        "vector-classes",
    )
    k, tables = shape(classes.count(), threshold, recall)
    hashed = classes.select("node", "embedding").mapInArrow(
        _keyed(k, tables), "node long, code binary, step double, rest double, keys array<long>"
    )
    met = hashed.select(
        F.octet_length("code").alias("dim"), "node", "code", "step", "rest", F.posexplode("keys").alias("tab", "key")
    )
    groups = group_chunks(met, ["tab", "dim", "key"], "node", chunk)
    some = groups.select(*LIST, "members").mapInArrow(
        _sifted(threshold), "tab int, dim int, key long, part_i int, part_j int, node long, side int"
    )
    # At most two chunks of vectors per list, and only vectors that may have a link there.
    fetched = some.join(classes, "node").groupBy(*LIST).agg(
        F.collect_list(F.struct("side", "node", "n", "embedding")).alias("members")
    )
    found = stage(
        fetched.mapInArrow(_compared(threshold, k, tables), "node long, links long, root long"), "vector-links"
    )
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-round")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    of_class = (
        classes.join(counts, "node", "left").join(linked, "node", "left")
        .select(
            "embedding",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    # Invalid vectors are in no class, and a null vector equals none.
    return vectors.join(
        of_class, "embedding", "left"
    ).select(
        "vec_id",
        F.coalesce(F.when(F.col("vec_id").isNotNull(), F.col("n_links")), F.lit(0)).alias("n_links"),
        F.coalesce(F.when(F.col("vec_id").isNotNull(), F.col("component_id")), "vec_id").alias("component_id"),
        F.coalesce(
            F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)
        ).alias("kept"),
    )
