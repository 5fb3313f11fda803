"""SimHash near-duplicates by bit-sliced comparison.

A document's fingerprint has 64 bits: bit i is set if more than half of its shingles'
XXH64 values have it. Shingles are runs of words, repeats included; a text of fewer
words is one shingle, a text without words (null too) has fingerprint zero.

Fingerprints with few differing bits must agree on two of (radius + 2) pieces of their
bits, so each pair of pieces is a table of buckets. Within a bucket the fingerprints
stand as bit planes: one word holds the same bit of 64 fingerprints. Planes are compared
with one fingerprint's bits three at a time, carry-save adders keep 64 distances in
a few words, and a block of 64 is abandoned once every distance exceeds the radius.

Equal fingerprints are one node from the start. Buckets beyond ``chunk`` are dealt into
pairs of chunks. Linked fingerprints of a bucket are output as stars, never as pairs.

Rows with the same doc_id share it in the result; rows without one get their group's
component (null if no row of the group has an id). Very long texts are fingerprinted whole, one at a
time. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyview.session import stage
from supplyview.llm.common import components, group_chunks

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SEED = 42
# Shingles of a text that are hashed at a time.
SLICE = 20_000
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def words(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words of the UTF-8 text, split at space and \\x09-\\x0d."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64 bits as a signed integer, as Spark stores them."""
    w = words(text)
    if not w:
        return 0
    digest, join = xxhash.xxh64_digest, b" ".join
    n = max(1, len(w) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        some = w[at : at + SLICE + shingle - 1]
        runs = zip(*(some[i:] for i in range(shingle))) if len(w) >= shingle else [w]
        hashes = np.frombuffer(b"".join([digest(join(x), SEED) for x in runs]), np.uint8)
        counts += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x.as_py(), shingle) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, "doc_id long, fp long")


def masks(radius: int, bits: int = 64) -> list[int]:
    """One mask per table: two of radius + 2 pieces, as signed 64-bit integers."""
    cuts = np.linspace(0, bits, radius + 3).round().astype(int).tolist()
    pieces = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]
    joined = [a | b for a, b in combinations(pieces, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in joined]


def near_pairs(fps: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j, of fingerprints of the same group within ``radius`` bits.

    ``fps`` (uint64) holds the groups one after the other, ``sizes`` their lengths.
    """
    sizes = np.asarray(sizes)
    n_words = -(-sizes // 64)
    first_word = np.cumsum(n_words) - n_words
    first = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(sizes)), sizes)
    lane = first_word[group] * 64 + np.arange(len(fps)) - first[group]
    total = int(n_words.sum())
    member = np.full(total * 64, -1)
    member[lane] = np.arange(len(fps))
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    square = np.zeros((total * 64, 64), np.uint8)
    square[lane] = bits
    planes = np.packbits(
        np.ascontiguousarray(square.reshape(total, 64, 64).transpose(2, 0, 1)), axis=2, bitorder="little"
    ).view("<u8").reshape(64, total)
    unused = ~np.packbits((member >= 0).reshape(total, 64), axis=1, bitorder="little").view("<u8").reshape(total)

    # Each fingerprint meets every word of its group.
    times = n_words[group]
    who = np.repeat(np.arange(len(fps)), times)
    word = np.arange(len(who)) - np.repeat(np.cumsum(times) - times, times) + first_word[group][who]
    levels = max(1, int(radius).bit_length())
    spare = (1 << levels) - 1 - radius
    count = [np.full(len(who), ALL if spare >> b & 1 else np.uint64(0)) for b in range(levels)]
    over = unused[word]
    set_bit = np.where(bits.T > 0, ALL, np.uint64(0))

    def add(value: np.ndarray, level: int) -> None:
        for b in range(level, levels):
            value, count[b] = count[b] & value, count[b] ^ value
        np.bitwise_or(over, value, out=over)

    for p in range(0, 64, 3):
        x = [planes[q][word] ^ set_bit[q][who] for q in range(p, min(p + 3, 64))]
        if len(x) == 3:
            half = x[0] ^ x[1]
            add(half ^ x[2], 0)
            carry = (x[0] & x[1]) | (x[2] & half)
            if levels > 1:
                add(carry, 1)
            else:
                np.bitwise_or(over, carry, out=over)
        else:
            for value in x:
                add(value, 0)
        if p % 6 == 3:
            alive = np.flatnonzero(over != ALL)
            if len(alive) < 0.8 * len(over):
                who, word, over = who[alive], word[alive], over[alive]
                count = [c[alive] for c in count]
    alive = np.flatnonzero(over != ALL)
    near = np.unpackbits((~over[alive]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, column = np.nonzero(near)
    i, j = who[alive][row], member[word[alive][row] * 64 + column]
    keep = i < j
    return i[keep], j[keep]


def smallest_reachable(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Each position's smallest label over the links (i, j) between positions."""
    labels = labels.copy()
    while len(i):
        low = np.minimum(labels[i], labels[j])
        if np.array_equal(low, labels[i]) and np.array_equal(low, labels[j]):
            break
        np.minimum.at(labels, i, low)
        np.minimum.at(labels, j, low)
    return labels


def _stars(radius: int, most: int = 100_000):
    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends = lists.offsets.to_numpy()
            flat = lists.flatten()
            fps = flat.field("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            nodes = flat.field("node").to_numpy(zero_copy_only=False)
            ends = ends - ends[0]
            at = 0
            while at < len(ends) - 1:
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
                here = slice(ends[at], ends[to])
                i, j = near_pairs(fps[here], np.diff(ends[at : to + 1]), radius)
                own = nodes[here]
                root = smallest_reachable(own, i, j)
                linked = np.flatnonzero(root != own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[linked], pa.int64()), pa.array(root[linked], pa.int64())], ["a", "b"]
                )
                at = to

    return stars


def links(nodes: DataFrame, radius: int = 3, chunk: int = 1000) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``radius`` bits.

    ``nodes`` has (fp, node), one row per fingerprint.
    """
    keys = F.array(*[
        F.struct(F.lit(t).alias("tab"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for t, m in enumerate(masks(radius))
    ])
    rows = nodes.select("fp", "node", F.explode(keys).alias("_k")).select("_k.tab", "_k.key", "fp", "node")
    groups = group_chunks(rows, ["tab", "key"], "fp", chunk).select("members")
    return groups.mapInArrow(_stars(radius), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, chunk: int = 1000) -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest doc_id reachable over links."""
    fps = stage(fingerprints(docs, shingle), "simhash-fp")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("node"))
    # A fingerprint whose rows have no id still links others: it stands for itself.
    named = stage(nodes.withColumn("n", F.coalesce("node", F.lit(1 << 62) + F.col("fp").bitwiseAND(F.lit((1 << 61) - 1)))), "simhash-nodes")
    found = components(links(named.select("fp", F.col("n").alias("node")), radius, chunk), "simhash-round")
    groups = named.join(found, named["n"] == found["node"], "left").select(
        "fp", F.coalesce("component", "n").alias("component")
    )
    groups = groups.withColumn("component", F.when(F.col("component") < (1 << 62), F.col("component")))
    return fps.join(groups, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
