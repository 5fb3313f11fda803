"""Harmonic packing of token sequences.

A piece of length l belongs to class k = capacity // l, that is to lengths in
(capacity / (k + 1), capacity / k]; a bin of class k holds exactly k pieces. So a bin is a
piece's number within its class divided by k, and no worker needs to see another's
pieces: workers number theirs on their own, and counts per worker and class shift them.

Documents may be cut: into full sequences first, then the rest is kept whole if a bin of
such pieces would stay filled but for ``waste``; if not, the longest length of the
next class is cut off, which fills its bins, and so on (two or three pieces, mostly).
The last, incomplete bin of each class (fewer than capacity^2 / 2 pieces of fewer than
capacity^2 tokens in total, whatever the input) is emptied and packed best-fit.

Null and empty texts are documents of the end id alone. Rows with the same doc_id are
packed each for itself. An empty table gives no pieces; extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyview.session import stage
from supplyview.llm.common import schema_of
from supplyview.llm.tokens import default_tokenizer, encoder, slices

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "class int, worker int, number long"
)


def cuts(capacity: int, waste: float) -> list[list[int]]:
    """For each rest below ``capacity`` the lengths it is cut into."""
    out: list[list[int]] = [[]]
    for rest in range(1, capacity):
        k = capacity // rest
        if capacity - k * rest <= waste * capacity:
            out.append([rest])
        else:
            first = capacity // (k + 1)
            out.append([first, *out[rest - first]])
    return out


def pieces(
    docs: DataFrame,
    capacity: int = 1024,
    tokenizer: str | None = None,
    end_id: int = 0,
    waste: float = 0.02,
    with_ids: bool = False,
) -> DataFrame:
    """Cut every document's ids (with the end id) into pieces and number them by class."""
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()
    rests = cuts(capacity, waste)
    names = [x.split()[0] for x in PIECE.split(", ")]
    types = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = TaskContext.get().partitionId()
        numbers: Counter[int] = Counter()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for at, n_rows in slices(texts):
                rows, payload = [], []
                found = encoder(path).encode(texts.slice(at, n_rows))
                for key, ids in zip(keys[at : at + n_rows], found):
                    ids = ids.tobytes() + end
                    n = len(ids) // 4
                    start = 0
                    for size in [capacity] * (n // capacity) + rests[n % capacity]:
                        part = ids[4 * start : 4 * (start + size)]
                        k = capacity // size
                        rows.append((key, start, size, zlib.crc32(part), n, k, worker, numbers[k]))
                        if with_ids:
                            payload.append(part)
                        numbers[k] += 1
                        start += size
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                if with_ids:
                    columns.append(pa.array(payload, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, PIECE + ", ids binary" * with_ids
    )


def _best_fit(capacity: int):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "worker"], ascending=[False, True, True, True])
        room: list[tuple[int, int]] = []  # (free tokens, bin)
        bins, offsets, used = [], [], 0
        for size in rows["length"].tolist():
            at = bisect_left(room, (size, -1))
            free, number = room.pop(at) if at < len(room) else (capacity, used)
            used = max(used, number + 1)
            bins.append(number)
            offsets.append(capacity - free)
            if free > size:
                insort(room, (free - size, number))
        return rows.assign(sequence_id=rows["_full"] + bins, offset=offsets)

    return fit


def pack(docs: DataFrame, capacity: int = 1024, **options) -> DataFrame:
    """Pieces of all documents with sequence_id and offset.

    ``with_ids=True`` keeps each piece's ids (little-endian unsigned 32-bit) as ``ids``.
    """
    cut = stage(pieces(docs, capacity, **options), "pack-pieces")
    rest = [c for c in cut.columns if c not in ("class", "worker", "number")]
    counts = cut.groupBy("worker", "class").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    # At most ``capacity`` rows, one per class.
    classes = counts.groupBy("class").agg(F.floor(F.sum("_n") / F.col("class")).alias("_bins"))
    lower = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select(
        "class", "_bins",
        F.coalesce(F.sum("_bins").over(lower), F.lit(0)).alias("_first"),
        F.sum("_bins").over(Window.partitionBy()).alias("_full"),
    )
    numbered = (
        cut.join(shifts.drop("_n"), ["worker", "class"])
        .join(F.broadcast(classes), "class")
        .withColumn("_index", F.col("_before") + F.col("number"))
        .withColumn("_bin", F.floor(F.col("_index") / F.col("class")))
    )
    whole = F.col("_bin") < F.col("_bins")
    inside = Window.partitionBy("sequence_id").orderBy("_index").rowsBetween(Window.unboundedPreceding, -1)
    full = (
        numbered.filter(whole)
        .withColumn("sequence_id", F.col("_first") + F.col("_bin"))
        .withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
        .select(*rest, "sequence_id", "offset")
    )
    # Less than one bin of each class: one group, bounded by the capacity.
    open_pieces = numbered.filter(~whole).select(*rest, "worker", "_full")
    left = (
        open_pieces.groupBy("_full")
        .applyInPandas(_best_fit(capacity), schema_of(open_pieces) + ", sequence_id long, offset long")
        .select(*rest, "sequence_id", "offset")
    )
    return full.unionByName(left)


def sequences(packed: DataFrame, capacity: int = 1024) -> DataFrame:
    """(sequence_id, length, ids) from pieces packed with their ids."""
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts"),
    ).select(
        "sequence_id", "length",
        F.aggregate("_parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
    )
