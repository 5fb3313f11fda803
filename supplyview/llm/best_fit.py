"""Best-fit packing planned on the histogram of lengths.

Every document becomes one piece of its ids and the end id; a longer one than the capacity is
cut into pieces of the capacity, of which the last may be shorter. Three steps:

1. Workers cut, and number the pieces of each length on their own; counts per worker and
   length (one aggregate) shift these numbers into ranks within the length.
2. ``plan`` packs the *histogram*, longest lengths first, each piece into the fullest bin it
   fits (best-fit decreasing). Bins filled alike are one run: a run of n bins with room r takes
   r // l pieces of length l each in one step. The histogram has at most ``capacity`` rows, a
   step leaves at most two runs more than it found, and bins of equal room are equal; so the
   plan's size depends on the capacity, not on the number of documents.
3. A piece takes its planned slot by (length, rank): the last plan row of its length that starts
   at or below its rank, found in the broadcast plan by binary search. Which of the equally
   long pieces takes which slot does not matter.

Null and empty texts are documents of the end id alone. Rows with the same doc_id (or none) are
packed each for itself. Very long texts are cut as told; their ids are made slice by slice,
one text at a time at most. Equally long pieces are taken in the order workers met them. An
empty table gives no pieces; extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyview.session import stage
from supplyview.llm.common import prepared
from supplyview.llm.tokens import slices
from supplyview.llm.word_tokens import default_tokenizer, word_encoder

PIECE = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, worker int, number long"
)
# Ranks stay below this, so length and rank make one sortable number.
RANKS = 1 << 46


def pieces(
    docs: DataFrame,
    capacity: int = 2048,
    tokenizer: str | None = None,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's pieces, numbered by length within each worker."""
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()
    names = [x.split()[0] for x in PIECE.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = TaskContext.get().partitionId()
        numbers: Counter[int] = Counter()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for at, n_rows in slices(texts):
                rows, payload = [], []
                found = word_encoder(path).encode(texts.slice(at, n_rows))
                for key, ids in zip(keys[at : at + n_rows], found):
                    ids = ids.tobytes() + end
                    for n, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        size = len(part) // 4
                        rows.append((key, n, start // 4, size, zlib.crc32(part), worker, numbers[size]))
                        numbers[size] += 1
                        if with_ids:
                            payload.append(part)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                if with_ids:
                    columns.append(pa.array(payload, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, PIECE + ", ids binary" * with_ids
    )


class _Bins:
    """Runs (first bin, number of bins) by room, and the rooms there are in order."""

    def __init__(self):
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []

    def add(self, room: int, first: int, n: int) -> None:
        if n <= 0 or room <= 0:
            return
        if room not in self.runs:
            self.runs[room] = []
            insort(self.rooms, room)
        held = self.runs[room]
        if held and held[-1][0] + held[-1][1] == first:
            first, n = held[-1][0], held.pop()[1] + n
        held.append((first, n))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """The last run of the smallest room of ``least`` or more."""
        at = bisect_left(self.rooms, least)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, n = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room], self.rooms[at]
        return room, first, n


def plan(counts: Mapping[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces a bin, first bin, offset), by length and rank.

    The piece of rank q in [first rank, next row's) lies in bin first + (q - first rank) // pieces a
    bin, behind (q - first rank) % pieces a bin others of its length.
    """
    bins, used, rows = _Bins(), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            run = bins.take(length)
            if run is None:
                # As many new bins as the rest of this length fills.
                run = capacity, used, -(-left // (capacity // length))
                used += run[2]
            room, first, n = run
            each = room // length
            whole = min(n, left // each)
            more = min(left - whole * each, each - 1) if whole < n else 0
            rows.append((length, rank, each, first, capacity - room))
            bins.add(room, first + whole + (more > 0), n - whole - (more > 0))
            bins.add(room - each * length, first, whole)
            if more:
                bins.add(room - more * length, first + whole, 1)
            rank += whole * each + more
            left -= whole * each + more
    table = np.array(rows, np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(docs: DataFrame, capacity: int = 2048, **options) -> DataFrame:
    """Pieces of all documents with sequence_id and offset.

    ``with_ids=True`` keeps each piece's ids (little-endian unsigned 32-bit) as ``ids``.
    """
    prepared(docs.sparkSession)
    cut = stage(pieces(docs, capacity, **options), "best-fit-pieces")
    counts = cut.groupBy("worker", "length").agg(F.count(F.lit(1)).alias("_n"))
    histogram = counts.groupBy("length").agg(F.sum("_n").alias("n"))
    # At most ``capacity`` rows.
    slots = plan({r["length"]: r["n"] for r in histogram.collect()}, capacity)
    starts = slots[:, 0] * RANKS + slots[:, 1]
    earlier = Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("worker", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rest = [c for c in cut.columns if c not in ("worker", "number")]
    ranked = cut.join(shifts, ["worker", "length"]).select(
        *rest, (F.col("_before") + F.col("number")).alias("_rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            row = slots[np.searchsorted(starts, length * RANKS + rank, side="right") - 1]
            within = rank - row[:, 1]
            sequence, offset = row[:, 3] + within // row[:, 2], row[:, 4] + within % row[:, 2] * length
            kept = [batch.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], names=[*rest, "sequence_id", "offset"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.select(*rest).schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")
