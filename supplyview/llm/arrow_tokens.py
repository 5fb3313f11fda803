"""Token ids in Arrow files of fixed-size lists: equal-length sequences and masks.

A shard is one Arrow file (the random-access format, uncompressed). Its columns are
fixed_size_list[n] of ``ids`` (uint16 if the vocabulary fits, else uint32), of ``mask`` (uint8: 1 for
a token, 0 for padding) and of ``last`` (bool: ends a document), so row i sits at a
fixed place in its batch and is read without copying. Masks are dictionary-coded: a shard stores the
full one and that of its last sequence once, and rows point to them. The ids of a shard's documents
follow each other without gaps; the last sequence is padded. Next to it lies a file
with (doc_id, start, n_tokens) for each document, start counted in the shard.

Shards follow each other in ascending doc_id order, nulls first, ties by text.
Null and empty texts are documents of the end id alone. An empty table gives no
shard. Rows equal in id and text are documents one after the other. Extra columns are not read. A long text may span any number of sequences.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from supplyview.session import shared_folder, stage
from supplyview.llm.common import parts, text_bytes
from supplyview.llm.tokens import default_tokenizer, encoder, narrowest, slices

SHARD_TEXT_BYTES = 24_000_000
BATCH_SEQUENCES = 256

SHARDS = "shard int, ids_path string, docs_path string, n_docs long, n_tokens long"
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
READ = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int"


def file_system(uri: str):
    """The file system of a folder and its path there; plain paths are local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def publish(files, written: str, name: str) -> None:
    """Give a complete file its name, unless another attempt has done so: both are equal."""
    from pyarrow import fs

    if files.get_file_info(name).type == fs.FileType.NotFound:
        files.move(written, name)
    else:
        files.delete_file(written)


def sequence_schema(length: int, kind: np.dtype) -> pa.Schema:
    masks = pa.dictionary(pa.int8(), pa.list_(pa.uint8(), length))
    return pa.schema([
        ("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", masks), ("last", pa.list_(pa.bool_(), length)),
    ])


class _ShardWriter:
    """Writes ids as they come; keeps less than a batch in memory."""

    def __init__(self, files, path: str, length: int, kind: np.dtype):
        self.length, self.kind = length, kind
        self.schema = sequence_schema(length, kind)
        self.out = files.open_output_stream(path)
        # The last sequence's mask joins the full one when it is known.
        self.writer = pa.ipc.new_file(
            self.out, self.schema, options=pa.ipc.IpcWriteOptions(emit_dictionary_deltas=True)
        )
        self.masks = np.ones(length, np.uint8)
        self.ids: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.held = self.total = self.rest = 0

    def add(self, ids: np.ndarray) -> int:
        self.ids.append(ids.astype(self.kind))
        self.sizes.append(len(ids))
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= BATCH_SEQUENCES * self.length:
            self._flush(False)
        return len(ids)

    def _lists(self, flat: np.ndarray) -> pa.FixedSizeListArray:
        return pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, self.kind)
        # ``rest`` ids were held over from before the documents in ``sizes``.
        ends = np.zeros(len(ids), bool)
        stops = self.rest + np.cumsum(self.sizes, dtype=np.int64) - 1
        ends[stops] = True
        if self.rest:
            ends[: self.rest] = self.rest_ends
        batch = BATCH_SEQUENCES * self.length
        stop = len(ids) // batch * batch
        short = -len(ids) % self.length if last else 0
        if last:
            ids, ends = (np.pad(x, (0, short)) for x in (ids, ends))
            stop = len(ids)
        for at in range(0, stop, batch):
            to = min(at + batch, stop)
            kinds = np.zeros((to - at) // self.length, np.int8)
            if short and to == stop:
                kinds[-1] = 1
                partly = np.arange(self.length) < self.length - short
                self.masks = np.concatenate([self.masks, partly.astype(np.uint8)])
            self.writer.write_batch(pa.record_batch([
                self._lists(ids[at:to]),
                pa.DictionaryArray.from_arrays(pa.array(kinds), self._lists(self.masks)),
                self._lists(ends[at:to]),
            ], schema=self.schema))
        self.ids, self.sizes = [ids[stop:].copy()], []
        self.held = self.rest = len(ids) - stop
        self.rest_ends = ends[stop:].copy()

    def close(self) -> None:
        self._flush(True)
        self.writer.close()
        self.out.close()


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    length: int = 1024,
    end_id: int = 0,
    shard_bytes: int = SHARD_TEXT_BYTES,
) -> DataFrame:
    """Write the ids of (doc_id, text) to ``folder``; one row per shard, with its start.

    ``folder`` must be reachable by all executors. A task writes under a name of its
    attempt and moves the file when complete, so a task that runs again is harmless.
    """
    path = tokenizer or default_tokenizer()
    n = parts(text_bytes(docs), shard_bytes)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number, attempt = context.partitionId(), context.taskAttemptId()
        files, root = file_system(folder)
        writer = index = None
        names = [f"{root}/ids-{number:06d}.arrow", f"{root}/docs-{number:06d}.arrow"]
        n_docs = 0
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            if len(texts) and writer is None:
                files.create_dir(root, recursive=True)
                kind = narrowest(max(encoder(path).vocabulary(), end_id + 1))
                writer = _ShardWriter(files, f"{names[0]}.{attempt}", length, kind)
                stream = files.open_output_stream(f"{names[1]}.{attempt}")
                index = pa.ipc.new_file(stream, DOCS)
            for at, n_rows in slices(texts):
                before = writer.total
                sizes = [
                    writer.add(np.append(x, np.uint32(end_id)))
                    for x in encoder(path).encode(texts.slice(at, n_rows))
                ]
                starts = before + np.cumsum([0, *sizes[:-1]])
                index.write_batch(pa.record_batch(
                    [doc_ids.slice(at, n_rows), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())],
                    schema=DOCS,
                ))
                n_docs += n_rows
        if writer is not None:
            writer.close()
            index.close()
            stream.close()
            for name in names:
                publish(files, f"{name}.{attempt}", name)
            base = folder.rstrip("/")
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([number], pa.int32()),
                "ids_path": [f"{base}/ids-{number:06d}.arrow"],
                "docs_path": [f"{base}/docs-{number:06d}.arrow"],
                "n_docs": pa.array([n_docs], pa.int64()),
                "n_tokens": pa.array([writer.total], pa.int64()),
            })

    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(n, F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
    )
    shards = stage(ordered.mapInArrow(shard, SHARDS), "arrow-shards")
    # One row per shard meets in this window, never documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def open_shard(path: str) -> pa.ipc.RecordBatchFileReader:
    """A shard's reader; local files are mapped, so batches are views of the file."""
    files, at = file_system(path)
    from pyarrow import fs

    source = pa.memory_map(at) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(at)
    return pa.ipc.open_file(source)


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence ``i`` of a shard; of a mapped file neither is copied."""
    batch = reader.get_batch(i // BATCH_SEQUENCES)
    row = i % BATCH_SEQUENCES
    ids = batch.column(0)[row].values.to_numpy(zero_copy_only=True)
    masks = batch.column(1)
    mask = masks.dictionary[masks.indices[row].as_py()].values
    return ids, mask.to_numpy(zero_copy_only=True)


def read(shards: DataFrame) -> DataFrame:
    """The documents of written shards: doc_id, start over all shards, n_tokens, ids_crc32.

    Ids come from the sequences, ends of documents from ``last``; the file of
    documents gives their doc_id in that order.
    """
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = open_shard(row["ids_path"])
                index = open_shard(row["docs_path"])
                keys = (k for b in range(index.num_record_batches)
                        for k in index.get_batch(b).column(0).to_pylist())
                at, crc, size = row["start"], 0, 0
                for b in range(reader.num_record_batches):
                    got = reader.get_batch(b)
                    ids = got.column(0).flatten().to_numpy(zero_copy_only=True).astype("<u4", copy=False)
                    masks = got.column(1)
                    each = masks.dictionary.flatten().to_numpy(zero_copy_only=True)
                    each = each.reshape(len(masks.dictionary), -1).sum(axis=1, dtype=np.int64)
                    # One bit per id: where documents end.
                    last = got.column(2).flatten().to_numpy(zero_copy_only=False)
                    used = int(each[masks.indices.to_numpy()].sum())
                    view = memoryview(ids).cast("B")
                    out, begin = [], 0
                    for stop in (np.flatnonzero(last) + 1).tolist():
                        crc = zlib.crc32(view[4 * begin : 4 * stop], crc)
                        size += stop - begin
                        out.append((next(keys), at, size, crc, row["shard"]))
                        at, crc, size, begin = at + size, 0, 0, stop
                    crc = zlib.crc32(view[4 * begin : 4 * used], crc)
                    size += used - begin
                    columns = list(zip(*out)) if out else [[]] * 5
                    types = [pa.int64()] * 4 + [pa.int32()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types)],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"],
                    )

    n = shards.count()
    return shards.repartition(max(1, n)).mapInArrow(documents, READ)


def round_trip(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Write all documents to a new folder in the shared folder and read them back."""
    folder = f"{shared_folder(spark)}/arrow-tokens-{uuid.uuid4().hex}"
    return read(write(docs, folder, **options))
