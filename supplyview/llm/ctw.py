"""Text scores by context-tree weighting over bytes, and by counted words.

A text is its words (ASCII-lower-cased, split at ASCII white space) joined by single
spaces, and an end. Each byte is eight binary decisions. For each of them every
context of 0 to ``DEPTH`` preceding bytes is a node with two counts, whose
Krichevsky-Trofimov estimate is mixed with the deeper contexts' estimates by the
weights that context-tree weighting gives after the training texts:

    Pw(s) = 1/2 Pe(s) + 1/2 product of Pw over the one byte longer contexts,

so beta(s) = Pe(s) / product, and a decision's probability is
(beta KT + deeper) / (beta + 1). The model is fixed once trained; scoring learns nothing.

As Spark jobs: documents are dealt into blocks of bounded size; a task compresses what it
has for a block before it is shuffled. A block asks for the
distinct (context, byte) grams and words it holds, with its training counts, by bucket
(the two latest context bytes of a gram, a hash of a word). Buckets merge the counts in
rounds of ``FAN`` blocks and weigh all contexts of two and more bytes; the rest of the tree
has at most 65,792 nodes whatever the input and is summed by an ordinary aggregate.
The answers (in 1/4096 bit) go back to the blocks, which sum them by document. Every gram and word of
every text is counted; nothing is pruned or capped.

Null and empty texts are the end alone. Rows without a doc_id train the model and are
scored. Repeated rows count each. Very long texts are scored whole. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyview.session import stage
from supplyview.llm.common import fold, parts, text_bytes

DEPTH = 6
BLOCK_BYTES = 16_000_000
BUCKET_BYTES = 4_000_000
PACK_BYTES = 16_000_000
JOIN_BYTES = 4_000_000
STEP_BYTES = 500_000
STEP_ROWS = 255
# Distinct grams that may wait for the next merge within a block.
WAITING = 500_000
FAN = 64

REQUEST = "block int, bucket int, grams binary, counts binary, words binary, word_counts binary"
MERGED = REQUEST.replace("block int", "salt int")
TREE = "bucket int, grams binary, deep binary, words binary, word_counts binary, top binary, n_train long, n_words long"
ANSWER = "block int, grams binary, log2p binary, words binary, word_counts binary"
PACKED = "block int, doc_ids array<long>, trains array<boolean>, sizes array<int>, data binary"
# Steps of a bit in which answers are rounded.
GRAIN = 4096


# Packed columns of numbers and words.

def squeeze(values: np.ndarray) -> bytes:
    """Bytes of equal rank side by side, then compressed."""
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize)
    return zstandard.compress(flat.T.tobytes(), 1)


def expand(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(flat.T).view(dtype).ravel()


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, "<u8"), dtype=np.uint64)


def one_text(data: bytes) -> pa.Array:
    """An array of one string, taken as it is."""
    ends = np.array([0, len(data)], np.int32)
    return pa.StringArray.from_buffers(1, pa.py_buffer(ends), pa.py_buffer(data))


def squeeze_words(words: pa.Array) -> bytes:
    """Words hold no white space; the end is the empty word."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")
    return zstandard.compress(joined[0].as_buffer().to_pybytes(), 1)


def expand_words(data: bytes, n: int) -> pa.Array:
    if not n:
        return pa.array([], pa.string())
    return pc.split_pattern(one_text(zstandard.decompress(data)), "\n").flatten()


# Documents by block.

def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, doc_id, train, text) as one compressed row per block, now and then."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PACK_BYTES:
            yield from _packs(held)
            held, size = [], 0
    yield from _packs(held)


def _packs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in held if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    block = rows.column("block").to_numpy()
    order = np.argsort(block, kind="stable")
    block, rows = block[order], rows.take(pa.array(order))
    texts = one_array(pc.fill_null(rows.column("text"), ""))
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2] or b"")
    starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    edges = np.append(starts, len(block))
    by_block = pa.array(edges, pa.int32())
    compress = zstandard.ZstdCompressor(level=1).compress
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(block[starts], pa.int32()),
            pa.ListArray.from_arrays(by_block, one_array(rows.column("doc_id"))),
            pa.ListArray.from_arrays(by_block, one_array(rows.column("train"))),
            pa.ListArray.from_arrays(by_block, pa.array(np.diff(ends), pa.int32())),
            pa.array([compress(data[ends[a] : ends[b]]) for a, b in zip(edges, edges[1:])], pa.binary()),
        ],
        names=[x.split()[0] for x in PACKED.split(", ")],
    )


def unpacked(packs: pa.Table) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """doc_ids, trains and texts of a block."""
    sizes = one_array(packs.column("sizes")).flatten().to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    data = b"".join(zstandard.decompress(x) for x in packs.column("data").to_pylist())
    texts = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(data))
    trains = one_array(packs.column("trains")).flatten().to_numpy(zero_copy_only=False)
    return one_array(packs.column("doc_ids")).flatten(), trains, texts


# Texts to words and grams.

def one_array(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def tokens(texts: pa.Array) -> pa.ListArray:
    """Each text's words and the end (an empty word)."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    cut = pc.ascii_split_whitespace(trimmed)
    # The end follows every text; an empty text splits into one empty word, which is the end.
    bare = pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
    lengths = pc.list_value_length(cut).to_numpy().astype(np.int64) + ~bare
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    source = np.ones(offsets[-1], bool)
    source[offsets[1:] - 1] = bare
    index = np.cumsum(source) - 1
    flat = cut.flatten()
    with_ends = flat.take(pa.array(index, mask=~source))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pc.fill_null(with_ends, ""))


def streams(listed: pa.ListArray) -> list[bytes]:
    """Words joined by spaces; the empty last word leaves a space, which becomes the end."""
    joined = pc.binary_join(listed, " ").cast(pa.large_binary()).to_pylist()
    return [(x[:-1] if x else x) + b"\n" for x in joined]


def grams(texts: list[bytes], before: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with its context as a number, and the bytes per text.

    The latest context byte leads, the byte itself is last. ``before`` holds the
    DEPTH + 1 bytes in front of each text; by default line feeds.
    """
    width = DEPTH + 1
    sizes = np.array([len(x) for x in texts], np.int64)
    fronts = [b"\n" * width] * len(texts) if before is None else before
    data = b"".join(x for pair in zip(fronts, texts) for x in pair)
    n = len(data) - 7
    window = np.ndarray((max(n, 0),), "<u8", data, strides=(1,))
    at = np.repeat(np.arange(1, len(texts) + 1) * width - 7, sizes) + np.arange(sizes.sum())
    got = window[at]
    return (got & np.uint64(0x00FFFFFFFFFFFF00)) | (got >> np.uint64(56)), sizes


def pieces(lines: list[bytes]) -> Iterator[tuple[list[bytes], list[bytes], np.ndarray]]:
    """Bounded runs of (texts, what stands before them, number of the line); long lines are cut."""
    front = b"\n" * (DEPTH + 1)
    texts: list[bytes] = []
    before: list[bytes] = []
    numbers: list[int] = []
    size = 0
    for i, line in enumerate(lines):
        for at in range(0, max(len(line), 1), STEP_BYTES):
            if texts and (size + len(line) - at > STEP_BYTES or len(texts) >= STEP_ROWS):
                yield texts, before, np.array(numbers)
                texts, before, numbers, size = [], [], [], 0
            texts.append(line[at : at + STEP_BYTES])
            before.append(line[at - DEPTH - 1 : at] if at else front)
            numbers.append(i)
            size += len(texts[-1])
    if texts:
        yield texts, before, np.array(numbers)


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with their number, or with the sum of their weights."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    if weights is None:
        return keys[starts], np.diff(np.append(starts, len(keys)))
    sums = np.add.reduceat(weights, starts) if len(keys) else weights
    return keys[starts], sums


def steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of runs of texts with about ``JOIN_BYTES`` each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    number = np.cumsum(sizes) // JOIN_BYTES
    starts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(sizes)] if len(sizes) else []
    for a, b in zip(starts, starts[1:]):
        yield a, b - a


def gram_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of the two latest context bytes, so deeper contexts stay together."""
    two = keys >> np.uint64(8 * (DEPTH - 1))
    return ((two * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16)


def word_bucket(words: pa.Array, buckets: int) -> np.ndarray:
    """Bucket by the length and the first and last eight bytes."""
    words = pa.concat_arrays([words]) if words.offset else words
    ends = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64)
    size = np.diff(ends)
    data = bytes(8) + (words.buffers()[2] or pa.py_buffer(b"")).to_pybytes() + bytes(8)
    window = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    unused = (8 * (8 - np.minimum(size, 8))).astype(np.uint64)
    # A shift by all 64 bits is none, so empty words are set apart.
    first = np.where(size > 0, window[ends[:-1] + 8] << unused, 0)
    last = np.where(size > 0, window[ends[1:]] >> unused, 0)
    mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (last * np.uint64(0xC2B2AE3D27D4EB4F)) ^ size.astype(np.uint64)
    return ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % buckets


def _requests(buckets: int):
    names = [x.split()[0] for x in REQUEST.split(", ")]

    def requests(key: tuple, rows: pa.Table) -> pa.Table:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        _, trains, texts = unpacked(rows)
        all_words, totals = pa.array([], pa.string()), np.zeros(0, np.int64)
        for at, n in steps(texts):
            listed, train = tokens(texts.slice(at, n)), trains[at : at + n]
            flat = listed.flatten().dictionary_encode()
            per_word = np.repeat(train, pc.list_value_length(listed).to_numpy())
            # Sums in double precision are exact up to 2^53.
            seen = np.bincount(flat.indices.to_numpy(), per_word, len(flat.dictionary))
            all_words, totals = _merged_words([all_words, flat.dictionary], [totals, seen])
            del flat, per_word
            lines = streams(listed)
            for learn in (True, False):
                some = [x for x, t in zip(lines, train.tolist()) if t == learn]
                for run, before, _ in pieces(some):
                    k, c = counted(grams(run, before)[0])
                    waiting.append((k, c if learn else np.zeros(len(c), np.int64)))
                    if sum(len(k) for k, _ in waiting) > WAITING:
                        keys, counts = _added(keys, counts, *_merged(waiting))
                        waiting = []
        if waiting:
            keys, counts = _added(keys, counts, *_merged(waiting))
        del texts, waiting
        own = gram_bucket(keys, buckets)
        order = np.argsort(own, kind="stable")
        own, keys, counts = own[order], keys[order], counts[order]
        del order
        edges = np.searchsorted(own, np.arange(buckets + 1))
        wb = word_bucket(all_words, buckets)
        word_order = np.argsort(wb, kind="stable")
        word_edges = np.searchsorted(wb[word_order], np.arange(buckets + 1))
        all_words, totals = all_words.take(pa.array(word_order)), totals[word_order]
        out = []
        for b in range(buckets):
            g, w = slice(edges[b], edges[b + 1]), slice(word_edges[b], word_edges[b + 1])
            if g.start < g.stop or w.start < w.stop:
                out.append((
                    key[0].as_py(), b, squeeze_sorted(keys[g]), squeeze(counts[g]),
                    squeeze_words(all_words.slice(w.start, w.stop - w.start)), squeeze(totals[w]),
                ))
        return _rows(out, names)

    return requests


def _merged(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return counted(np.concatenate([k for k, _ in lists]), np.concatenate([c for _, c in lists]))


def _added(
    keys: np.ndarray, counts: np.ndarray, more: np.ndarray, times: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts, and others added to them."""
    at = np.searchsorted(keys, more)
    known = np.zeros(len(more), bool)
    inside = at < len(keys)
    known[inside] = keys[at[inside]] == more[inside]
    counts[at[known]] += times[known]
    new = ~known
    return np.insert(keys, at[new], more[new]), np.insert(counts, at[new], times[new])


def _merged_words(words: list[pa.Array], counts: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    if not words:
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    joined = pa.concat_arrays(words).dictionary_encode()
    # Sums in double precision are exact up to 2^53.
    sums = np.bincount(joined.indices.to_numpy(), np.concatenate(counts), len(joined.dictionary))
    return joined.dictionary, sums.astype(np.int64)


def _rows(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    kinds = {"block": pa.int32(), "salt": pa.int32(), "bucket": pa.int32(), "n_train": pa.int64(), "n_words": pa.int64()}
    return pa.table([pa.array(c, kinds.get(n, pa.binary())) for c, n in zip(columns, names)], names=names)


def _merge(key: tuple, rows: pa.Table) -> pa.Table:
    """One row of summed counts for a (bucket, salt)."""
    got = rows.to_pylist()
    keys, counts = _merged([(expand_sorted(r["grams"]), expand(r["counts"], "<i8")) for r in got])
    words, totals = [], []
    for r in got:
        totals.append(expand(r["word_counts"], "<i8"))
        words.append(expand_words(r["words"], len(totals[-1])))
    word, total = _merged_words(words, totals)
    row = (
        key[1].as_py(), key[0].as_py(), squeeze_sorted(keys), squeeze(counts), squeeze_words(word), squeeze(total),
    )
    return _rows([row], [x.split()[0] for x in MERGED.split(", ")])


# The tree.

def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma by Stirling's series, shifted to where it holds to 1e-13."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(10):
        low = y < 10
        if not low.any():
            break
        shift[low] -= np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series


SMALL = 4096
_HALF, _WHOLE = (log_gamma(np.arange(SMALL) + x) for x in (0.5, 1.0))


def _log_gamma_of(count: np.ndarray, table: np.ndarray, shift: float) -> np.ndarray:
    """log Gamma(count + shift): most counts are small and looked up."""
    out = table[np.minimum(count, SMALL - 1).astype(np.int64)]
    large = np.flatnonzero(count >= SMALL)
    out[large] = log_gamma(count[large] + shift)
    return out


def log_pe(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    shape = a.shape
    a, b = a.ravel(), b.ravel()
    out = _log_gamma_of(a, _HALF, 0.5) + _log_gamma_of(b, _HALF, 0.5) - _log_gamma_of(a + b, _WHOLE, 1.0)
    return (out - np.log(np.pi)).reshape(shape)


def own_weight(log_beta: np.ndarray) -> np.ndarray:
    """beta / (beta + 1)."""
    return 1 / (1 + np.exp(-np.clip(log_beta, -500, 500)))


def deep_tree(keys: np.ndarray, counts: np.ndarray, least: int = 2):
    """Estimates of each gram's decisions mixed over contexts of ``least`` bytes and more.

    Also, per binary node of the contexts one byte shorter than ``least`` (numbered
    by node): zeros, ones, and the sum of log Pw over the longer contexts.
    """
    keys = keys.astype(np.int64)
    # By depth from the longest: (context, byte) numbers, their counts, and each one's place in the next.
    levels: list[list] = []
    for d in range(DEPTH, least - 1, -1):
        if not levels:
            levels.append([keys, np.asarray(counts, float), None])
            continue
        longer = levels[-1][0]
        u, place = np.unique(longer >> 16 << 8 | longer & 255, return_inverse=True)
        levels[-1][2] = place
        levels.append([u, np.bincount(place, weights=levels[-1][1], minlength=len(u)), None])
    mixed = np.zeros((len(keys), 8))
    top = []
    for j in range(8 if len(keys) else 0):
        below, found = None, []
        for u, c, _ in levels:
            # A node is a context and the j bits of the byte that are known.
            node_of = u >> (8 - j)
            first = np.concatenate([[True], node_of[1:] != node_of[:-1]])
            starts = np.flatnonzero(first)
            nodes, number = node_of[starts], np.cumsum(first) - 1
            bit = u >> (7 - j) & 1
            total, ones = np.add.reduceat(c, starts), np.add.reduceat(c * bit, starts)
            zeros = total - ones
            own = log_pe(zeros, ones)
            kt = (np.where(bit == 1, ones[number], zeros[number]) + 0.5) / (total[number] + 1)
            if below is None:
                weighted, weight = own, None
            else:
                shorter = below[0] >> (j + 8) << j | below[0] & ((1 << j) - 1)
                product = np.bincount(np.searchsorted(nodes, shorter), weights=below[1], minlength=len(nodes))
                weight = own_weight(own - product)[number]
                weighted = np.logaddexp(own, product) - np.log(2)
            found.append((kt, weight))
            below = nodes, weighted, zeros, ones
        # From the shortest context on: estimate = given + rest * the longer context's estimate.
        given, rest = np.zeros(len(levels[-1][0])), np.ones(len(levels[-1][0]))
        for n in range(len(levels) - 1, 0, -1):
            kt, weight = found[n]
            given, rest = given + rest * weight * kt, rest * (1 - weight)
            place = levels[n - 1][2]
            given, rest = given[place], rest[place]
        mixed[:, j] = given + rest * found[0][0]
        shorter = below[0] >> (j + 8) << 8 | 1 << j | below[0] & ((1 << j) - 1)
        at, inverse = np.unique(shorter, return_inverse=True)
        top.append((at, *(np.bincount(inverse, weights=x) for x in (below[2], below[3], below[1]))))
    parts_ = [np.concatenate([t[i] for t in top]) if top else np.zeros(0) for i in range(4)]
    return mixed, parts_


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            keys, counts = expand_sorted(r["grams"]), expand(r["counts"], "<i8")
            mixed, top = deep_tree(keys, counts)
            totals = expand(r["word_counts"], "<i8")
            row = (
                r["bucket"], r["grams"], squeeze(mixed.astype("<f4").ravel()), r["words"], r["word_counts"],
                np.array(top, "<f8").tobytes(), int(totals.sum()), int((totals > 0).sum()),
            )
            yield from _rows([row], [x.split()[0] for x in TREE.split(", ")]).to_batches()


def _top_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0).to_pylist():
            node, zeros, ones, weighted = np.frombuffer(data, "<f8").reshape(4, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node.astype(np.int32)), pa.array(zeros.astype(np.int64)),
                 pa.array(ones.astype(np.int64)), pa.array(weighted)],
                ["node", "zeros", "ones", "weighted"],
            )


class Top:
    """The contexts of one byte and of none: (context, node) tables of KT counts and weights."""

    def __init__(self, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray):
        self.counts = np.zeros((2, 257, 256))
        product = np.zeros((257, 256))
        for x, y in ((self.counts[0], zeros), (self.counts[1], ones), (product, weighted)):
            x[:256].ravel()[node] = y
        self.counts[:, 256] = self.counts[:, :256].sum(axis=1)
        own = log_pe(*self.counts)
        product[256] = (np.logaddexp(own[:256], product[:256]) - np.log(2)).sum(axis=0)
        self.weight = own_weight(own - product)

    def log2p(self, keys: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """log2 of each gram's probability, given the estimates of the longer contexts."""
        latest, byte = (keys >> np.uint64(8 * DEPTH)).astype(np.int64), (keys & np.uint64(255)).astype(np.int64)
        out = np.zeros(len(keys))
        for j in range(8):
            node, bit = 1 << j | byte >> (8 - j), byte >> (7 - j) & 1
            p = mixed[:, j].astype(float)
            for context in (latest, 256):
                zeros, ones = self.counts[0, context, node], self.counts[1, context, node]
                kt = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
                weight = self.weight[context, node]
                p = weight * kt + (1 - weight) * p
            out += np.log2(p)
        return out


def _answers(top):
    names = [x.split()[0] for x in ANSWER.split(", ")]

    def answers(key: tuple, asked: pa.Table, trees: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return _rows([], names)
        tree = trees.to_pylist()[0]
        keys = expand_sorted(tree["grams"])
        log2p = top.value.log2p(keys, expand(tree["deep"], "<f4").reshape(-1, 8))
        rounded = np.round(log2p * GRAIN).astype("<i4")
        totals = expand(tree["word_counts"], "<i8")
        words = expand_words(tree["words"], len(totals))
        out = []
        for r in asked.to_pylist():
            n = len(expand(r["word_counts"], "<i8"))
            own = expand_words(r["words"], n)
            at = pc.index_in(own, value_set=words).to_numpy(zero_copy_only=False) if n else np.zeros(0, int)
            out.append((
                r["block"], r["grams"], squeeze(rounded[np.searchsorted(keys, expand_sorted(r["grams"]))]),
                r["words"], squeeze(totals[at.astype(np.int64)]),
            ))
        return _rows(out, names)

    return answers


SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"


def _scored(n_train: int, n_words: int):
    names = [x.split()[0] for x in SCORED.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.float64()] * 3
    whole = np.log10(n_train + 0.5 * (n_words + 1))

    def scored(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        keys, logs, known, totals = [], [], [], []
        for r in answers.to_pylist():
            keys.append(expand_sorted(r["grams"]))
            logs.append(expand(r["log2p"], "<i4"))
            totals.append(expand(r["word_counts"], "<i8"))
            known.append(expand_words(r["words"], len(totals[-1])))
        key, log = np.concatenate(keys), np.concatenate(logs)
        del keys, logs
        order = np.argsort(key)
        key, log = key[order], log[order]
        del order
        word, total = pa.concat_arrays(known), np.concatenate(totals)
        del known, totals
        doc_ids, _, texts = unpacked(docs)
        n_tokens, n_known = (np.zeros(len(texts), np.int64) for _ in range(2))
        base = np.zeros(len(texts))
        bits, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for at, n in steps(texts):
            listed = tokens(texts.slice(at, n))
            flat = listed.flatten().dictionary_encode()
            c = total[pc.index_in(flat.dictionary, value_set=word).to_numpy()]
            starts, at_word, here = listed.offsets.to_numpy()[:-1], flat.indices.to_numpy(), slice(at, at + n)
            n_tokens[here] = pc.list_value_length(listed).to_numpy()
            base[here] = np.add.reduceat((np.log10(c + 0.5) - whole)[at_word], starts)
            n_known[here] = np.add.reduceat((c > 0).astype(np.int64)[at_word], starts)
            del flat, at_word
            for run, before, number_of in pieces(streams(listed)):
                number, size = grams(run, before)
                # Distinct (gram, piece) with their number: the piece is the last byte.
                pair, times = counted(number << np.uint64(8) | np.repeat(np.arange(len(run), dtype=np.uint64), size))
                gram, of_pieces = counted(pair >> np.uint64(8))
                gain = np.repeat(log[np.searchsorted(key, gram)], of_pieces) * times
                own = np.bincount((pair & np.uint64(255)).astype(np.int64), gain, len(run)) / GRAIN
                np.add.at(bits, at + number_of, own)
                np.add.at(sizes, at + number_of, size)
        columns = [n_tokens, n_known, base, bits * np.log10(2), -bits / sizes]
        return pa.table(
            [doc_ids, *(pa.array(c, k) for c, k in zip(columns, kinds[1:]))], names=names
        )

    return scored


def score(docs: DataFrame, remainder: int = 1, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Texts whose fold is not ``remainder`` train. ``score`` is log10 of the text's probability by
    the tree, ``base_score`` that of its words by counts with 1/2 added.
    """
    spark = docs.sparkSession
    total = text_bytes(docs)
    n_blocks = parts(total, block_bytes)
    buckets = min(4096, parts(total, BUCKET_BYTES, 8))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        (fold(F.col("doc_id")) != remainder).alias("train"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int").alias("block"),
    )
    salted = F.floor(F.col("block") / fan).cast("int")
    packed = rows.select("block", "doc_id", "train", "text").mapInArrow(_packed, PACKED)
    requests = stage(packed.groupBy("block").applyInArrow(_requests(buckets), REQUEST), "ctw-requests")
    merged = requests.withColumn("salt", salted)
    salts = parts(n_blocks, fan)
    while True:
        merged = merged.groupBy("bucket", "salt").applyInArrow(_merge, MERGED)
        if salts == 1:
            break
        merged = merged.withColumn("salt", F.floor(F.col("salt") / fan).cast("int"))
        salts = parts(salts, fan)
    trees = stage(merged.mapInArrow(_trees, TREE), "ctw-trees")
    sizes = trees.agg(F.sum("n_train"), F.sum("n_words")).first()
    n_train, n_words = int(sizes[0] or 0), int(sizes[1] or 0)
    # At most 256 contexts of 255 nodes each.
    top = (
        trees.select("top").mapInArrow(_top_rows, "node int, zeros long, ones long, weighted double")
        .groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted"))
        .toPandas()
    )
    shared = spark.sparkContext.broadcast(Top(*(top[c].to_numpy() for c in ("node", "zeros", "ones", "weighted"))))
    dealt = trees.select("bucket", "grams", "deep", "words", "word_counts").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(parts(n_blocks, fan) - 1)))
    )
    answers = (
        requests.withColumn("salt", salted).groupBy("bucket", "salt")
        .cogroup(dealt.groupBy("bucket", "salt"))
        .applyInArrow(_answers(shared), ANSWER)
    )
    scored = (
        packed.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_scored(n_train, n_words), SCORED)
    )
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == remainder).alias("held_out"),
        "n_tokens", "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        "base_score", "score", "bits_per_byte",
    )
