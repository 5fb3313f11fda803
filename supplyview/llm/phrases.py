"""Phrase collocations counted in a prefix-free parse.

1. *Parse.* A text is a sequence of words and separators (a run of ``.,;:!?`` and line ends is one
   separator, and two end the text). Wherever a window of ``longest - 1`` tokens hashes to
   0 modulo ``PERIOD``, a chunk ends with that window and the next one starts with it. Triggers depend
   on content alone, so copies and shared passages fall into the same chunks; the
   dictionary holds each distinct chunk of a language once, with its number of occurrences.
2. *Counts.* n-grams are counted inside distinct chunks, weighted by their frequency. One that starts
   in a chunk's last ``longest - 1`` tokens belongs to the next chunk, so overlaps count once.
   Single words and pairs come from one pass over the dictionary; longer phrases of m words take a pass
   each and look only at places whose two parts of m - 1 words may be frequent: a bitmap of
   ``FILTER_BITS`` bits (fixed size; broadcast) marks them. Beyond its capacity it spares less
   work; counts stay exact. Per-batch sums meet in one aggregate by (language, phrase).
3. *Scores* are joins of frequent phrases with their parts, in exact decimals. The best of a
   language are taken in shares by hash first, so no task gets a language's phrases.

Null texts are empty, a null language is ``und``. Texts without words give nothing; rows with the same id are
counted each. A stretch without a trigger is cut after ``LONGEST_CHUNK`` tokens, so very long texts
give many chunks. Ties of score and count go by the phrase's bytes. An empty table gives no rows;
columns other than text and lang are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyview.session import stage
from supplyview.llm.common import prepared
from supplyview.llm.tokens import slices

UNKNOWN = "und"
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
SEPARATOR = "."
CAPITALS = bytes(range(65, 91))
PLAIN = bytes.maketrans(
    SEPARATORS + b"\t" + CAPITALS, SEPARATOR.encode() * len(SEPARATORS) + b" " + CAPITALS.lower()
)
BLANK = pa.scalar(" ", pa.large_string())
PERIOD = 32
LONGEST_CHUNK = 4096
# Text that is parsed or counted at a time in a worker.
PARSE_BYTES, COUNT_BYTES = 8_000_000, 16_000_000
FILTER_BITS = 1 << 27
# Odd multipliers that mix hashes.
MIX, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

CHUNKS = "lang string, chunk string, n long"
GRAMS = "lang string, size int, phrase string, n long"


def _tokens(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words and separators of plain texts, and how many tokens lie before each text."""
    cut = pc.split_pattern(texts, " ")
    flat = cut.flatten()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    offsets = cut.offsets.to_numpy().astype(np.int64)
    return flat.filter(pa.array(full)).dictionary_encode(), before[offsets - offsets[0]]


def _plain(texts: pa.Array) -> pa.Array:
    """Lower case, blanks between words, spaced separators; every changed byte is ASCII."""
    texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    same = (data.to_pybytes()[at[0] : at[-1]] if data else b"").translate(PLAIN)
    plain = pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(same)
    )
    return pc.replace_substring(plain, SEPARATOR, f" {SEPARATOR} ")


def _hashes(words: list[str], seeds: list[int] | None = None) -> np.ndarray:
    """A hash of each word; with several seeds, for equal shares of the words."""
    seeds = seeds or [0]
    each = repeat(seeds[0]) if len(seeds) == 1 else np.repeat(seeds, len(words) // len(seeds)).tolist()
    raw = np.fromiter((zlib.crc32(w.encode(), seed) for w, seed in zip(words, each)), np.uint64, len(words))
    mixed = (raw + np.uint64(1)) * MIX
    return mixed ^ (mixed >> np.uint64(29))


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    sizes = ends - starts
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return np.arange(sizes.sum()) + shift


def parse(texts: pa.Array, overlap: int, period: int, longest: int) -> tuple[pa.Array, np.ndarray]:
    """All chunks of the texts, and which text each is of.

    Chunks end with the ``overlap`` tokens the next one starts with, the last one with
    ``overlap`` separators.
    """
    words, bounds = _tokens(_plain(texts))
    names = words.dictionary.to_pylist()
    if SEPARATOR not in names:
        names.append(SEPARATOR)
    mark = names.index(SEPARATOR)
    ids = words.indices.to_numpy().astype(np.int64)
    # One separator for a run of them, none in front of a text, and the end of the text.
    own = np.repeat(np.arange(len(texts)), np.diff(bounds))
    first = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
    previous = np.concatenate([[mark], ids[:-1]]) if len(ids) else ids
    kept = (ids != mark) | ~(first | (previous == mark))
    ids, own = ids[kept], own[kept]
    sizes = np.bincount(own, minlength=len(texts))
    ends = np.cumsum(sizes)
    ids = np.insert(ids, np.repeat(ends, overlap), mark)
    full = np.where(sizes > 0, sizes + overlap, overlap)
    stops = np.cumsum(full)
    begins = stops - full
    # Windows that start at a token, hashed by content.
    code = _hashes(names)[ids]
    mixed = np.zeros(len(ids), np.uint64)
    for i in range(overlap):
        mixed[: len(ids) - i] = mixed[: len(ids) - i] * SPREAD + code[i:]
    mixed ^= mixed >> np.uint64(31)
    cut = mixed % np.uint64(period) == 0
    cut[np.concatenate([_ranges(stops - overlap, stops), begins])] = False
    cut[begins[sizes > 0]] = True
    starts = np.flatnonzero(cut)
    # The end of a chunk's own tokens: the next start, or the end of the text.
    text = np.searchsorted(begins, starts, side="right") - 1
    limit = stops[text] - overlap
    until = np.minimum(np.append(starts[1:], len(ids)), limit)
    steps = np.maximum(1, -(-(until - starts) // longest))
    again = np.repeat(np.arange(len(starts)), steps)
    starts = starts[again] + longest * (np.arange(len(again)) - np.repeat(np.cumsum(steps) - steps, steps))
    until, text = np.minimum(starts + longest, until[again]), text[again]
    tokens = pa.array(names, pa.large_string()).take(pa.array(ids[_ranges(starts, until + overlap)]))
    sizes = np.concatenate([[0], np.cumsum(until + overlap - starts)])
    lists = pa.LargeListArray.from_arrays(pa.array(sizes, pa.int64()), tokens)
    return pc.binary_join(lists, BLANK), text


def dictionary(docs: DataFrame, text: str, lang: str, longest: int) -> DataFrame:
    """(lang, chunk, n): the distinct chunks of each language and how often they occur."""
    period, most = PERIOD, LONGEST_CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n_rows in slices(batch.column(1), PARSE_BYTES):
                part = batch.slice(at, n_rows)
                chunks, own = parse(part.column(1), longest - 1, period, most)
                langs = part.column(0).dictionary_encode()
                rows = pa.table({"lang": langs.take(pa.array(own)).cast(pa.string()), "chunk": chunks})
                counted = rows.group_by(["lang", "chunk"]).aggregate([([], "count_all")])
                counted = counted.rename_columns(["lang", "chunk", "n"])
                yield from counted.cast(
                    pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("n", pa.int64())])
                ).combine_chunks().to_batches()

    named = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")
    )
    return named.mapInArrow(run, CHUNKS).groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def _slots(codes: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for phrases whose words have these codes."""
    mixed = functools.reduce(lambda a, b: a * SPREAD + b, codes)
    mixed = mixed ^ (mixed >> np.uint64(32))
    again = mixed * MIX
    return (mixed % np.uint64(bits)).astype(np.int64), ((again >> np.uint64(20)) % np.uint64(bits)).astype(np.int64)


def _seed(lang: str) -> int:
    return zlib.crc32(lang.encode())


def marked(frequent: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The bitmap of frequent phrases, by words of 64 bits; its size is fixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            langs, phrases = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            seeds = {x: _seed(x) for x in set(langs)}
            codes = _hashes([w for p in phrases for w in p.split(" ")], [seeds[x] for x in langs])
            slots = np.unique(np.concatenate(_slots(list(codes.reshape(len(phrases), -1).T), bits)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots >> 6), pa.array(np.left_shift(np.int64(1), slots & 63))], names=["word", "bit"]
            )

    words = frequent.select("lang", "phrase").mapInArrow(run, "word long, bit long")
    # At most bits / 64 rows of 16 bytes.
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _marked_at(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1) > 0


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, and the sum of its weights."""
    order = np.argsort(keys)
    ordered = keys[order]
    bounds = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return order[bounds], np.add.reduceat(weights[order], bounds)


def _counted(lang: str, chunks: pa.Array, n: np.ndarray, longest: int, sizes: range, bitmap) -> Iterator[pa.RecordBatch]:
    """(lang, size, phrase, n) of the phrases of ``sizes`` words in chunks of one language."""
    words, bounds = _tokens(chunks)
    ids = words.indices.to_numpy().astype(np.int64)
    names = words.dictionary
    mark = pc.index(names, pa.scalar(SEPARATOR, names.type)).as_py()
    weights = np.repeat(n, np.diff(bounds))
    # A chunk's last tokens start nothing; they are the next chunk's first ones.
    starts = np.ones(len(ids), bool)
    starts[_ranges(bounds[1:] - (longest - 1), bounds[1:])] = False
    at = np.flatnonzero(starts & (ids != mark))
    codes = None
    if bitmap is not None:
        codes = _hashes(names.to_pylist(), [_seed(lang)])
    for size in sizes:
        for i in range(1, size):
            at = at[ids[at + i] != mark]
        if bitmap is not None:
            for shift in (0, 1):
                found = _slots([codes[ids[at + shift + i]] for i in range(size - 1)], bitmap.size << 6)
                at = at[_marked_at(bitmap, found[0]) & _marked_at(bitmap, found[1])]
        if not len(at):
            continue
        keys = ids[at]
        for i in range(1, size):
            if i > 1:  # dense numbers, so that keys stay within 64 bits
                keys = np.unique(keys, return_inverse=True)[1]
            keys = keys * len(names) + ids[at + i]
        first, sums = _summed(keys, weights[at])
        parts = [names.take(pa.array(ids[at[first] + i])) for i in range(size)]
        phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, BLANK)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(first)), pa.array(np.full(len(first), size, np.int32)),
             phrase.cast(pa.string()), pa.array(sums)],
            names=["lang", "size", "phrase", "n"],
        )


def grams(chunks: DataFrame, longest: int, sizes: range, bitmap: np.ndarray | None = None) -> DataFrame:
    """(lang, size, phrase, n) of all phrases of these sizes; with a bitmap, of those whose
    parts it marks."""
    shared = None if bitmap is None else chunks.sparkSession.sparkContext.broadcast(bitmap)

    def count(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        langs = rows["lang"].combine_chunks().dictionary_encode()
        order = np.argsort(langs.indices.to_numpy(), kind="stable")
        ends = np.cumsum(np.bincount(langs.indices.to_numpy(), minlength=len(langs.dictionary)))
        for lang, a, b in zip(langs.dictionary.to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
            part = rows.take(pa.array(order[a:b]))
            texts = part["chunk"].combine_chunks().cast(pa.large_string())
            yield from _counted(
                lang, texts, part["n"].to_numpy(), longest, sizes, None if shared is None else shared.value
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= COUNT_BYTES:
                yield from count(held)
                held, size = [], 0
        if held:
            yield from count(held)

    counted = chunks.select("lang", "chunk", "n").mapInArrow(run, GRAMS)
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def scores(counts: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of all candidates, the lowest-scoring cut of each.

    ``counts`` holds every word, and of longer phrases all that occur ``least`` times.
    """
    frequent = counts.filter(F.col("n") >= least)
    known = frequent.select("lang", F.col("phrase").alias("_part"), F.col("n").alias("_f"))
    words = F.split("phrase", " ", -1)
    cuts = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("_k")
    cut = frequent.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), cuts)
    cut = cut.withColumns({
        "_left": F.concat_ws(" ", F.slice(words, F.lit(1), F.col("_k"))),
        "_right": F.concat_ws(" ", F.slice(words, F.col("_k") + 1, F.col("size") - F.col("_k"))),
    })
    left = known.withColumnsRenamed({"_part": "_left", "_f": "l"})
    right = known.withColumnsRenamed({"_part": "_right", "_f": "r"})
    met = cut.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
    # Products of 38 digits; counts up to 10^15.
    score = F.expr(
        "(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(18,0)))"
    )
    lowest = met.withColumn("_score", score).groupBy("lang", "phrase", "size", "a").agg(
        F.min(F.struct("_score", "_k", "l", "r")).alias("_best")
    )
    return lowest.select("lang", "phrase", "size", "a", "_best.l", "_best.r", F.col("_best._score").alias("score"))


def standing_alone(found: DataFrame, longest: int, share: int) -> DataFrame:
    """Without phrases inside a longer one that has at least ``share`` per cent of their count."""
    words = F.split("phrase", " ", -1)
    if longest < 3:
        return found
    inner = found.filter("size > 2").select(
        "lang", F.col("a").alias("_f"), "size", words.alias("_words"),
        F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("_m"),
    ).select(
        "lang", "_f", "_words", "_m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("_m") + 1)).alias("_at")
    ).select("lang", F.concat_ws(" ", F.slice("_words", F.col("_at"), F.col("_m"))).alias("phrase"), "_f")
    holders = inner.groupBy("lang", "phrase").agg(F.max("_f").alias("_f"))
    held = F.coalesce(100 * F.col("_f") >= share * F.col("a"), F.lit(False))
    return found.join(holders, ["lang", "phrase"], "left").filter(~held).drop("_f")


def best(found: DataFrame, top: int, shares: int = 64) -> DataFrame:
    """The first ``top`` of each language with their rank, the shares' best first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    near = Window.partitionBy("lang", "_share").orderBy(*order)
    of_shares = found.withColumn("_share", share).withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= top)
    ranked = of_shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).drop("_share")


def mine(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    top: int = 2000,
    share: int = 50,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best collocations of 2 to
    ``longest`` words that occur ``least`` times or more."""
    if longest < 2 or least < 1:
        raise ValueError("longest must be at least 2 and least at least 1")
    prepared(docs.sparkSession)
    chunks = stage(dictionary(docs, text, lang, longest), "chunks")
    counted = grams(chunks, longest, range(1, 3))
    # Every word counts into n; of the pairs only the frequent ones are kept.
    keep = (F.col("n") >= least) | (F.col("size") == 1)
    counts = stage(counted.filter(keep), "grams")
    all_counts = counts
    for size in range(3, longest + 1):
        bitmap = marked(counts.filter((F.col("size") == size - 1) & (F.col("n") >= least)))
        if not bitmap.any():
            break
        counts = stage(grams(chunks, longest, range(size, size + 1), bitmap).filter(F.col("n") >= least), "grams")
        all_counts = all_counts.unionByName(counts)
    total = all_counts.filter("size = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    found = stage(scores(all_counts, least), "phrases")
    ranked = best(standing_alone(found, longest, share), top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def mine_sql(longest: int = 3, least: int = 10, top: int = 2000, share: int = 50) -> str:
    """The same from every phrase of every piece of ``documents``."""
    letters = CAPITALS.decode()
    of_size = "\n  UNION ALL ".join(
        f"SELECT lang, {m} AS size, array_to_string(words[i:i + {m - 1}], ' ') AS phrase"
        f" FROM (SELECT lang, words, unnest(range(1, len(words) - {m - 2})) AS i FROM pieces)"
        for m in range(1, longest + 1)
    )
    return f"""WITH cut AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
         unnest(regexp_split_to_array(translate(text, '{letters}', '{letters.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
pieces AS (SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[ \\t]+') IF w <> ''] AS words FROM cut),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS n FROM ({of_size}) GROUP BY ALL),
candidates AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND n >= {least}),
cuts AS (
  SELECT c.lang, c.size, c.phrase, c.n AS a, l.n AS l, r.n AS r, k,
         CAST(1000000 * CAST(c.n AS HUGEINT) * c.n // (CAST(l.n AS HUGEINT) * r.n) AS BIGINT) AS score
  FROM (SELECT *, array_to_string(words[1:k], ' ') AS first_part, array_to_string(words[k + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)) AS c
  JOIN f AS l ON l.lang = c.lang AND l.phrase = c.first_part
  JOIN f AS r ON r.lang = c.lang AND r.phrase = c.rest),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(n) AS n
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates))
  GROUP BY ALL),
ranked AS (
  SELECT x.*, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, x.phrase) AS rank
  FROM lowest AS x LEFT JOIN inner_parts AS i USING (lang, phrase)
  WHERE i.n IS NULL OR 100 * i.n < {share} * x.a)
SELECT lang, rank, phrase, a, l, r, CAST(t.n AS BIGINT) AS n, score
FROM ranked JOIN (SELECT lang, sum(n) AS n FROM f WHERE size = 1 GROUP BY lang) AS t USING (lang)
WHERE rank <= {top}"""
