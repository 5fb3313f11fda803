"""Context-tree weighting by blocks and buckets against the recursive definition."""

import math
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from llm_fixtures import SF_DIR, awkward, awkward_rows, needs_tables, nothing

from supplyview.llm import ctw
from supplyview.llm.common import table

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return (text or "").encode().translate(LOWER).split()


def stream(text):
    return b" ".join(words(text)) + b"\n"


def trains(key):
    return key is None or zlib.crc32(str(key).encode()) % 5 != 1


def plain_scores(rows):
    """log10 probabilities by the recursion over the whole tree."""
    depth = ctw.DEPTH
    counts = defaultdict(lambda: [0, 0])
    longer = defaultdict(set)

    def steps(text):
        data = b"\n" * depth + stream(text)
        for i in range(depth, len(data)):
            for j in range(8):
                yield data[i - depth : i], (1 << j) | data[i] >> (8 - j), data[i] >> (7 - j) & 1

    for key, text in rows:
        if trains(key):
            for context, node, bit in steps(text):
                for d in range(depth + 1):
                    c = context[depth - d :]
                    counts[c, node][bit] += 1
                    if d < depth:
                        longer[c, node].add(context[depth - d - 1 :])

    def pe(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(maxsize=None)
    def pw(c, node):
        own = pe(*counts[c, node])
        return own if len(c) == depth else np.logaddexp(own, product(c, node)) - math.log(2)

    def product(c, node):
        return sum(pw(x, node) for x in longer.get((c, node), ()))

    def probability(context, node, bit):
        p = None
        for d in range(depth, -1, -1):
            c = context[depth - d :]
            a = counts.get((c, node), [0, 0])
            kt = (a[bit] + 0.5) / (sum(a) + 1)
            if p is None:
                p = kt
            else:
                log_beta = pe(*a) - product(c, node)
                w = 1 / (1 + math.exp(-max(-500, min(500, log_beta))))
                p = w * kt + (1 - w) * p
        return p

    return [sum(math.log10(probability(*s)) for s in steps(text)) for _, text in rows]


def plain_base(rows):
    c = Counter()
    for key, text in rows:
        if trains(key):
            c.update([*words(text), b"\n"])
    n, v = sum(c.values()), len(c)
    whole = math.log10(n + 0.5 * (v + 1))
    out = []
    for _, text in rows:
        w = [*words(text), b"\n"]
        out.append((len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(c[x] + 0.5) - whole for x in w)))
    return out


def short_rows():
    return [(r[0], r[1] if r[0] != 7 else r[1][:900]) for r in awkward_rows()]


def test_scores_by_blocks_equal_the_recursion(spark):
    rows = [*short_rows(), *((20 + i, f"The {w} house, the\tcat {i % 3}") for i, w in enumerate("ab cd ef gh ij kl".split()))]
    docs = spark.createDataFrame([(k, t, 1.0, 2) for k, t in rows], "doc_id long, text string, score double, block int")
    want = sorted(zip(plain_scores(rows), plain_base(rows), [k or -1 for k, _ in rows]), key=lambda x: (x[2], x[0]))
    for options in ({}, {"block_bytes": 100, "fan": 2}):
        found = sorted(ctw.score(docs, **options).collect(), key=lambda r: (r["doc_id"] or -1, r["score"]))
        assert [r["doc_id"] or -1 for r in found] == [k for *_, k in want]
        for r, (score, (n, known, total, base), key) in zip(found, want):
            assert abs(r["score"] - score) < 1e-4 * max(1, abs(score))
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
            assert abs(r["base_score"] - base) < 1e-9 * max(1, abs(base))
            assert r["held_out"] == (not trains(r["doc_id"]))
            size = len(stream(dict(rows)[r["doc_id"]]))
            assert abs(r["bits_per_byte"] + r["score"] / math.log10(2) / size) < 1e-6


def test_probabilities_add_up_to_one():
    random = np.random.default_rng(0)
    texts = [bytes(random.integers(97, 101, 40).astype(np.uint8)) + b"\n" for _ in range(20)]
    keys, counts = ctw.counted(ctw.grams(texts)[0])
    context = keys[5] >> np.uint64(8) << np.uint64(8)
    every = context | np.arange(256, dtype=np.uint64)
    both, total = ctw.counted(np.concatenate([keys, every]), np.concatenate([counts, np.zeros(256, np.int64)]))
    mixed, top = ctw.deep_tree(both, total)
    tree = ctw.Top(top[0].astype(int), top[1], top[2], top[3])
    log2p = tree.log2p(both, mixed)[np.searchsorted(both, every)]
    assert abs((2.0**log2p).sum() - 1) < 1e-9


def test_long_lines_are_cut_with_their_context(monkeypatch):
    lines = [b"some words here\n", b"\n", b"another line of text that is long\n"] * 3
    whole = [ctw.counted(ctw.grams([x])[0]) for x in lines]
    monkeypatch.setattr(ctw, "STEP_BYTES", 10)
    monkeypatch.setattr(ctw, "STEP_ROWS", 3)
    found = [[] for _ in lines]
    for run, before, numbers in ctw.pieces(lines):
        assert len(run) <= 3
        keys, sizes = ctw.grams(run, before)
        for n, part in zip(numbers, np.split(keys, np.cumsum(sizes)[:-1])):
            found[n].append(part)
    for (keys, counts), parts in zip(whole, found):
        again = ctw.counted(np.concatenate(parts))
        assert (again[0] == keys).all() and (again[1] == counts).all()


def test_packed_columns():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**56, 1000).astype(np.uint64))
    assert (ctw.expand_sorted(ctw.squeeze_sorted(keys)) == keys).all()
    assert len(ctw.expand_sorted(ctw.squeeze_sorted(keys[:0]))) == 0
    for some in ([], [b""], [b"", b"a"], [b"b", b""]):
        some = [x.decode() for x in some]
        words = pa.array(some, pa.string())
        assert ctw.expand_words(ctw.squeeze_words(words), len(some)).to_pylist() == some


def test_buckets_follow_the_word_alone():
    words = ["", "a", "b", "ab", "abcdefgh", "abcdefghi", "xabcdefghi", "abcdefg", "é", ""]
    one = [int(ctw.word_bucket(pa.array([w]), 97)[0]) for w in words]
    assert ctw.word_bucket(pa.array(words), 97).tolist() == one
    assert ctw.word_bucket(pa.array(["x", *words]).slice(1), 97).tolist() == one
    assert len(set(one)) >= 8


def test_no_texts(spark):
    assert ctw.score(nothing(spark)).count() == 0
    untrained = awkward(spark).filter("doc_id = 4 and false")
    assert ctw.score(untrained).count() == 0


@needs_tables
def test_query_scores_held_out_texts_better_than_words(spark):
    from supplyview.llm.queries import op7_context_tree_scores

    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()]
    found = {r["doc_id"]: r for r in op7_context_tree_scores(spark, SF_DIR).collect()}
    for (key, _), (n, known, total, base) in zip(rows, plain_base(rows)):
        r = found[key]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert abs(r["base_score"] - base) < 1e-9 * abs(base)
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["bits_per_byte"] for r in held) / len(held) < 2.7
