"""Collocations against plain counting, and the parse against the texts."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, connect
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_DIR, awkward, awkward_rows, needs_tables, nothing

from supplyview.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    cut = re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER))
    return [[w for w in re.split(r"[ \t]+", piece) if w] for piece in cut]


def plain(rows, longest=3, least=10, top=2000, share=50):
    """rows: (lang, text)."""
    out = []
    for lang in sorted({x or "und" if x is None else x for x, _ in rows}):
        f = Counter()
        for own, text in rows:
            if (own if own is not None else "und") != lang:
                continue
            for words in pieces(text):
                for m in range(1, longest + 1):
                    f.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in found.items():
            held = any(
                100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in found.items() if len(q) > len(p)
            )
            if not held:
                score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], score))
        for rank, (_, _, p, a, left, right, score) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), a, left, right, n, score))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def texts(seed=0, n=120):
    random = np.random.default_rng(seed)
    words = ["the", "cat", "sat", "ON", "a", "mat", "é", "Dog", "\x00", "x-y"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ?! ", "\r\n"]
    rows = []
    for _ in range(n):
        w = random.zipf(1.6, 60) % len(words)
        text = "".join(words[i] + ends[j] for i, j in zip(w, random.integers(0, len(ends), 60)))
        rows.append((["en", "fr", None, "und"][int(random.integers(0, 4))], text))
    return rows + rows[:30]


def frame(spark, rows):
    return spark.createDataFrame([(lang, text, 1, 2, "x") for lang, text in rows], "lang string, text string, n long, size int, chunk string")


@pytest.mark.parametrize("period,longest_chunk", [(32, 4096), (2, 5), (1, 4096), (10**9, 7)])
def test_equals_plain_counting(spark, monkeypatch, period, longest_chunk):
    monkeypatch.setattr(phrases, "PERIOD", period)
    monkeypatch.setattr(phrases, "LONGEST_CHUNK", longest_chunk)
    rows = texts()
    assert found(phrases.mine(frame(spark, rows).repartition(3))) == plain(rows)


@pytest.mark.parametrize("longest", [2, 5])
def test_other_lengths_and_limits(spark, longest):
    rows = texts(5)
    options = dict(longest=longest, least=3, top=25, share=70)
    assert found(phrases.mine(frame(spark, rows), **options)) == plain(rows, **options)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = texts(7)
    monkeypatch.setattr(phrases.marked, "__defaults__", (64,))
    assert found(phrases.mine(frame(spark, rows), least=4)) == plain(rows, least=4)


def test_awkward_rows(spark):
    rows = [(r[2], r[1]) for r in awkward_rows()]
    assert found(phrases.mine(awkward(spark), least=2)) == plain(rows, least=2)
    assert phrases.mine(nothing(spark)).count() == 0
    assert phrases.mine(frame(spark, [("en", None), (None, ""), ("fr", " .,\n ")])).count() == 0


def test_counts_beyond_64_bit_products(spark):
    n = 3_000_000_000
    counts = spark.createDataFrame(
        [("en", 1, "a", n), ("en", 1, "b", n + 1), ("en", 2, "a b", n - 1), ("en", 1, "c", 7 * n), ("en", 2, "c a", n)],
        "lang string, size int, phrase string, n long",
    )
    got = {r["phrase"]: r["score"] for r in phrases.scores(counts, 10).collect()}
    assert got == {"a b": 10**6 * (n - 1) ** 2 // (n * (n + 1)), "c a": 10**6 * n * n // (7 * n * n)}


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text(st.sampled_from("aB .,\n\té"), max_size=40) | st.none(), max_size=5),
    st.integers(1, 4), st.integers(1, 6), st.integers(1, 9),
)
def test_chunks_put_together_are_the_texts(rows, overlap, period, longest):
    chunks, own = phrases.parse(pa.array(rows, pa.string()), overlap, period, longest)
    told = {}
    for chunk, text in zip(chunks.to_pylist(), own.tolist()):
        tokens = chunk.split(" ")
        assert overlap < len(tokens) <= longest + overlap
        if text in told:
            assert told[text][-overlap:] == tokens[:overlap]
            tokens = tokens[overlap:]
        told.setdefault(text, []).extend(tokens)
    for i, text in enumerate(rows):
        words = [w for p in pieces(text) for w in [*p, "."] if p]
        if words:
            assert told[i][-overlap:] == ["."] * overlap
            cut = [x.split() for x in " ".join(told[i]).split(".") if x.split()]
            assert cut == [p for p in pieces(text) if p]
        else:
            assert i not in told


def test_copies_share_their_chunks():
    random = np.random.default_rng(1)
    body = " ".join(f"w{i}" for i in random.integers(0, 500, 3000))
    chunks, _ = phrases.parse(pa.array([f"one start {body}", f"quite another beginning here {body} and end"]), 2, 32, 4096)
    counts = Counter(chunks.to_pylist())
    assert sum(n > 1 for n in counts.values()) > 0.9 * len(counts)


@needs_tables
def test_query(spark):
    from supplyview.llm.queries import ORACLE_SQL, op13_phrase_collocations

    df = op13_phrase_collocations(spark, SF_DIR)
    assert compare(connect(SF_DIR), df, ORACLE_SQL["op13_phrase_collocations"]) == []
