"""Ids of the word vocabulary against the library; the plan against plain best-fit."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_DIR, awkward, awkward_rows, needs_tables, nothing

from supplyview.llm import best_fit, word_tokens
from supplyview.llm.common import table

pytest.importorskip("public_tokenizers")
PATH = word_tokens.default_tokenizer()
CASES = [
    "", None, "a", " a ", "\n", "a  b\tc\x0bd", "Hello, World! it's 5.5 ok?!", "don't 'S ABC's 're.", "THE the The.",
    "été ñandú. ß ẞ", "İstanbul İ I", "é x́. ́a b", "ſs K ŉ ª º", "ΑΣ ΑΣ. ǅ", "中文 字", "\x1c a\x1fb\x85c\xa0d",
    "<|endoftext|> a<|startoftext|>b", "<|ENDOFTEXT|> A", "... x", "x.y.z.", "\r a", "a..b ,,",
]


def whole(text):
    return word_tokens.word_encoder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_parts_give_the_ids_of_whole_texts():
    for text, ids in zip(CASES, word_tokens.word_encoder(PATH).encode(pa.array(CASES))):
        assert ids.tolist() == whole(text), text
    assert [x.tolist() for x in word_tokens.word_encoder(PATH).encode(pa.array(CASES[2:]))] == [whole(t) for t in CASES[2:]]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBÉé'.,!? \n\t1ßİ中²\xa0<|>"), max_size=12), max_size=5))
def test_random_texts(texts):
    found = word_tokens.word_encoder(PATH).encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in found] == [whole(t) for t in texts]


def test_a_full_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(word_tokens, "MEMO_PARTS", 3)
    encoder = word_tokens.WordEncoder(PATH)
    for _ in range(3):
        for text in ("one two Three four.", "five six, two", "one two"):
            assert encoder.encode(pa.array([text]))[0].tolist() == whole(text)


def plain_bins(lengths, capacity):
    """Best-fit decreasing, piece by piece: the used tokens of every bin."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(capacity - length)
    return Counter(rooms)


def placed(counts, capacity):
    slots = best_fit.plan(counts, capacity)
    bins = defaultdict(list)
    for length, n in counts.items():
        own = slots[slots[:, 0] == length]
        for rank in range(n):
            _, first, each, start, offset = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            bins[start + (rank - first) // each].append((offset + (rank - first) % each * length, length))
    return bins


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.data())
def test_the_plan_is_plain_best_fit(capacity, data):
    counts = data.draw(st.dictionaries(st.integers(1, capacity), st.integers(1, 30), max_size=12))
    bins = placed(counts, capacity)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = [length for length, n in counts.items() for _ in range(n)]
    want = plain_bins(lengths, capacity)
    assert Counter(capacity - sum(n for _, n in parts) for parts in bins.values()) == want
    assert sorted(bins) == list(range(len(bins)))


def test_the_plan_does_not_grow_with_the_number_of_documents():
    random = np.random.default_rng(3)
    counts = {int(n): int(c) for n, c in enumerate(random.integers(1, 1000, 2048), 1)}
    small = best_fit.plan(counts, 2048)
    large = best_fit.plan({n: 1_000_000_007 * c for n, c in counts.items()}, 2048)
    assert len(small) < 40_000 and len(large) < 40_000


def test_the_plan_of_nothing():
    assert best_fit.plan({}, 8).shape == (0, 5)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_cover_documents_and_sequences(spark, capacity):
    packed = best_fit.pack(awkward(spark).repartition(3), capacity, with_ids=True).collect()
    want = defaultdict(int)
    for r in awkward_rows():
        ids = [*whole(r[1]), 0]
        for n, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want[r[0], n, start, len(part), crc(part)] += 1
    got = Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in packed)
    assert got == want
    assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] for p in packed)
    bins = defaultdict(list)
    for p in packed:
        bins[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in bins.values():
        ends = np.cumsum([0, *(n for _, n in sorted(parts))])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= capacity
    assert len(bins) == sum(plain_bins([p["length"] for p in packed], capacity).values())


def test_packing_nothing(spark):
    assert best_fit.pack(nothing(spark)).count() == 0


@needs_tables
def test_query(spark):
    from supplyview.llm.queries import op11_best_fit_packing

    found = op11_best_fit_packing(spark, SF_DIR).collect()
    ids = {r["doc_id"]: [*whole(r["text"]), 0] for r in table(spark, SF_DIR, "documents").collect()}
    assert {r["doc_id"] for r in found} == set(ids)
    for r in found:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == 2048 * r["piece"] and r["ids_crc32"] == crc(part) and len(part) == r["length"]
    assert sum(r["length"] for r in found) == sum(map(len, ids.values()))
    used = len({r["sequence_id"] for r in found})
    assert used == sum(plain_bins([r["length"] for r in found], 2048).values())
