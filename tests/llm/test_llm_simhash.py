"""Fingerprints, bit-sliced distances and groups against plain loops."""

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_DIR, awkward, awkward_rows, needs_tables, nothing

from supplyview.llm import simhash
from supplyview.llm.common import components, table


def plain_fingerprint(text, shingle=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [b" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps, radius):
    """Smallest key reachable for each (key, fingerprint)."""
    root = {k: k for k, _ in fps}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x) in enumerate(fps):
        for b, y in fps[:i]:
            if (x ^ y).bit_count() <= radius:
                a_root, b_root = find(a), find(b)
                root[max(a_root, b_root)] = min(a_root, b_root)
    return {k: find(k) for k, _ in fps}


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 5)
    for r in awkward_rows()[:12]:
        if r[0] != 7:
            assert simhash.fingerprint(r[1]) & (2**64 - 1) == plain_fingerprint(r[1])
    assert simhash.fingerprint("Ünder A b") == simhash.fingerprint("Ünder a\x0bB")


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 5), st.lists(st.integers(1, 150), min_size=1, max_size=5), st.integers(0, 2**32))
def test_bit_sliced_distances(radius, sizes, seed):
    random = np.random.default_rng(seed)
    n = sum(sizes)
    centre = random.integers(0, 2**63, 3, dtype=np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << random.integers(0, 64, random.integers(1, 5)).astype(np.uint64)) for _ in range(n)])
    fps = centre[random.integers(0, 3, n)] ^ flips
    i, j = simhash.near_pairs(fps, np.array(sizes), radius)
    group = np.repeat(np.arange(len(sizes)), sizes)
    want = {
        (a, b) for a in range(n) for b in range(a + 1, n)
        if group[a] == group[b] and int(fps[a] ^ fps[b]).bit_count() <= radius
    }
    assert set(zip(i.tolist(), j.tolist())) == want


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_every_near_pair_shares_a_table(radius):
    random = np.random.default_rng(radius)
    masks = simhash.masks(radius)
    for _ in range(300):
        flips = random.choice(64, radius, replace=False)
        difference = sum(1 << int(b) for b in flips)
        assert any(difference & (m & (2**64 - 1)) == 0 for m in masks)


@pytest.mark.parametrize("chunk", [7, 1000])
def test_links_connect_all_groups_in_small_chunks(spark, chunk):
    random = np.random.default_rng(3)
    centre = [int(x) for x in random.integers(0, 2**63, 4)]
    fps = {}
    for i in range(240):
        x = centre[i % 4]
        for b in random.integers(0, 64, i % 5):
            x ^= 1 << int(b)
        fps.setdefault(x, 10 * i + 3)
    signed = [(x - 2**64 if x >> 63 else x, k) for x, k in fps.items()]
    nodes = spark.createDataFrame(signed, "fp long, node long")
    found = {r["node"]: r["component"] for r in components(simhash.links(nodes, 3, chunk), "t").collect()}
    want = plain_groups([(k, x) for x, k in fps.items()], 3)
    assert {k: found.get(k, k) for k in want} == want


def test_groups_of_awkward_rows(spark):
    found = simhash.near_duplicates(awkward(spark)).collect()
    assert len(found) == len(awkward_rows())
    by_id = {r["doc_id"]: r for r in found}
    assert {by_id[i]["component_id"] for i in (1, 2)} == {1}
    assert {by_id[i]["component_id"] for i in (3, 4, 5)} == {3}
    assert by_id[3]["fingerprint"] == "0" * 16
    assert by_id[None]["component_id"] is None
    assert simhash.near_duplicates(nothing(spark)).count() == 0


@needs_tables
def test_query_against_all_pairs(spark):
    from supplyview.llm.queries import op10_simhash

    texts = {r["doc_id"]: r["text"] for r in table(spark, SF_DIR, "documents").collect()}
    fps = [(k, plain_fingerprint(t)) for k, t in texts.items()]
    want = plain_groups(fps, 3)
    found = op10_simhash(spark, SF_DIR).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    assert {r["doc_id"]: r["fingerprint"] for r in found} == {k: f"{x:016x}" for k, x in fps}
