"""Near-duplicate vectors and nearest neighbours against all pairs."""

import numpy as np
import pytest
from llm_fixtures import SF_DIR, needs_tables
from pyspark.sql import functions as F

from supplyview.llm import ann, embedding_dedup
from supplyview.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, node long, score double, centre int, keys string"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, 2, 0.5, 3, "x") for k, v in rows], SCHEMA)


def clustered(n=160, seed=0):
    random = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = np.random.default_rng(i % 23).standard_normal(16)
        rows.append((7 * i + 1, (base * (1 + i % 3) + random.standard_normal(16) * (0.05 * (i % 7))).tolist()))
    rows += [(10_000 + i, rows[0][1]) for i in range(30)]
    return rows


def plain_links(rows, threshold):
    ids = np.array([k for k, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    root = ids.copy()
    while True:
        new = np.array([min(root[i], root[linked[i]].min(initial=root[i])) for i in range(len(ids))])
        if (new == root).all():
            return dict(zip(ids.tolist(), zip(linked.sum(axis=1).tolist(), root.tolist())))
        root = new


@pytest.mark.parametrize("chunk", [9, 1000])
def test_links_and_components(spark, chunk):
    rows = clustered()
    found = embedding_dedup.near_duplicates(frame(spark, rows), 0.9, recall=0.9999, chunk=chunk).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == plain_links(rows, 0.9)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_invalid_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, None]), (None, [1.0, 0.0]), (8, []), (9, [1.0, 0.0, 0.0]), (2, [2.0, 0.0]), (10, [3e38, 1.0]),
    ]
    found = embedding_dedup.near_duplicates(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in found)
    linked = [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (10, 3, 1, False)]
    alone = [(k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted([(0, 0, 0, False), *linked, *alone])
    assert embedding_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_recall_is_planned_for_the_threshold():
    k, tables = embedding_dedup.shape(10_000_000, 0.9, 0.97)
    p = embedding_dedup.collision(np.sqrt(0.2)) ** k
    assert 1 - (1 - p) ** tables >= 0.97
    random = np.random.default_rng(1)
    a = random.standard_normal((400, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = a + random.standard_normal(a.shape) / np.sqrt(32) * 0.44
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    keys = [embedding_dedup.keys_of(x, 8, 40) for x in (a, b)]
    want = np.mean([embedding_dedup.collision(d) ** 8 for d in np.linalg.norm(a - b, axis=1)])
    assert abs((keys[0] == keys[1]).mean() - want) < 0.02


def test_codes_lose_no_link():
    random = np.random.default_rng(3)
    for length in (2, 16, 64, 700):
        x = random.standard_normal((300, length)) * np.exp(random.standard_normal((300, length)))
        x[150:] = x[:150] + random.standard_normal((150, length)) * x.std() * random.uniform(0, 1, (150, 1))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = embedding_dedup.may_link(*embedding_dedup.codes_of(x), 0.9)
        exact = x @ x.T
        assert near[exact >= 0.9].all() and not near[exact < 0.8].any()


def test_planted_pairs_are_found_as_planned(spark):
    """Pairs at cosine 0.90 to 0.93, half of the rest around one centre, default recall."""
    random = np.random.default_rng(4)
    x = random.standard_normal((6000, 64))
    x[::2] = 0.8 * random.standard_normal(64) + x[::2]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 3000, 2):
        t = random.uniform(0.9005, 0.93)
        other = x[i + 1] - (x[i + 1] @ x[i]) * x[i]
        x[i + 1] = t * x[i] + np.sqrt(1 - t * t) * other / np.linalg.norm(other)
    x = x.astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(frame(spark, rows)).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = np.array([found[i] for i in range(len(x))])
    assert (got <= want).all() and want.sum() >= 3000 and got.sum() >= 0.96 * want.sum()


def plain_nearest(rows, queries, k):
    out = {}
    for q, v in queries:
        others = [(float(np.sqrt(((np.float32(v).astype(float) - np.float32(x).astype(float)) ** 2).sum())), i) for i, x in rows if i != q]
        out[q] = sorted(others)[:k]
    return out


@pytest.mark.parametrize("k", [3, 500])
def test_search_finds_the_nearest(spark, monkeypatch, k):
    monkeypatch.setattr(ann, "CHUNK_ROWS", 50)
    monkeypatch.setattr(ann, "QUERY_ROWS", 4)
    rows = clustered(300, 5)
    found = ann.search(frame(spark, rows), F.col("vec_id") % 11 == 0, k).collect()
    want = plain_nearest(rows, [(i, v) for i, v in rows if i % 11 == 0], k)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([d for d, _ in got[q]], [d for d, _ in want[q]], rtol=1e-12)


def test_bounds_hold():
    random = np.random.default_rng(2)
    x, q = random.standard_normal((3000, 64)), random.standard_normal((40, 64))
    model = ann.Model(x[:1000])
    centre, codes, norm, inner = model.encode(x)
    own = centre == 0
    low, high = model.bounds(q, 0, codes[own], norm[own], inner[own], 3.0)
    exact = ((q[:, None] - x[own][None]) ** 2).sum(axis=2)
    assert (low <= exact).mean() > 0.995 and (exact <= high).mean() > 0.995
    assert codes.shape[1] == 4 and codes.dtype == np.uint64


def test_search_leaves_invalid_vectors_out(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]),
            (5, [1.0, None]), (None, [1.0, 0.0]), (6, [1.0, 2.0, 3.0]), (7, [1.0, 1.0]), (0, [1.0, 0.0])]
    found = ann.search(frame(spark, rows), F.col("vec_id") == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [
        (0, 1, 1, 1.0), (0, 2, 7, 1.0)
    ]
    assert ann.search(frame(spark, []), F.col("vec_id") == 0).count() == 0


@needs_tables
def test_queries_against_all_pairs(spark):
    from supplyview.llm.queries import op1_embedding_dedup, op6_one_bit_search

    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF_DIR, "embeddings").collect()]
    found = op1_embedding_dedup(spark, SF_DIR).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == plain_links(rows, 0.9)
    want = plain_nearest(rows, [(i, v) for i, v in rows if i % 100 == 0], 10)
    got = {(r["query_id"], r["vec_id"]) for r in op6_one_bit_search(spark, SF_DIR).collect()}
    true = {(q, i) for q, near in want.items() for _, i in near}
    assert len(got) == len(true) and len(got & true) >= 0.99 * len(true)
