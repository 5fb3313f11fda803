"""Exact clustering with heaps against plain full scans in Python's integers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_DIR, needs_tables

from supplyview.llm import centroids
from supplyview.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, id long, block string, distance double"
LONG = (1 << 63) - 1


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, 2, 3, "x", 0.5) for k, v in rows], SCHEMA)


def plain(rows, k=8, rounds=10, length=64, scale=1024):
    good = [
        (i, v, [max(-(1 << 40), min(1 << 40, math.floor(scale * x))) for x in v]) for i, v in rows
        if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    c = [x for _, _, x in order[:k]]

    def assigned():
        out = []
        for _, _, x in good:
            d = [sum((a - b) ** 2 for a, b in zip(x, y)) for y in c]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = [a for a, _ in assigned()]
        for j in range(len(c)):
            members = [x for (_, _, x), a in zip(good, own) if a == j]
            if members:
                c[j] = [sum(col) // len(members) for col in zip(*members)]
    last = assigned()
    each = [sum(d for a, d in last if a == j) for j in range(len(c))]
    named = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in c]
    return sorted((
        (i if i is not None else -1, a, min(d, LONG), min(each[a], LONG), min(sum(each), LONG), named[a])
        for (i, _, _), (a, d) in zip(good, last)
    ))


def found(df):
    return sorted(
        (r["vec_id"] if r["vec_id"] is not None else -1, r["cluster"], r["distance"], r["cluster_inertia"],
         r["inertia"], r["centroid_sha256"]) for r in df.collect()
    )


def clustered(n, length, seed=0, spread=0.3):
    random = np.random.default_rng(seed)
    middles = random.standard_normal((11, length))
    return [
        (int(i), (middles[i % 11 if i % 3 else 0] + spread * random.standard_normal(length)).round(3).tolist())
        for i in range(n)
    ]


def test_equals_the_full_scan(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 50)
    rows = clustered(900, 6)
    df = centroids.cluster(frame(spark, rows).repartition(5), length=6)
    assert found(df) == plain(rows, length=6)


def test_ties_copies_and_rows_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3), float(i % 2)]) for i in range(40)] + [(7, [1.0, 1.0])] * 5 + [
        (50, None), (51, []), (52, [1.0]), (53, [nan, 1.0]), (54, [inf, 1.0]), (55, [None, 1.0]),
        (None, [2.0, 0.5]), (56, [1.0, 2.0, 3.0]), (57, [0.0, 0.0]),
    ]
    assert found(centroids.cluster(frame(spark, rows), length=2)) == plain(rows, length=2)


@pytest.mark.parametrize("large", [3e3, 1e6, 4e8, 1e30])
def test_large_components_stay_exact(spark, large):
    rows = [(i, [large * (i % 5) + 0.37 * i, -large / (i + 1), 0.1 * i]) for i in range(60)]
    df = centroids.cluster(frame(spark, rows), k=4, length=3)
    assert found(df) == plain(rows, k=4, length=3)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.5, 0.25]), (2, [-1.0, 2.0])]
    assert found(centroids.cluster(frame(spark, rows), length=2)) == plain(rows, length=2)
    assert found(centroids.cluster(frame(spark, rows[:1]), length=2)) == plain(rows[:1], length=2)
    none = centroids.cluster(frame(spark, []))
    assert none.count() == 0 and none.columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    ]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 6), st.integers(1, 4))
def test_heaps_keep_every_assignment(seed, k, length):
    """Centroids wander at random: whoever is not popped has kept the nearest centroid."""
    random = np.random.default_rng(seed)
    x = random.integers(-40, 40, (120, length))
    c = random.integers(-40, 40, (k, length))
    own, gap = centroids.nearest(centroids.distances(x, c))
    heaps, accumulated = centroids.Heaps(k), np.zeros(k)
    heaps.push(list(range(len(x))), own, gap, accumulated)
    popped = 0
    for _ in range(8):
        moved = c + random.integers(-2, 3, c.shape)
        accumulated = accumulated + centroids._moves(c, moved)
        c = moved
        heaps = centroids.Heaps.stored(*heaps.row()[:3])
        places, _ = heaps.expired(accumulated)
        popped += len(places)
        near, gap = centroids.nearest(centroids.distances(x[places], c))
        heaps.push(places, near, gap, accumulated)
        assert heaps.owners().tolist() == centroids.nearest(centroids.distances(x, c))[0].tolist()
    assert popped < 8 * len(x) or k > 3


def test_most_vectors_are_not_rescanned():
    random = np.random.default_rng(4)
    c = random.integers(-1000, 1000, (8, 16))
    x = c[random.integers(0, 8, 2000)] + random.integers(-60, 60, (2000, 16))
    own, gap = centroids.nearest(centroids.distances(x, c))
    heaps = centroids.Heaps(8)
    heaps.push(list(range(len(x))), own, gap, np.zeros(8))
    assert len(heaps.expired(centroids._moves(c, c + 3))[0]) < 20


def test_rounds_shuffle_neither_vectors_nor_heaps(spark):
    rows = frame(spark, clustered(300, 4))
    good = centroids.kept(rows.select("vec_id", "embedding"), "embedding", 4)
    tables = centroids._Tables(spark, centroids.current_folder(spark), 8)
    try:
        blocks = tables.write(centroids._blocks(good, "vec_id", "embedding", 4, 1024), "blocks", spread=True)
        c = centroids.seeds(good, "vec_id", "embedding", 8, 4, 1024, "3:")
        heaps = tables.write(centroids._assign(blocks, c), "heaps", spread=False)
        joined = centroids._with_blocks(heaps, blocks, np.zeros(8))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" in plan
    finally:
        tables.drop()


def test_tables_are_dropped(spark):
    before = {t.name for t in spark.catalog.listTables()}
    centroids.cluster(frame(spark, clustered(50, 3)), length=3).count()
    assert {t.name for t in spark.catalog.listTables()} == before


@needs_tables
def test_query(spark):
    from supplyview.llm.queries import op12_centroid_clusters

    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in table(spark, SF_DIR, "embeddings").collect()]
    assert found(op12_centroid_clusters(spark, SF_DIR)) == plain(rows)
