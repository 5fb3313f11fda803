"""Mixing, the pipeline's stages and the registered queries."""

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_DIR, awkward, awkward_rows, needs_tables, nothing

from supplyview.llm import mixing
from supplyview.llm.common import components, free_name
from supplyview.session import stage

weight = st.floats(0.01, 10)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 300), weight), min_size=1, max_size=7), st.integers(10, 200))
def test_less_than_a_block_off_at_every_slot(sources, period):
    blocks = {f"s{i}": n for i, (n, _) in enumerate(sources)}
    plan = mixing.phases(blocks, {f"s{i}": w for i, (_, w) in enumerate(sources)}, period)
    placed, shares = {}, defaultdict(dict)
    for source, b0, b1, slot0, length, n, slots in plan:
        shares[slot0][source] = n / length
        for b in range(b0, b1):
            i = b - b0
            placed[slot0 + i // n * length + slots[i % n]] = (source, b)
    assert sorted(placed) == list(range(sum(blocks.values())))
    assert len(set(placed.values())) == len(placed)
    starts = [*sorted(shares), len(placed)]
    for a, b in zip(starts, starts[1:]):
        count = defaultdict(int)
        for slot in range(a, b):
            count[placed[slot][0]] += 1
            for source, share in shares[a].items():
                assert abs(count[source] - share * (slot + 1 - a)) < 1


def test_rounded_weights_add_up():
    for weights in ({"a": 1.0}, {"a": 1e-9, "b": 1.0}, {str(i): 1.0 for i in range(37)}, {"a": 0.5, "b": 0.3, "c": 0.2}):
        shares = mixing.rounded(weights, 20)
        assert sum(shares.values()) == max(20, len(weights)) and min(shares.values()) >= 1


def tempered(blocks):
    return {s: (n / sum(blocks.values())) ** 0.7 for s, n in blocks.items()}


@pytest.mark.parametrize("blocks, weights", [
    ({"a": 60_000, "b": 30_000, "c": 10_000}, None),
    ({"a": 60_000, "b": 30_000, "c": 10_000}, {"a": 0.123456, "b": 0.376544, "c": 0.5000001}),
    ({f"s{i}": 4 for i in range(12_000)} | {"hot": 18_750}, None),
    ({"a": 25_000, "b": 12_500, "c": 12_500}, {"a": 0.5, "b": 0.25, "c": 0.25}),
])
def test_less_than_a_block_off_the_given_weights(blocks, weights):
    weights = weights or tempered(blocks)
    plan = mixing.phases(blocks, weights)
    assert sum(b1 - b0 for _, b0, b1, *_ in plan) == sum(blocks.values())
    phase = [p for p in plan if p[3] == 0]
    end = sum(b1 - b0 for _, b0, b1, *_ in phase)
    assert end > mixing.PERIOD
    total = sum(weights.values())
    for source, b0, b1, _, length, n, slots in phase:
        i = np.arange(b0, b1)
        at = i // n * length + np.array(slots)[i % n]
        share = weights[source] / total
        # Just after and just before each block, and at the end.
        assert (i + 1 - share * (at + 1)).max() < 1 + 1e-5 and (share * at - i).max() < 1 + 1e-5
        assert abs(b1 - share * end) < 1 + 1e-5
    assert {p[0] for p in phase} == set(blocks)


def test_mix_places_every_row_once(spark):
    rows = [(i, "hot" if i % 3 else None if i % 2 else "b", i) for i in range(900)] + [(5, "hot", 1), (None, "c", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, Slot int")
    found = mixing.mix(docs, {"hot": 0.5, None: 0.5}, block=4).collect()
    assert len(found) == len(rows) and len({r["position"] for r in found}) == len(rows)
    assert found[0].__fields__ == ["doc_id", "source", "slot", "position"]
    by_slot = defaultdict(set)
    for r in found:
        by_slot[r["slot"]].add(r["source"])
        assert r["position"] // 4 == r["slot"]
    assert all(len(s) == 1 for s in by_slot.values()) and sorted(by_slot) == list(range(len(by_slot)))
    first = [by_slot[i] for i in range(60)]
    assert first.count({"hot"}) == 30 and first.count({None}) == 30
    # Sources without a weight come last.
    assert max(i for i, s in by_slot.items() if s in ({"hot"}, {None})) < min(i for i, s in by_slot.items() if s in ({"b"}, {"c"}))
    again = mixing.mix(docs.repartition(7), {"hot": 0.5, None: 0.5}, block=4).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert mixing.mix(docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (5000, 4000)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert {found[i] for i in range(1, 201)} == {1} and {found[i] for i in range(1000, 1300)} == {1000}
    assert found[5000] == found[4000] == 4000
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_free_names(spark):
    df = spark.createDataFrame([], "score int, _SCORE int")
    assert free_name(df, "score") == "__score" and free_name(df, "other") == "other"


@pytest.fixture
def pipeline():
    import corpus_pipeline

    return corpus_pipeline


def run_stages(pipeline, spark, docs, sf_dir):
    out = [stage(docs, "test")]
    for _, step in pipeline.STAGES:
        out.append(stage(step(spark, out[-1], sf_dir), "test"))
    return out


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("labels"))
    rows = [(1, 1, 0), (8, 1, 0), (9, 1, 0), (2, 1, 0), (None, 0, 0), (77, None, 0)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_on_awkward_rows(spark, pipeline, labelled):
    docs, language, good, unique, mixed, packed = run_stages(pipeline, spark, awkward(spark), labelled)
    keys = lambda df: sorted((r["doc_id"] or -1) for r in df.collect())
    assert keys(language) == [-1, 1, 2, 2, 7, 8, 9, 10, 11]
    assert keys(good) == keys(language)
    # 2 repeats 1; the row without an id stays.
    assert keys(unique) == [-1, 1, 7, 8, 9, 10, 11]
    assert keys(mixed) == keys(unique)
    for df in (language, good, unique, mixed):
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
    rows = {r["doc_id"]: tuple(r) for r in mixed.collect()}
    assert all(rows[r[0]] == r for r in awkward_rows() if r[0] in rows)
    assert keys(packed.select("doc_id").distinct()) == keys(unique)


def test_language_stage_rejects_unknown_scripts(spark, pipeline, labelled):
    english, greek = "the house and the dog with this that they were going", "το σπίτι και ο σκύλος με αυτό"
    rows = [(i, english, "en") for i in range(1, 20)] + [(30, greek, None), (31, f"{greek} the {greek}", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in pipeline.language(spark, docs, labelled).collect()} == set(range(1, 20))


def test_stages_on_nothing(spark, pipeline, labelled):
    out = run_stages(pipeline, spark, nothing(spark), labelled)
    assert [df.count() for df in out] == [0] * 6 and out[4].columns == out[0].columns


@needs_tables
def test_stages_on_the_tables(spark, pipeline):
    assert [name for name, _ in pipeline.STAGES] == ["language", "quality", "near_duplicates", "mix", "pack"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = run_stages(pipeline, spark, docs, SF_DIR)
    before, language, good, unique, mixed, packed = [df.count() for df in out]
    assert before >= language >= good >= unique == mixed > 0
    texts = {r["text"] for r in out[2].collect()}
    assert {r["text"] for r in out[3].collect()} <= texts and out[3].select("text").distinct().count() == unique
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in out[2].collect()}
    found = {r["doc_id"] for r in out[1].collect()} & set(labels)
    assert np.mean([(k in kept) == bool(labels[k]) for k in found]) > 0.95
    # The files hold the order of the mix.
    sources = [r["source"] for r in out[4].collect()]
    assert len(set(sources[:200])) > 1
    ran = pipeline.run(spark, SF_DIR).collect()
    assert sum(r["length"] for r in ran) == sum(r["length"] for r in out[5].collect())


def test_every_operator_is_registered():
    import __spark_entry__ as contract

    names = list(contract.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert set(contract.oracle_sql()) <= set(names)


def test_one_id_with_several_texts_keeps_them(spark):
    import corpus_pipeline as pipeline

    a = " ".join(f"one{i}" for i in range(40))
    b = " ".join(f"other{i}" for i in range(40))
    rows = [(5, a), (5, b), (5, b), (3, a), (9, None), (None, a), (None, a), (9, "")]
    docs = spark.createDataFrame(
        [(k, t, "en", "s", i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, row_number int"
    )
    kept = [pipeline.near_duplicates(spark, docs.repartition(n), "").collect() for n in (1, 4)]
    for found in kept:
        assert sorted((r["doc_id"] or 0, r["text"] or "") for r in found) == sorted(
            [(3, a), (5, b), (9, ""), (0, a), (0, a)]
        )
        assert found[0].__fields__ == docs.columns


@needs_tables
def test_run_leaves_its_rows_alone_behind(spark):
    from pathlib import Path

    import corpus_pipeline as pipeline
    from supplyview.session import run_folder

    with run_folder(spark) as folder:
        n = pipeline.run(spark, SF_DIR).count()
        left = [p.name for p in Path(folder.removeprefix("file:")).iterdir()]
    assert n > 0 and len(left) == 1 and left[0].startswith("pipeline-")


def test_small_sources_mix_as_one(spark):
    rows = [(i, "hot" if i < 3000 else f"s{i % 1500}") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    found = sorted(mixing.mix(docs, block=64).collect(), key=lambda r: r["position"])
    assert sorted(r["doc_id"] for r in found) == list(range(9000))
    # One source of its own, and a pool whose documents come in the order of a hash.
    blocks = defaultdict(set)
    for r in found:
        blocks[r["slot"]].add(r["source"] == "hot")
    assert all(len(b) == 1 for b in blocks.values()) and sorted(blocks) == list(range(len(blocks)))
    hot, pool = (3000 / 9000) ** 0.7, 1500 * (4 / 9000) ** 0.7
    taken, end = 0, min(3000 / 64 * (hot + pool) / hot, 6000 / 64 * (hot + pool) / pool)
    for slot in range(int(end) - 1):
        taken += True in blocks[slot]
        assert abs(taken - hot / (hot + pool) * (slot + 1)) < 1
    # No source is ever a block ahead of or behind its share.
    assert max(sum(r["source"] == f"s{i}" for r in found) for i in range(0, 1500, 100)) < 64


def test_the_plan_does_not_grow_with_the_documents(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCKS", 100)
    planned = []
    plain = mixing.phases
    monkeypatch.setattr(mixing, "phases", lambda blocks, *rest: planned.append(blocks) or plain(blocks, *rest))
    for n in (2000, 20_000):
        docs = spark.range(n).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 1000)) AS source")
        found = mixing.mix(docs).agg({"position": "count"}).first()[0]
        assert found == n
    assert all(sum(b.values()) <= 102 for b in planned) and planned[0].keys() == planned[1].keys() == {"=hot", "pool"}


def plain_schedule(blocks, weights):
    """Earliest deadline first, slot by slot in fractions: the source of each slot."""
    from fractions import Fraction

    left, done, out, start = dict(blocks), dict.fromkeys(blocks, 0), [], 0
    share = {s: Fraction(w) / sum(map(Fraction, weights.values())) for s, w in weights.items()}
    while all(left.values()):
        at = len(out) - start
        ready = [s for s in left if done[s] / share[s] < at + 1 and int(done[s] / share[s]) <= at]
        first = min(ready, key=lambda s: (-(-(done[s] + 1) // share[s]), s))
        out.append(first)
        done[first] += 1
        left[first] -= 1
    return out


@pytest.mark.parametrize("weights", [
    {"a": 0.5, "b": 0.25, "c": 0.25}, {"a": 7, "b": 2, "c": 1}, {f"s{i}": 1 + i % 3 for i in range(9)},
])
def test_slots_of_a_plain_schedule(weights):
    blocks = {s: 40 + 7 * i for i, s in enumerate(weights)}
    want = plain_schedule(blocks, weights)
    found = {}
    for source, b0, b1, slot0, length, n, slots in mixing.phases(blocks, weights):
        if slot0 == 0:
            found |= {(b - b0) // n * length + slots[(b - b0) % n]: source for b in range(b0, b1)}
    assert [found.get(i) for i in range(len(want))] == want
