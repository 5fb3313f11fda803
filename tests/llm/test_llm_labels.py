"""Languages, quality and licences: plain versions, planted cases, SQL."""

import numpy as np
import pytest
from llm_fixtures import SF_DIR, awkward, awkward_rows, needs_tables, nothing
from pyspark.sql import functions as F

from supplyview.llm import langid, licences, quality
from supplyview.llm.common import held_out, table

EN = "the house and the dog with this that they were going"
FR = "la maison et le chien avec cette que nous étions très"
RU = "дом и собака с этим что они были там"
GR = "το σπίτι και ο σκύλος με αυτό"


def model(spark):
    rows = [(EN, "en")] * 3 + [(FR, "fr")] * 3 + [(RU, "ru"), (None, "en"), ("x", None)]
    return langid.learn(spark.createDataFrame(rows, "text string, lang string"))


def test_spans_of_mixed_texts(spark):
    m = model(spark)
    text = f"{EN}. {RU}! 42 {FR}"
    (lang, score, spans), = langid._labels(m, [text], 6.0, True)
    assert [s["lang"] for s in spans] == ["en", "ru", "fr"]
    assert [text[s["start"] : s["end"]] for s in spans] == [EN, RU, FR]
    letters = {s: sum(c.isalpha() for c in t) for s, t in (("en", EN), ("ru", RU), ("fr", FR))}
    assert lang == max(letters, key=letters.get) and abs(score - letters[lang] / sum(letters.values())) < 1e-12


def test_script_narrows_and_unknown_scripts_say_nothing(spark):
    m = model(spark)
    words = langid.Words([f"дом the {GR.split()[1]}"])
    emission = m.emissions(words)
    ru = m.languages.index("ru")
    assert np.isinf(emission[0, [i for i in range(3) if i != ru]]).all() and np.isfinite(emission[0, ru])
    assert np.isinf(emission[1, ru]) and (emission[2] == 0).all()


def test_letters_of_unknown_scripts_count_for_no_language(spark):
    m = model(spark)
    size = lambda x: sum(c.isalpha() for c in x)
    thai, han = "\u0e20\u0e32\u0e29\u0e32", "\u6c49\u5b57 \u5199\u6210\u7684 \u6587\u672c"
    mixed = f"{EN} {GR} {GR}"
    found = [(lang, score) for lang, score, _ in langid._labels(m, [GR, thai, han, mixed, EN, "42"], 6.0, True)]
    assert found[:3] == [(m.languages[0], 0.0)] * 3 and found[4:] == [("en", 1.0), ("und", 0.0)]
    assert found[3][0] == "en" and abs(found[3][1] - size(EN) / size(mixed)) < 1e-12


def test_viterbi_against_all_paths(spark):
    from itertools import product

    m = model(spark)
    texts = ["the maison et dog", "chien", "with собака cette the дом", "", "que they le"]
    words = langid.Words(texts)
    emission = m.emissions(words)
    label = m.viterbi(emission, words.count, 3.0)
    for t in range(len(texts)):
        own = np.flatnonzero(words.text == t)
        if not len(own):
            continue

        def value(path):
            return sum(emission[w, s] for w, s in zip(own, path)) - 3.0 * sum(a != b for a, b in zip(path, path[1:]))

        best = max(value(p) for p in product(range(3), repeat=len(own)))
        assert abs(value(label[own].tolist()) - best) < 1e-6


def test_long_texts_are_cut_at_blanks(spark, monkeypatch):
    m = model(spark)
    text = f"{EN}. {RU}! 42 {FR} " * 4
    whole = langid._labels(m, [text, None, EN], 6.0, True)
    monkeypatch.setattr(langid, "STEP_CHARS", 37)
    assert langid._labels(m, [text, None, EN], 6.0, True) == whole
    assert [a for a, _ in langid._cut("a" * 100)] == [0, 37, 74]


def test_languages_of_awkward_rows(spark):
    docs = awkward(spark)
    found = langid.language_of(docs, ~held_out(F.col("doc_id")), ["doc_id", "text"], spans=True).collect()
    assert len(found) == len(awkward_rows())
    by_id = {r["doc_id"]: r for r in found}
    for key in (3, 4, 5, 6):
        assert (by_id[key]["lang_pred"], by_id[key]["score"], by_id[key]["spans"]) == ("und", 0.0, [])
    assert all(r["lang_pred"] in ("en", "fr") for k, r in by_id.items() if k not in (3, 4, 5, 6))
    assert by_id[7]["lang_pred"] == "en" and 0 <= by_id[7]["score"] <= 1
    none = langid.language_of(docs, F.lit(False), ["doc_id"]).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    assert langid.language_of(nothing(spark), F.lit(True), ["doc_id"]).count() == 0


@needs_tables
def test_language_query_on_held_out_texts(spark):
    from supplyview.llm.queries import op8_language_id

    docs = table(spark, SF_DIR, "documents").select("doc_id", "lang")
    found = op8_language_id(spark, SF_DIR).join(docs, "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == docs.count() and held
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.97


def votes_by_hand(m, shares, k):
    out = []
    for x in shares:
        z = m._unit(m._weighted(x[None]) @ m.axes)[0]
        cosine = m.neighbours @ z
        near = np.argsort(-cosine, kind="stable")[:k]
        w = np.maximum(cosine[near], 0).astype(float) ** quality.SHARPNESS
        out.append((w * m.labels[near]).sum() / w.sum() if x.any() and w.sum() > 0 else m.prior)
    return np.array(out)


def test_tied_neighbours_vote_in_order():
    random = np.random.default_rng(1)
    cosine = random.integers(0, 4, (50, 60)) / 4
    for k in (1, 15, 60):
        want = [sorted(np.lexsort((np.arange(60), -row))[:k].tolist()) for row in cosine]
        assert [sorted(row) for row in quality.closest(cosine, k).tolist()] == want
    shares = np.tile(quality.raw_counts("some text that is always the same"), (60, 1))
    m = quality.Model(shares, np.repeat([1.0, 0.0], [15, 45]))
    assert abs(m.score(shares[:1])[0] - 1) < 1e-6


def test_one_text_of_a_repeated_id_is_fitted(spark):
    docs = [(i, f"text {i} of many", "x") for i in range(30)] + [(3, "another text", "x"), (3, "a third one!", "x")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    models = [quality.fit(docs.repartition(n), labels, "quality", F.lit(True)) for n in (1, 5)]
    assert len(models[0].labels) == 30 and (models[0].neighbours == models[1].neighbours).all()


def test_counts_of_long_texts(monkeypatch):
    text = "Some words, repeated; " * 50
    whole = quality.raw_counts(text)
    monkeypatch.setattr(quality, "SLICE", 7)
    assert (quality.raw_counts(text) == whole).all()


def test_votes_against_a_loop():
    random = np.random.default_rng(0)
    texts = [" ".join(random.choice(["good", "text", "here", "and"], 30)) + "." for _ in range(40)]
    texts += [" ".join(random.choice(["BAD!!", "***", "$$$"], 30)) for _ in range(40)]
    shares = np.array([quality.raw_counts(t) for t in texts])
    m = quality.Model(shares, np.repeat([1.0, 0.0], 40))
    probe = np.array([quality.raw_counts(t) for t in [*texts[:5], *texts[-5:], "", None, "some other good text"]])
    assert np.allclose(m.score(probe), votes_by_hand(m, probe, quality.NEIGHBOURS), atol=1e-5)
    assert (m.score(shares)[:40] > 0.7).all() and (m.score(shares)[40:] < 0.3).all()


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(1, 1, 5), (2, 1, 6), (2, 0, 6), (3, 0, 1), (8, None, 1), (9, 1, 1), (None, 1, 1), (999, 0, 1), (6, 0, 2)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, text int")
    m = quality.fit(docs, labels, "quality", F.lit(True))
    assert len(m.neighbours) == 4 and abs(m.prior - 3 / 5) < 1e-6
    found = quality.score(docs, m, ["doc_id", "text"], "own").collect()
    assert len(found) == len(awkward_rows())
    by_id = {r["doc_id"]: r["own"] for r in found}
    assert by_id[3] == by_id[4] == m.prior and all(0 <= s <= 1 for s in by_id.values())
    bare = quality.fit(docs, labels.limit(0), "quality", F.lit(True))
    assert {r["score"] for r in quality.score(docs, bare, ["doc_id"]).collect()} == {0.5}
    assert quality.score(nothing(spark), m, ["doc_id"]).count() == 0


@needs_tables
def test_quality_query_on_held_out_labels(spark):
    from supplyview.llm.queries import op2_quality_votes

    found = op2_quality_votes(spark, SF_DIR)
    assert found.count() == table(spark, SF_DIR, "documents").count()
    held = found.filter("held_out").join(table(spark, SF_DIR, "labels"), "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.95


def plain_scan(rows, templates, threshold):
    import re
    from collections import Counter

    def pairs(text):
        w = text.split()
        return Counter(zip(w, w[1:]))

    known = {k: pairs(" ".join(licences.words_of(t))) for k, t in templates.items()}
    out = {}
    for key, text in rows:
        tidy = re.sub(" ?\n ?", "\n", re.sub("[^a-z0-9\n]+", " ", (text or "").lower())).strip(" ")
        paragraphs = re.split("\n\n+", tidy)
        units = tidy.split("\n") + [p for p in paragraphs if "\n" in p] + [tidy] * ("\n\n" in tidy)
        for unit in map(pairs, units):
            for name, t in known.items():
                dice = 2 * (unit & t).total() / max(unit.total() + t.total(), 1)
                if dice >= threshold:
                    best, n = out.get((key, name), (0, 0))
                    out[key, name] = (max(best, dice), n + 1)
    return out


def test_scan_against_a_loop(spark):
    mit = licences.TEMPLATES["MIT"]
    rows = [(r[0], r[1]) for r in awkward_rows()] + [
        (20, mit), (21, mit.replace(". ", ".\n")), (22, "Preface here\n\n" + mit.replace("Software", "Work") + "\n\nend"),
        (23, mit[:500]), (24, "\n\nReleased under\nthe MIT License.\n\n"), (25, "released UNDER the MIT license\n" * 3),
        (26, "the MIT License the MIT License the MIT License"), (20, "Licensed under CC BY-NC 4.0."),
    ]
    docs = spark.createDataFrame([(k, t, 1, "x", 2) for k, t in rows], "doc_id long, text string, n int, unit string, unit_id int")
    found = licences.scan(docs).collect()
    want = plain_scan(rows, licences.TEMPLATES, licences.THRESHOLD)
    assert {(r["doc_id"], r["licence"]): r["n_units"] for r in found} == {k: n for k, (_, n) in want.items()}
    assert all(abs(r["dice"] - want[r["doc_id"], r["licence"]][0]) < 1e-12 for r in found)
    assert {(20, "MIT"), (21, "MIT"), (22, "MIT"), (24, "MIT line"), (11, "MIT line")} <= set(want)
    assert licences.scan(nothing(spark)).count() == 0


def best_windows(text, templates, threshold):
    """Licences of which any window of words reaches the threshold, with the best Dice: all are tried."""
    from collections import Counter

    w = licences.words_of(text)
    pairs = list(zip(w, w[1:]))
    out = {}
    for name, t in templates.items():
        t = licences.words_of(t)
        known, m = Counter(zip(t, t[1:])), len(t) - 1
        for a in range(len(pairs)):
            seen, common = Counter(), 0
            for b in range(a, min(len(pairs), a + int(m * (2 - threshold) / threshold) + 1)):
                seen[pairs[b]] += 1
                common += seen[pairs[b]] <= known[pairs[b]]
                dice = 2 * common / (b - a + 1 + m)
                if dice >= threshold:
                    out[name] = max(dice, out.get(name, 0))
    return out


APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_scan_finds_notices_of_several_paragraphs_and_inside_lines(spark):
    code = "\n\nimport os\n\ndef f(x):\n    return the(x) + 1\n" * 40
    mit = licences.TEMPLATES["MIT"].replace(": The above", ":\n\nThe above").replace(". THE SOFT", ".\n\nTHE SOFT")
    gpl = licences.TEMPLATES["GPL-3.0 notice"].replace(". This program is", ".\n\nThis program is").replace(
        "details. You", "details.\n\nYou")
    rows = [
        (1, APACHE_HEADER + code), (2, "\n".join(f"# {x}" for x in APACHE_HEADER.split("\n")) + code),
        (3, "Copyright (c) 2020 Some One\n\n" + mit + code), (4, code + gpl + code),
        (5, "Great article, read on. Released under the MIT License. And now the news of the day in the north."),
        (6, "Released under the MIT License.\nSee also: released under the MIT License, as said above and below."),
        (7, "the license of the software under the law " * 30), (8, mit + code + mit),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["licence"]): (r["dice"], r["n_units"]) for r in licences.scan(docs).collect()}
    want = {(k, name): d for k, text in rows for name, d in best_windows(text, licences.TEMPLATES, licences.THRESHOLD).items()}
    assert set(found) == set(want)
    assert {(1, "Apache-2.0 notice"), (2, "Apache-2.0 notice"), (3, "MIT"), (4, "GPL-3.0 notice"), (5, "MIT line")} <= set(found)
    # A line or paragraph that matches keeps its own Dice, words around the notice included.
    whole = {(k, name) for k, name in found if k in (1, 2) and name == "Apache-2.0 line"}
    assert all(abs(found[k][0] - want[k]) < 1e-12 for k in set(found) - whole)
    assert found[6, "MIT line"][1] == found[8, "MIT"][1] == 2 and found[5, "MIT line"] == (1.0, 1)


def test_scan_finds_customary_wordings(spark):
    rows = [(1, "Licensed under the MIT License"), (2, "This project is released under the MIT License."),
            (3, "The MIT License is short.")]
    found = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["licence"]) for r in found} == {(1, "MIT line"), (2, "MIT line")}


def test_scan_of_random_texts_finds_all_windows(spark):
    random = np.random.default_rng(3)
    templates = {"one": "a b c a b d", "two": "b c d", "three": "c a c a c a b e f a b"}
    texts = [" ".join(random.choice(list("abcdef"), n)) for n in random.integers(1, 40, 150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for threshold in (0.8, 0.55):
        found = {(r["doc_id"], r["licence"]) for r in licences.scan(docs, templates, threshold).collect()}
        want = {(k, name) for k, text in enumerate(texts) for name in best_windows(text, templates, threshold)}
        assert found == want and want


def test_scan_is_native(spark):
    plan = licences.scan(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


@needs_tables
@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_scan_against_sql(spark, threshold):
    from compare import compare, connect

    found = licences.scan(table(spark, SF_DIR, "documents"), threshold=threshold)
    assert compare(connect(SF_DIR), found, licences.scan_sql(threshold=threshold)) == []
