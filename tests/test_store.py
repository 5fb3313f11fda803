"""Runs that become visible as one, and stores that concurrent runs keep whole."""

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
import xlsx
from pyspark.sql import functions as F

from supplyview import publish, run
from supplyview.schemas import DIMENSION, FACT
from supplyview.sinks import Store, store as S

QTY = "QTY (MT) /BL"


def sheets(*products):
    return {"SAILING": [["t", None], ["PRODUCT", QTY], *[[p, 1.0] for p in products]]}


def write(root, day, *products):
    xlsx.write(root / day / "deliveries.xlsx", sheets(*products))


def products(found):
    return sorted((r["ingest_date"].day, r["product"]) for r in found.collect())


def test_a_failed_run_leaves_the_old_date_whole(spark, tmp_path, monkeypatch):
    root, store = tmp_path / "input", Store(spark, str(tmp_path / "store"))
    write(root, "20250811", "Soya", "Corn")
    first = publish(spark, str(root), store.root, usage_file=None)
    assert first.number == 1 and products(store.read("fact")) == [(11, "Corn"), (11, "Soya")]
    pivot = store.read("pivot").orderBy("CATEGORY").collect()
    write(root, "20250811", "Rye")

    def fails(*args):
        raise OSError("the disk is full")

    # The facts are written already, the tables and the dimension are not.
    with monkeypatch.context() as patched:
        patched.setattr("supplyview.sinks.tables.write_tables_csv", fails)
        with pytest.raises(OSError):
            publish(spark, str(root), store.root, usage_file=None)
    assert store.latest() == first and products(store.read("fact")) == [(11, "Corn"), (11, "Soya")]
    assert store.read("pivot").orderBy("CATEGORY").collect() == pivot
    assert {r["product"] for r in store.dimension().collect()} == {"Soya", "Corn"}
    second = publish(spark, str(root), store.root, usage_file=None)
    assert second.number == 2 and products(store.read("fact")) == [(11, "Rye")]
    # Whoever holds the old version still reads it.
    assert products(store.read("fact", at=first)) == [(11, "Corn"), (11, "Soya")]
    assert {r["product"] for r in store.dimension().collect()} == {"Soya", "Corn", "Rye"}


def test_dates_come_from_their_runs(spark, tmp_path):
    root, store = tmp_path / "input", Store(spark, str(tmp_path / "store"))
    assert store.read("fact") is None and store.latest() == S.Version()
    write(root, "20250811", "Soya")
    publish(spark, str(root), store.root, usage_file=None)
    write(root, "20250812", "Corn")
    publish(spark, str(root), store.root, dates=["20250812"], usage_file=None)
    assert products(store.read("fact")) == [(11, "Soya"), (12, "Corn")]
    assert products(store.read("fact", ["2025-08-12"])) == [(12, "Corn")]
    assert {r["ingest_date"].day for r in store.read("pivot").collect()} == {11, 12}
    with pytest.raises(ValueError):
        store.read("tables")


def local(root, day, header):
    xlsx.write(
        root / day / "local.xlsx",
        {"UNSERVED LOCAL": [["t", None, None], [header, "SUPPLIER", "STILL TO BE DELIVERED (in kilos)"], [f"of {header}", "S", 1.0]]},
    )


def test_two_runs_from_one_version_lose_nothing(spark, tmp_path):
    from supplyview import Options

    store, split = Store(spark, str(tmp_path / "store")), Options(layout="split")
    headers = {"20250811": "Raw Material", "20250812": "RAW MATERIALS."}
    results = []
    for day, header in headers.items():
        local(tmp_path / "input", day, header)
        results.append(run(spark, str(tmp_path / "input"), None, [day], None, split))
    base = store.latest()
    first, second = (store.publish(r, base) for r in results)
    assert (first.number, second.number) == (1, 2)
    assert {r["alias"] for r in store.aliases().collect()} == set(headers.values())
    assert {r["product"] for r in store.dimension().collect()} == {f"of {h}" for h in headers.values()}
    assert {d for d, _ in products(store.read("fact"))} == {11, 12}


def results_of(spark, number):
    """What a run gives, made up: one product, one alias, one day."""
    from supplyview.plans.runs import reports
    from supplyview.schemas import ALIASES

    fact = spark.createDataFrame([(f"p{number}", 1.0, "SAILING", "")], "product string, quantity double, status string, category string")
    fact = fact.select(F.to_date(F.lit(f"2025-08-{number + 10}")).alias("ingest_date"), "*").to(FACT)
    aliases = spark.createDataFrame([("T", "NAME", f"alias {number}")], ALIASES)
    return replace(reports(fact, spark.createDataFrame([], DIMENSION)), aliases=aliases)


def test_concurrent_runs_keep_the_stores_whole(spark, tmp_path):
    store, n = Store(spark, str(tmp_path / "store")), 4
    found = [results_of(spark, i) for i in range(n)]
    base = store.latest()
    with ThreadPoolExecutor(n) as threads:
        versions = list(threads.map(lambda r: store.publish(r, base), found))
    assert sorted(v.number for v in versions) == list(range(1, n + 1))
    assert {r["alias"] for r in store.aliases().collect()} == {f"alias {i}" for i in range(n)}
    assert {r["product"] for r in store.dimension().collect()} == {f"p{i}" for i in range(n)}
    assert products(store.read("fact")) == [(i + 10, f"p{i}") for i in range(n)]


def test_categories_of_the_other_run_stand(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    dim = spark.createDataFrame([("p0", "meal", 0)], DIMENSION)
    known = replace(results_of(spark, 0), dimension=dim)
    base = store.latest()
    store.publish(known, base)
    store.publish(results_of(spark, 0), base)
    assert [(r["product"], r["category"]) for r in store.dimension().collect()] == [("p0", "meal")]


def test_a_number_is_taken_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store._commit(S.Version(1, {"2025-08-11": "data/a"})) and not store._commit(S.Version(1))
    assert store.latest().dates == {"2025-08-11": "data/a"}
    names = sorted(p.name for p in (tmp_path / "store" / "versions").iterdir() if not p.name.endswith(".crc"))
    assert names == ["000000000001.json"] and json.loads((tmp_path / "store" / "versions" / names[0]).read_text())["number"] == 1
