"""Sums kept by deltas against sums computed anew."""

import random

import pytest
from pyspark.sql import functions as F

from supplyview.operators import increments as N
from supplyview.operators import pivot as V
from supplyview.operators.facts import category_lookup
from supplyview.schemas import USAGE_STATUS
from supplyview.session import stage

FACT = "ingest_date date, product string, quantity double, status string"
DIM = "product string, category string"
STATUSES = ("INVENTORY", "SAILING", USAGE_STATUS)


def facts(spark, seed, days=(11, 12), n=300):
    rng = random.Random(seed)
    rows = [
        (rng.choice(days), rng.choice([f" p{i}" if i % 4 == 0 else f"p{i}" for i in range(20)] + ["hot"] * 10),
         rng.choice([None, 0.1, 7.25, 1e9, -3.5]), rng.choice(STATUSES))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "day int, product string, quantity double, status string").select(
        F.make_date(F.lit(2025), F.lit(8), "day").alias("ingest_date"), "product", "quantity", "status"
    )


def dims(spark, seed):
    rng = random.Random(seed)
    names = [f"p{i}" for i in range(20)] + ["hot", "unused"]
    rows = [(p, rng.choice(["A", "B", "", None, "N/A"])) for p in names if rng.random() < 0.7]
    return spark.createDataFrame(rows, DIM)


def anew(fact, dim):
    """The fact with categories the plain way: a lookup for every row. Decimals, as sums of doubles are not exact."""
    found = category_lookup(fact.withColumn("quantity", F.col("quantity").cast("decimal(28,9)")), dim).withColumn("_key", F.trim("product"))
    known = dim.select(F.col("product").alias("_key"), F.lit(True).alias("_known"))
    own = F.when((F.col("status") == USAGE_STATUS) & F.col("_known").isNull(), F.col("product"))
    return found.join(known, "_key", "left").withColumn("category", F.coalesce(own, "category"))


def rows(sums):
    return sorted(
        (str(r["ingest_date"]), r["category"], r["status"], round(float(r["quantity"] or 0), 6), r["n"])
        for r in sums.select("ingest_date", "category", "status", "quantity", F.col("n_rows").alias("n")).collect()
    )


def plain(fact, dim):
    return rows(
        anew(fact, dim).groupBy("ingest_date", "category", "status")
        .agg(F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n_rows"))
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_three_changes_equal_a_full_run(spark, tmp_path, seed):
    path = str(tmp_path / "partials")
    fact, dim = facts(spark, seed), dims(spark, seed)
    N.write_partials(N.partial_sums(fact), path, 8)
    sums = stage(N.category_sums(N.read_partials(spark, path), dim), "test")
    assert rows(sums) == plain(fact, dim)
    for step in range(3):
        after = dims(spark, 10 * seed + step)
        changes = N.changed_categories(dim, after)
        some = N.read_partials(spark, path, changes, 8)
        sums, dim = stage(N.refreshed(sums, N.moved(some, changes)), "test"), after
        assert rows(sums) == plain(fact, dim)
    # A date read again, with other rows, and a new one.
    later = facts(spark, seed + 50, (12, 13), 30)
    fact = N.replaced_dates(fact, later)
    N.write_partials(N.partial_sums(later), path, 8)
    sums = N.replaced_dates(sums, N.category_sums(N.partial_sums(later), dim))
    assert rows(sums) == plain(fact, dim)
    assert rows(N.category_sums(N.read_partials(spark, path), dim)) == plain(fact, dim)
    doubles = sums.withColumn("quantity", F.col("quantity").cast("double"))
    enhanced = [
        sorted(map(str, V.enhanced_pivot(V.category_status_sums(x, ["ingest_date"]), None, STATUSES, keys=["ingest_date"])
               .select("ingest_date", "category", *[F.round(f"`{s}`", 5) for s in (*STATUSES, "TOTAL")]).collect()))
        for x in (doubles, anew(fact, dim))
    ]
    assert enhanced[0] == enhanced[1]


def test_the_filter_on_changed_products_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "partials")
    N.write_partials(N.partial_sums(facts(spark, 3)), path, 8)
    before = spark.createDataFrame([("p1", "A"), ("p2", "B")], DIM)
    after = spark.createDataFrame([("p1", "C"), ("p2", "B")], DIM)
    changes = N.changed_categories(before, after)
    assert [tuple(r) for r in changes.collect()] == [("p1", "A", "C")]
    some = N.read_partials(spark, path, changes, 8)
    (held,) = changes.select(N.bucket(F.col("product"), 8)).first()
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(bucket,{held})" in plan or f"In(bucket, [{held}])" in plan
    assert {r[0] for r in some.select(N.bucket(F.col("product"), 8)).collect()} == {held}
    assert N.changed_categories(after, after).count() == 0
    nothing = N.read_partials(spark, path, N.changed_categories(after, after), 8)
    assert nothing.count() == 0


def test_empty_tables(spark):
    fact, dim = facts(spark, 1).limit(0), dims(spark, 1)
    sums = N.category_sums(N.partial_sums(fact), dim.limit(0))
    assert N.refreshed(sums, N.moved(N.partial_sums(fact), N.changed_categories(dim.limit(0), dim))).count() == 0
