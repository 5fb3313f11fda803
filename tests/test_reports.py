"""Fact, dimension, usage, pivot, risk and quality operators."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from supplyview.operators import dimension as D
from supplyview.operators import facts as P
from supplyview.operators import joins as J
from supplyview.operators import pivot as V
from supplyview.operators import quality as Q
from supplyview.operators import routing as R
from supplyview.operators import usage as U
from supplyview.schemas import DIMENSION, FACT, USAGE

FACTS = "product string, quantity double, status string, category string"


def dim(spark, *entries):
    return spark.createDataFrame([(p, c, i) for i, (p, c) in enumerate(entries)], DIMENSION)


def usage(spark, *entries):
    return spark.createDataFrame([(n, float(a), 0.0, i) for i, (n, a) in enumerate(entries)], USAGE)


def by(df, key, *values):
    return {r[key]: tuple(r[v] for v in values) for r in df.collect()}


# --- fact --------------------------------------------------------------------


def test_units_and_legacy_units(spark):
    rows = spark.createDataFrame(
        [("Soya", "1,5", "UNSERVED_LOCAL"), ("Soya", "500", "UNSERVED_LOCAL"),
         ("Soya", "500", "INVENTORY"), ("Soya", "2", "LANDED"), ("  ", "1", "INVENTORY"), (None, "1", "LANDED")],
        "product string, quantity_text string, table string",
    )
    got = sorted(P.quantity_fact(rows).collect(), key=lambda r: (r["status"], r["quantity"] or 0))
    assert [(r["status"], r["quantity"]) for r in got] == [
        ("INVENTORY", 0.5), ("LANDED", 2.0), ("UNSERVED LOCAL", None), ("UNSERVED LOCAL", 0.5),
    ]
    legacy = {(r["status"], r["quantity"]) for r in P.quantity_fact(rows, True).collect()}
    assert ("UNSERVED LOCAL", 500000.0) in legacy and ("INVENTORY", 500.0) in legacy


def test_category_lookup_states(spark):
    known = dim(spark, ("Soya", "meal"), ("Oats", ""), ("Corn", "N/A"))
    fact = spark.createDataFrame([(p,) for p in (" Soya ", "Oats", "Corn", "Rye", "soya", None)], "product string")
    got = by(P.category_lookup(fact, known), "product", "category")
    assert got == {" Soya ": ("meal",), "Oats": ("",), "Corn": ("N/A",), "Rye": ("",), "soya": ("",), None: ("",)}


@pytest.mark.parametrize("broadcast_bytes", [0, J.BROADCAST_BYTES])
def test_lookup_join_is_whole_either_way(spark, broadcast_bytes):
    rng = random.Random(3)
    keys = ["hot"] * 3000 + [f"k{rng.randint(0, 400)}" for _ in range(3000)] + [None] * 50
    facts = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    small = spark.createDataFrame([(f"k{n}", n) for n in range(0, 400, 2)] + [("hot", -1)], "k string, v int")
    got = J.lookup_join(facts, small, ["k"], broadcast_bytes).collect()
    lookup = {f"k{n}": n for n in range(0, 400, 2)} | {"hot": -1}
    assert sorted((r["i"], r["k"], r["v"]) for r in got) == [(i, k, lookup.get(k)) for i, k in enumerate(keys)]


def test_hot_keys_are_few_and_found(spark):
    facts = spark.createDataFrame([("hot",)] * 500 + [(f"k{i}",) for i in range(500)], "k string")
    assert [r["k"] for r in J.hot_keys(facts, ["k"], 10).collect()] == ["hot"]


def test_combine_fills_missing_columns_and_nothing(spark):
    a = spark.createDataFrame([("x", 1.0)], "product string, quantity double")
    b = spark.createDataFrame([("y", "L")], "product string, status string")
    assert {tuple(r) for r in P.combine([a, b]).collect()} == {("x", 1.0, None), ("y", None, "L")}
    empty = P.combine([], spark)
    assert empty.schema == FACT and empty.count() == 0


def test_status_filters(spark):
    fact = spark.createDataFrame([("a", 1.0, "landed", ""), ("b", 1.0, "GLOBAL USAGE", "")], FACTS)
    assert [r["product"] for r in P.with_status(fact, "LANDED").collect()] == ["a"]
    assert [r["product"] for r in P.usage_rows(fact).collect()] == ["b"]


def test_required_columns_and_routing(spark):
    stock = spark.createDataFrame([(1, 2)], "PRODUCT int, TOTAL int")
    R.require_columns(stock, "UNSERVED IMPORTED")
    R.require_columns(stock, "SOMETHING ELSE")
    with pytest.raises(ValueError, match="RAW MATERIALS"):
        R.require_columns(stock, "UNSERVED_LOCAL")
    sheets = spark.createDataFrame([(s,) for s in ("LANDED.PULL-OUT", "landed pull out", "UNSERVED_LOCAL", "SUMMARY")], "s string")
    assert [r[0] for r in sheets.select(R.route_combined(F.col("s"))).collect()] == [
        "STACKED", "STACKED", "UNSERVED LOCAL", "SUMMARY",
    ]
    assert [r[0] for r in sheets.select(R.route_named(F.col("s"))).collect()] == [
        "STACKED", "STACKED", "UNSERVED LOCAL", "SUMMARY",
    ]


# --- dimension ---------------------------------------------------------------


def test_dimension_upkeep(spark):
    known = dim(spark, ("Soya", "meal"), ("Oats", ""), ("Corn", " n/a "), ("Barley", "grain"))
    fact = spark.createDataFrame([(p,) for p in ("Rye", " Rye", "Oats", "Soya", "Zinc")], "product string")
    added = D.new_products(fact, known)
    assert sorted(r["product"] for r in added.collect()) == ["Rye", "Zinc"]
    assert added.join(known, "product").count() == 0
    assert [r["product"] for r in D.blank_category_products(fact, known).collect()] == ["Oats"]
    grown = D.append_products(known, added)
    assert [r["product"] for r in D.dimension_sorted(grown).collect()] == [
        "Barley", "Soya", "Corn", "Oats", "Rye", "Zinc",
    ]
    assert Q.uncategorized_counts(grown).first().asDict() == {"n_blank": 3, "n_blank_or_na": 4}


def test_alias_store_is_a_set(spark):
    schema = "table string, expected string, alias string"
    store = spark.createDataFrame([("T", "E", "a")], schema)
    found = spark.createDataFrame([("T", "E", "a"), ("T", "E", "b")], schema)
    assert sorted(r["alias"] for r in D.upsert_aliases(store, found).collect()) == ["a", "b"]


# --- usage -------------------------------------------------------------------


def test_usage_categories(spark):
    known = dim(spark, ("Soya", "meal"), ("Oats", ""))
    lines = usage(spark, ("Soya", 1000), ("Oats", 500), ("Zinc", 10), ("Zinc", 30))
    got = sorted((r["product"], r["quantity"], r["category"]) for r in U.usage_fact(lines, known).collect())
    # Both rows of an unknown ingredient get its own name as category.
    assert got == [("Oats", 0.5, ""), ("Soya", 1.0, "meal"), ("Zinc", 0.01, "Zinc"), ("Zinc", 0.03, "Zinc")]


def test_monthly_usage_rules_take_the_first_row(spark):
    lines = usage(spark, ("Soya", 12000), ("Soya", 5), ("Corn", 0))
    assert by(U.monthly_usage(lines), "ingredient_name", "monthly_usage") == {"Soya": (12.0,), "Corn": (0.0,)}
    assert by(U.monthly_usage(lines, "annual"), "ingredient_name", "monthly_usage")["Soya"] == (1000.0,)
    assert by(U.monthly_usage(lines, "annual_kilos"), "ingredient_name", "monthly_usage")["Soya"] == (1.0,)


def loop_mapping(products, names):
    out = {}
    for name in names:
        hit = name if name in products else next(
            (p for p in products if p.strip() and (p.lower() in name.lower() or name.lower() in p.lower())), None
        )
        out[name] = (hit or name, hit is None)
    return out


def test_fuzzy_map_takes_the_first_entry_in_file_order(spark):
    entries = [("US SOYA MEAL", "m"), ("SOYA OIL", "o"), ("  ", "x"), ("Corn", "c"), ("ob", "n")]
    names = ["soya", "SOYA OIL", "yellow corn gluten", "Zinc", "Cobalt", "Corn"]
    got = by(U.ingredient_map_fuzzy(usage(spark, *[(n, 1) for n in names]), dim(spark, *entries)),
             "ingredient_name", "mapped_product", "is_new")
    assert got == loop_mapping([e[0] for e in entries], names)
    assert got["soya"] == ("US SOYA MEAL", False) and got["Zinc"] == ("Zinc", True)


def test_fuzzy_map_against_a_loop_on_random_names(spark):
    rng = random.Random(11)

    def word():
        return "".join(rng.choice("abAB ") for _ in range(rng.randint(1, 6))).strip() or "a"

    products = list(dict.fromkeys(word() for _ in range(60)))
    names = list(dict.fromkeys(word() for _ in range(60)))
    got = by(U.ingredient_map_fuzzy(usage(spark, *[(n, 1) for n in names]), dim(spark, *[(p, "c") for p in products])),
             "ingredient_name", "mapped_product", "is_new")
    assert got == loop_mapping(products, names)


def test_fuzzy_map_against_a_loop_on_long_names(spark):
    rng = random.Random(5)

    def words(n):
        return " ".join(rng.choice(["material", "soya", "meal", "raw", "oil", "x"]) for _ in range(n))

    products = list(dict.fromkeys(words(rng.randint(1, 4)) for _ in range(80)))
    names = list(dict.fromkeys(words(rng.randint(1, 7)).upper() for _ in range(80)))
    got = by(U.ingredient_map_fuzzy(usage(spark, *[(n, 1) for n in names]), dim(spark, *[(p, "c") for p in products])),
             "ingredient_name", "mapped_product", "is_new")
    assert got == loop_mapping(products, names)


@pytest.mark.parametrize("length", [2_000, 20_000])
def test_candidates_grow_with_the_length_of_a_name(spark, length):
    rng = random.Random(length)
    name = "".join(rng.choice("abcdefgh") for _ in range(length))
    whole = spark.createDataFrame([(name,)], "text string")
    assert U._cuts(whole, [U.GRAM]).count() <= length
    assert U._cuts(whole, range(1, U.GRAM)).count() <= (U.GRAM - 1) * length
    inner = [(name[i : i + n],) for i, n in ((0, 3), (5, 6), (100, 1500), (length - 7, 7))] + [("zz",), ("z" * 50,)]
    found = U.containing(whole, spark.createDataFrame(inner, "text string")).select("inner").collect()
    assert {r["inner"] for r in found} == {t for (t,) in inner if t in name}


def test_new_ingredients_and_exact_map(spark):
    known = dim(spark, ("Soya", "meal"))
    lines = usage(spark, ("Soya", 1), ("Soya Oil", 1), ("Zinc", 1))
    exact = by(U.ingredient_map_exact(lines, known), "ingredient_name", "mapped_product", "is_new")
    assert exact == {"Soya": ("Soya", False), "Soya Oil": ("Soya Oil", True), "Zinc": ("Zinc", True)}
    fuzzy = U.ingredient_map_fuzzy(lines, known)
    assert [r["product"] for r in U.new_ingredients(fuzzy, known).collect()] == ["Zinc"]


def test_usage_through_products(spark):
    known = dim(spark, ("Soya", "meal"), ("Corn", "grain"))
    lines = usage(spark, ("soya flour", 120), ("Soya", 240), ("Rye", 12))
    mapping = U.ingredient_map_fuzzy(lines, known)
    fact = spark.createDataFrame([("Soya", "meal"), ("Soya", "meal"), ("Corn", "grain"), ("Rye", "x")], "product string, category string")
    got = by(U.usage_by_category_fuzzy(fact, lines, mapping), "category", "monthly_usage")
    # Soya takes its first ingredient's usage, Corn has none, Rye uses its own name.
    assert got == {"meal": (10.0,), "grain": (0.0,), "x": (1.0,)}


# --- pivot and planning ------------------------------------------------------


def fact_of(spark, *rows):
    return spark.createDataFrame([(f"p{i}", q, s, c) for i, (c, s, q) in enumerate(rows)], FACTS)


def test_pivot_totals_leave_usage_and_na_out(spark):
    fact = fact_of(
        spark,
        ("meal", "LANDED", 10.0), ("meal", "INVENTORY", 5.0), ("meal", "GLOBAL USAGE", 3.0),
        ("", "SAILING", 2.0), (None, "LANDED", 1.0), ("N/A", "LANDED", 99.0), (" n/a", "LANDED", 99.0),
        ("bad", "PULLOUT", None),
    )
    rows = V.pivot_with_totals(V.category_status_sums(fact)).collect()
    assert [r["category"] for r in rows] == ["Uncategorized", "bad", "meal", "TOTAL"]
    meal, total = rows[2], rows[3]
    assert (meal["LANDED"], meal["INVENTORY"], meal["TOTAL"], meal["GLOBAL USAGE"]) == (10.0, 5.0, 15.0, 3.0)
    assert (total["LANDED"], total["TOTAL"], total["GLOBAL USAGE"]) == (11.0, 18.0, 3.0)
    assert rows[1]["PULLOUT"] == 0.0
    assert rows[0].asDict().keys() >= {"UNSERVED LOCAL", "TOTAL"}


def test_a_category_named_total_is_not_the_total_row(spark):
    fact = fact_of(spark, ("TOTAL", "LANDED", 1.0), ("z", "LANDED", 2.0))
    rows = V.pivot_with_totals(V.category_status_sums(fact)).collect()
    assert [(r["category"], r["LANDED"]) for r in rows] == [("TOTAL", 1.0), ("z", 2.0), ("TOTAL", 3.0)]


def test_enhanced_pivot_projects_from_the_real_total(spark):
    fact = fact_of(spark, ("meal", "LANDED", 25.0), ("meal", "GLOBAL USAGE", 10.0), ("Zinc", "GLOBAL USAGE", 4.0))
    sums = V.category_status_sums(fact)
    rows = by(V.enhanced_pivot(sums), "category", "TOTAL", V.MONTHLY_USAGE, "1 Month Projection", "6 Month Projection")
    assert rows == {"meal": (25.0, 10.0, 15.0, -35.0), "Zinc": (0.0, 4.0, -4.0, -24.0), "TOTAL": (25.0, 14.0, 11.0, -59.0)}
    legacy = by(V.enhanced_pivot(sums, legacy_zero_total=True), "category", "1 Month Projection")
    assert legacy["meal"] == (-10.0,)


def test_enhanced_pivot_with_separate_usage(spark):
    fact = fact_of(spark, ("meal", "LANDED", 25.0))
    separate = spark.createDataFrame([("meal", 5.0), ("only usage", 2.0)], "category string, monthly_usage double")
    rows = by(V.enhanced_pivot(V.category_status_sums(fact), separate), "category", "TOTAL", V.MONTHLY_USAGE, "2 Month Projection")
    assert rows == {"meal": (25.0, 5.0, 15.0), "only usage": (0.0, 2.0, -4.0), "TOTAL": (25.0, 7.0, 11.0)}
    plan = V.category_plan(V.category_status_sums(fact), separate)
    assert by(plan, "category", "total", "monthly_usage") == {"meal": (25.0, 5.0), "only usage": (0.0, 2.0)}


def test_risk_flags(spark):
    stock = spark.createDataFrame([(0.0, 10.0), (5.0, 10.0), (15.0, 10.0), (25.0, 10.0), (5.0, 0.0), (None, 1.0), (-1.0, 0.0)], "i double, u double")
    got = [r[0] for r in stock.select(V.inventory_flag(F.col("i"), F.col("u"))).collect()]
    assert got == ["critical", "red", "yellow", "none", "none", "critical", "critical"]
    months = spark.range(1, 7).select(F.col("id").cast("int").alias("m"))
    flags = months.select(V.projection_flag(F.lit(25.0), F.lit(10.0), F.col("m"))).collect()
    assert [r[0] for r in flags] == ["none", "none"] + ["stockout"] * 4
    assert months.select(V.projection_flag(F.lit(0.0), F.lit(10.0), F.col("m"))).first()[0] == "no_stock"
    assert months.select(V.projection_flag(F.lit(0.0), F.lit(0.0), F.col("m"))).first()[0] == "none"


def test_display_of_the_pivot(spark):
    fact = fact_of(spark, ("meal", "LANDED", 1234.6), ("meal", "GLOBAL USAGE", 1000.25), ("back", "LANDED", -5.5))
    shown = by(V.pivot_display(V.enhanced_pivot(V.category_status_sums(fact))), "category", "LANDED", "SAILING", "GLOBAL USAGE", "1 Month Projection", "TOTAL")
    assert shown["meal"] == ("1,235", "-", "1,000.25", "234.35", "1,235")
    assert shown["back"][0] == "-5.5"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", "", "N/A", None]),
            st.sampled_from(["LANDED", "SAILING", "INVENTORY", "GLOBAL USAGE"]),
            st.integers(-1000, 1000).map(float),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_pivot_adds_up(spark, rows):
    sums = V.category_status_sums(fact_of(spark, *rows))
    kept = [r for r in rows if r[0] != "N/A"]
    want = sum(q for _, s, q in kept if s != "GLOBAL USAGE")
    pivot = V.pivot_with_totals(sums).collect()
    if not kept:
        assert pivot == []
        return
    assert pivot[-1]["TOTAL"] == want
    assert sum(r["TOTAL"] for r in pivot[:-1]) == want
    long = V.projection_long(V.category_plan(sums)).collect()
    for r in long:
        assert r["projection"] == r["total"] - r["monthly_usage"] * r["month"]
    assert len(long) == 6 * (len(pivot) - 1)


# --- quality -----------------------------------------------------------------


def test_counts(spark):
    fact = fact_of(spark, ("a", "LANDED", 1.0), ("", "LANDED", 1.0), ("N/A", "SAILING", 1.0), (None, "sailing", 1.0), ("n/a ", "X", 1.0))
    assert [tuple(r) for r in Q.status_counts(fact).collect()][0] == ("LANDED", 2)
    assert by(Q.status_counts_fixed(fact), "status", "n_rows") == {
        "SAILING": (2,), "LANDED": (2,), "PULLOUT": (0,), "UNSERVED IMPORTED": (0,), "UNSERVED LOCAL": (0,),
    }
    assert by(Q.category_counts(fact), "category", "n_rows")["No category"] == (2,)
    assert [r["product"] for r in Q.na_products(fact).collect()] == ["p2", "p4"]
    assert tuple(Q.exclusion_counts(fact).first()) == (5, 2, 3)
    assert tuple(Q.pivot_shape(V.category_status_sums(fact)).first()) == (2, 2)


def test_profile(spark):
    df = spark.createDataFrame([("x", None), (None, None)], "`a.b` string, n int")
    rows = {r["column"]: r for r in Q.table_profile({"t": df, "u": df.limit(0)}).filter("table = 't'").collect()}
    assert rows["a.b"]["null_count"] == 1 and rows["n"]["null_count"] == 2
    assert rows["n"]["dtype"] == "int" and rows["n"]["n_rows"] == 2 and rows["n"]["n_columns"] == 2


def test_product_search_reports_merged_rows(spark):
    table = spark.createDataFrame(
        [("s", i, ["RAW MATERIALS", "SUPPLIER", "DELIVERED KILOS"], [name, f"sup{i}", str(i)])
         for i, name in enumerate(["corn", "US soya", "soya us"] + ["US SOYA"] * 40)],
        "sheet string, row_idx bigint, header array<string>, cells array<string>",
    )
    ranges = spark.createDataFrame(
        [("s", 1, 0, 0, 2, "US SOYA"), ("s", 5, 1, 2, 9, "other columns")],
        "sheet string, top bigint, left int, right int, last_row bigint, value string",
    )
    found = Q.product_search(table, "us soya", "RAW MATERIALS", ["sheet"], ranges=ranges)
    rows = {r["row_idx"]: r for r in found.collect()}
    assert sorted(rows) == [1, *range(2, 43)]
    plain = Q.product_search(table, "us soya", "RAW MATERIALS", ["sheet"], 29)
    assert sorted(r["row_idx"] for r in plain.collect()) == [1, *range(3, 29)]
    assert (rows[1]["merged_from_row"], rows[1]["merged_to_row"]) == (1, 2)
    assert (rows[2]["product"], rows[2]["merged_from_row"]) == ("US SOYA", 1)
    assert rows[3]["merged_from_row"] is None and rows[3]["merged_to_row"] is None
    assert (rows[5]["supplier"], rows[5]["quantity"]) == ("sup5", "5")
    assert tuple(Q.search_counts(found, ["sheet"]).first()) == ("s", 42, 2)
