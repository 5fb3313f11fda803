"""Sheet operators on small grids, and on random grids cut into tiny blocks."""

from collections import defaultdict
from itertools import zip_longest

import pytest
from grids import (
    KEYS, boundaries, boundaries_legacy, first_column_tables, grid, marker_tables, patterns,
    random_sheets, text_grid,
)
from pyspark.sql import functions as F

from supplyview.operators import clean as C
from supplyview.operators import fallback, fill
from supplyview.operators import headers as H
from supplyview.operators import segments as S
from supplyview.operators.blocks import attach_facts, with_neighbours, with_running
from supplyview.session import stage

BLOCKS = [3, 1000]


def header_rows(found):
    return {r["sheet"]: r["header_row"] for r in found.collect()}


def ranges(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["sheet"]].append((r["start_row"], r["end_row"]))
    return {s: sorted(v) for s, v in out.items()}


def tables(df):
    out = defaultdict(dict)
    for r in df.collect():
        assert r["row_idx"] not in out[r["sheet"]], "a row in two tables"
        out[r["sheet"]][r["row_idx"]] = r["table"]
    return dict(out)


# --- headers -----------------------------------------------------------------


def test_header_below_title(spark):
    rows = text_grid(spark, s="REPORT,_,_/PRODUCT,QTY (MT) /BL,NOTE/Soya,12,x")
    assert header_rows(H.header_strict(rows, KEYS)) == {"s": 1}


def test_earliest_row_wins_a_tie_and_dash_counts(spark):
    rows = text_grid(spark, tie="A,B,C/D,E,F", dash="-,-,A/B,C,_")
    assert header_rows(H.header_strict(rows, KEYS)) == {"tie": 0, "dash": 0}


def test_digit_led_header_needs_the_lenient_rule(spark):
    rows = text_grid(spark, s="2024 QTY,PRODUCT/1,2")
    assert header_rows(H.header_strict(rows, KEYS)) == {}
    assert header_rows(H.header_lenient(rows, KEYS)) == {"s": 0}


def test_lenient_rule_leaves_one_row_sheets_alone(spark):
    assert header_rows(H.header_lenient(text_grid(spark, s="A,B"), KEYS)) == {}


def test_score_rule_sees_ten_rows(spark):
    sheets = {f"at{n}": [["1", "2"]] * n + [["A", "B"]] for n in (9, 10)}
    assert header_rows(H.header_strict(grid(spark, sheets), KEYS)) == {"at9": 9}


def test_required_labels_within_25_rows(spark):
    sheets = {f"at{n}": [["x", None]] * n + [[" ITEM DESCRIPTION", "QTY IN KGS "]] for n in (24, 25)}
    assert header_rows(H.header_required(grid(spark, sheets), KEYS)) == {"at24": 24}


def test_anchor_has_no_row_limit(spark):
    rows = grid(spark, {"s": [["x", None]] * 300 + [[None, "the contract no"]], "none": [["x", "y"]]})
    assert header_rows(H.header_anchor(rows, "CONTRACT", KEYS)) == {"s": 300}


def test_priority_steps(spark):
    product, quantity = H.LOCAL_PRODUCT, H.LOCAL_QUANTITY
    sheets = {
        "one": [["a", "b"], [" raw materials ", None]],
        "three": [["1", "b"], ["a", "b"]],
        "late": [["1", None]] * 200 + [["a", "b"]],
        "far": [["1", None]] * 400 + [[product, quantity]],
    }
    got = {r["sheet"]: (r["header_row"], r["step"]) for r in H.header_priority(grid(spark, sheets), KEYS).collect()}
    assert got == {"one": (1, 1), "three": (1, 3), "far": (400, 1)}


def test_label_row_is_the_fallback_header(spark):
    rows = grid(spark, {"s": [["PRODUCT", "TOTAL"], ["1", "2"], ["3", "4"]]}, first=-1)
    found = H.pick_header(rows, H.or_label_row(H.score_rank()), KEYS)
    assert header_rows(found) == {"s": -1}
    promoted = H.promote_header(rows, found, KEYS).orderBy("row_idx").collect()
    assert [(r["row_idx"], r["cells"]) for r in promoted] == [(0, ["1", "2"]), (1, ["3", "4"])]


@pytest.mark.parametrize("base", [0, 1])
def test_names_blanks_and_duplicates(spark, base):
    rows = spark.createDataFrame([([" PRODUCT ", "QTY", None, "QTY", " "],)], "c array<string>")
    got = rows.select(H.header_names(F.col("c"), base)).first()[0]
    assert got == ["PRODUCT", "QTY", f"Column_{2 + base}", "QTY_2", f"Column_{4 + base}"]
    raw = rows.select(H.header_names(F.col("c"), base, raw=True)).first()[0]
    assert raw[0] == " PRODUCT "


@pytest.mark.parametrize("names", [
    ["QTY", "QTY_2", "QTY"], ["QTY", "QTY", "QTY_2"], ["A", "A_3", "A", "A", "A_3"], ["A", "A_2", "A", "A_2_2"],
])
def test_numbered_names_meet_no_other_name(spark, names):
    rows = spark.createDataFrame([(names,)], "c array<string>")
    got = rows.select(H.header_names(F.col("c"))).first()[0]
    assert len(set(got)) == len(got)
    assert all(a.startswith(b) for a, b in zip(got, names))
    assert got[: len(set(names))][0] == names[0]


def test_fuzzy_rename_prefers_exact_then_alias_then_rule(spark):
    headers = spark.createDataFrame(
        [
            ("exact", ["raw material code", "Raw Materials", "still to be delivered (IN KILOS)"]),
            ("alias", ["stuff", "raw material", "left"]),
            ("fuzzy", ["x", "The raw-material", "Still to be delivered kg"]),
            ("none", ["x", "y", "z"]),
        ],
        "sheet string, header array<string>",
    )
    aliases = {H.LOCAL_PRODUCT: ["Stuff"]}
    got = {r["sheet"]: r for r in H.rename_headers(headers, aliases=aliases).collect()}
    p, q = H.LOCAL_PRODUCT, H.LOCAL_QUANTITY
    assert got["exact"]["header"] == ["raw material code", p, q]
    assert got["alias"]["header"] == [p, "raw material", "left"]
    assert got["fuzzy"]["header"] == ["x", p, q]
    assert got["none"]["header"] == ["x", "y", "z"]
    assert [tuple(c) for c in got["fuzzy"]["captured"]] == [
        (p, "The raw-material"), (q, "Still to be delivered kg"),
    ]
    assert got["exact"]["captured"] == [] and got["alias"]["captured"] == []


# --- splitting ---------------------------------------------------------------


def test_stacked_tables(spark):
    rows = text_grid(
        spark,
        both="LANDED TABLE,_/h,i/1,2/PULL-OUT TABLE,_/h,i/3,4",
        two_landed="LANDED,_/a,b/LANDED,_/c,d/PULL,_/e,f",
        pull_first="FOR PULL-OUT,_/a,b/LANDED,_/c,d",
        pull_only="a,b/c,PULL TABLE/d,e",
        landed_only="LANDED,_/a,b",
    )
    got = tables(S.split_markers(rows, KEYS))
    assert got["both"] == {1: "LANDED", 2: "LANDED", 4: "PULLOUT", 5: "PULLOUT"}
    assert got["two_landed"] == {3: "LANDED", 5: "PULLOUT"}
    assert got["pull_only"] == {0: "LANDED", 2: "PULLOUT"}
    assert set(got) == {"both", "two_landed", "pull_only"}


def test_first_column_split_takes_either_order(spark):
    rows = text_grid(spark, s="FOR PULL-OUT,_/h,i/a,b/LANDED,_/j,k/c,d", one="x,y/LANDED,_/j,k")
    got = tables(S.split_first_col(rows, KEYS))
    assert got["s"] == {1: "PULLOUT", 2: "PULLOUT", 4: "LANDED", 5: "LANDED"}
    assert got["one"] == {2: "LANDED"}


def test_blank_row_split(spark):
    rows = text_grid(spark, s="a,b/_,_/c,d/_,_/e,f", whole="a,b/c,d")
    got = tables(S.split_blank_row(rows, KEYS))
    assert got["s"] == {0: "LANDED", 2: "PULLOUT", 3: "PULLOUT", 4: "PULLOUT"}
    assert set(got["whole"].values()) == {"LANDED"}


def test_trailing_nulls_do_not_part_rows(spark):
    rows = grid(spark, {"s": [["a", "b"], ["a", "b", None], ["c"]]})
    assert ranges(S.table_boundaries(rows, KEYS)) == {"s": [(1, 2)]}
    same = grid(spark, {"s": [["a", "b"], ["c", "d", None]]})
    assert ranges(S.null_pattern_segments(same, KEYS)) == {}


def test_three_blank_rows_make_no_table(spark):
    rows = text_grid(spark, s="a,b/_,_/_,_/_,_/c,d")
    assert ranges(S.table_boundaries(rows, KEYS)) == {"s": [(0, 0), (4, 4)]}
    assert ranges(S.table_boundaries(rows, KEYS, legacy=True)) == {"s": [(0, 0), (2, 2), (4, 4)]}


def test_midpoint_needs_numbers_and_text(spark):
    rows = text_grid(spark, mixed="a,1/b,2/c,3", text="a,b/c,d", numbers="1,2/3,4")
    assert tables(S.midpoint_split(rows, KEYS)) == {
        "mixed": {0: "LANDED", 1: "PULLOUT", 2: "PULLOUT"}
    }


def test_advanced_split_falls_through_its_rules(spark):
    rows = text_grid(
        spark,
        marked="LANDED,_/h,i/1,2",
        bounded="a,b/_,_/c,d/_,_/e,f",
        patterned="a,b,_/c,_,d",
        halved="a,1/b,2/c,3",
        nothing="a,b/c,d",
    )
    assert tables(fallback.advanced_split(rows, KEYS)) == {
        "marked": {1: "LANDED", 2: "LANDED"},
        "bounded": {0: "LANDED", 2: "PULLOUT"},
        "patterned": {0: "LANDED", 1: "PULLOUT"},
        "halved": {0: "LANDED", 1: "PULLOUT", 2: "PULLOUT"},
    }
    assert tables(fallback.basic_split(rows, KEYS))["bounded"] == {
        0: "LANDED", 2: "PULLOUT", 3: "PULLOUT", 4: "PULLOUT",
    }


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_random_sheets_against_plain_loops(spark, block_rows):
    """Blocks of three rows put every rule across many block borders."""
    sheets = random_sheets(seed=block_rows)
    rows = grid(spark, sheets).cache()
    checks = [
        (ranges(S.table_boundaries(rows, KEYS, block_rows=block_rows)), boundaries),
        (ranges(S.table_boundaries(rows, KEYS, True, block_rows)), boundaries_legacy),
        (ranges(S.null_pattern_segments(rows, KEYS, block_rows)), patterns),
        (tables(S.split_markers(rows, KEYS, block_rows)), marker_tables),
        (tables(S.split_first_col(rows, KEYS, block_rows)), first_column_tables),
    ]
    for got, rule in checks:
        want = {s: rule(r) for s, r in sheets.items()}
        assert got == {s: w for s, w in want.items() if w}, rule.__name__


def advanced(rows):
    """The tables by the first rule that works, row by row."""
    marked = first_column_tables(rows)
    if marked:
        return marked
    found = boundaries(rows)
    if len(found) < 2:
        found = patterns(rows)
    if not found:
        columns = list(zip_longest(*rows))
        text = [any(is_text(c) for c in column) for column in columns]
        if not any(text) or all(text):
            return {}
        half = len(rows) // 2
        found = [(0, half - 1), (half, len(rows) - 1)]
    return {i: name for (a, b), name in zip(sorted(found), ("LANDED", "PULLOUT")) for i in range(a, b + 1)}


def is_text(cell):
    try:
        return cell is not None and float(cell) is None
    except ValueError:
        return True


@pytest.mark.parametrize("block_rows", BLOCKS)
@pytest.mark.parametrize("seed", [11, 12])
def test_advanced_rules_against_a_loop(spark, block_rows, seed):
    marked = random_sheets(seed=seed)
    words = ["1", "2", None, "x"]
    sheets = marked | {f"n{s}": r for s, r in random_sheets(seed + 100, 80, 6, 2, words).items()}
    sheets |= {f"h{i}": [["a", str(i)]] * (2 + i) + [["b", "7"]] for i in range(4)}
    rows = grid(spark, sheets)
    got = tables(fallback.advanced_split(rows, KEYS, block_rows))
    want = {s: advanced(r) for s, r in sheets.items()}
    assert got == {s: w for s, w in want.items() if w}


def test_advanced_rules_read_the_grid_twice(spark, monkeypatch):
    read = []

    def watched(df, name):
        read.append(df._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD"))
        return stage(df, name)

    rows = grid(spark, random_sheets(seed=3))
    monkeypatch.setattr(fallback, "stage", watched)
    last = fallback.advanced_split(rows, KEYS)._jdf.queryExecution().executedPlan().toString()
    # The second read of the evidence is for sheets of several blocks: a filter of one column.
    assert sum(read) <= 3 and last.count("Scan ExistingRDD") == 1
    assert read[1:] == [0] * (len(read) - 1)


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_running_and_neighbour_columns(spark, block_rows):
    sheets = random_sheets(seed=7, n=60, words=[None, None, "a", "b", "c"])
    rows = grid(spark, sheets).withColumn("c", F.get("cells", F.lit(0)))
    running = with_running(
        rows,
        last={"last": F.col("c")},
        total={"n": F.col("c").isNotNull().cast("bigint")},
        keys=KEYS,
        block_rows=block_rows,
    )
    both = with_neighbours(
        running, {"before": "c"}, {"after": "c"}, KEYS, block_rows
    )
    got = {(r["sheet"], r["row_idx"]): (r["last"], r["n"], r["before"], r["after"]) for r in both.collect()}
    want = {}
    for s, table in sheets.items():
        column = [row[0] for row in table]
        for i in range(len(column)):
            seen = [c for c in column[: i + 1] if c is not None]
            want[s, i] = (
                seen[-1] if seen else None,
                len(seen),
                column[i - 1] if i else None,
                column[i + 1] if i + 1 < len(column) else None,
            )
    assert got == want


def test_facts_reach_every_row_once(spark):
    rows = grid(spark, {"big": [["x"]] * 20, "small": [["y"]]}, first=-1)
    facts = H.last_rows(rows, KEYS).withColumn("tag", F.upper("sheet"))
    got = attach_facts(rows, facts, KEYS, block_rows=4)
    assert got.count() == 21
    assert {(r["sheet"], r["tag"]) for r in got.collect()} == {("big", "BIG"), ("small", "SMALL")}


# --- filling and cleaning ----------------------------------------------------


def test_ffill_empties_summary_rows(spark):
    rows = spark.createDataFrame(
        [("s", 0, "Soya", "S1"), ("s", 1, None, "S2"), ("s", 2, None, None), ("s", 3, None, ""),
         ("s", 4, "Corn", "S1"), ("s", 5, None, "S9")],
        "sheet string, row_idx bigint, product string, supplier string",
    )

    def products(df):
        return [r["product"] for r in df.orderBy("row_idx").collect()]

    filled = fill.ffill_summary(rows, "product", "supplier", KEYS, block_rows=2)
    assert products(filled) == ["Soya", "Soya", "", "", "Corn", "Corn"]
    null_only = fill.ffill_summary(rows, "product", "supplier", KEYS, null_only=True)
    assert products(null_only) == ["Soya", "Soya", "", "Soya", "Corn", "Corn"]
    assert products(fill.ffill_summary(rows, "product", None, KEYS))[2] == "Soya"
    once = fill.ffill(rows, ["product", "supplier"], KEYS)
    assert sorted(fill.ffill(once, ["product", "supplier"], KEYS).collect()) == sorted(once.collect())


def test_whole_number_format_keeps_decimals(spark):
    df = spark.createDataFrame(
        [(1.0, 1.05, None), (2.0, 10.0, None), (None, 100.5, None)], "a double, b double, c double"
    )
    out = C.whole_number_format(df)
    assert dict(out.dtypes) == {"a": "bigint", "b": "string", "c": "bigint"}
    assert [(r["a"], r["b"]) for r in out.collect()] == [(1, "1.05"), (2, "10"), (None, "100.5")]


def test_blank_rows_columns_and_nulls(spark):
    df = spark.createDataFrame([("a", None, None, 1), (None, None, None, None)], "x string, y string, `z.z` int, n int")
    assert C.drop_blank_columns(df).columns == ["x", "n"]
    assert [tuple(r) for r in fill.fill_nulls(df, numbers=True).collect()] == [("a", "", 0, 1), ("", "", 0, 0)]
    assert fill.fill_nulls(df).collect()[1]["n"] is None
    rows = grid(spark, {"s": [["a", None], [None, None], [" ", None]]})
    assert C.drop_blank_rows(rows).count() == 2
    assert C.drop_blank_rows(rows, whitespace_too=True).count() == 1
    stock = spark.createDataFrame([(1, 2, 3)], "`ITEM DESCRIPTION` int, `QTY OPEN` int, BRAND int")
    assert C.inventory_columns(stock).columns == ["ITEM DESCRIPTION", "QTY OPEN"]
