"""Whole runs over date folders: layouts, usage modes, sinks and the file stream."""

import datetime as dt
import json

import pytest
import xlsx
from pyspark.sql import functions as F

from supplyview import Options, finished_tables, report, run, tables, whole_tables
from supplyview import sinks as K
from supplyview.operators import headers as H
from supplyview.operators import pivot as V
from supplyview.operators import quality as Q
from supplyview.session import run_folder, shared_folder
from supplyview.sources.workbook import scan_workbooks, sheet_listing, sheet_rows, unreadable
from supplyview.streaming import report_new_dates

QTY = "QTY (MT) /BL"
LOCAL_QTY = "STILL TO BE DELIVERED (in kilos)"

INVENTORY = [
    ["STOCK", None, None], ["as of today", None, None], ["ITEM DESCRIPTION", "QTY IN KGS", "BIN"],
    ["Soya", 5000.0, "a"], [None, None, None], ["Corn", "1,000", "b"], ["  ", 7.0, "c"], ["Rye", 2000.0, "d"],
]


def write_dimension(root):
    path = root / "product_categories.csv"
    path.write_text("Product,Category\nSoya,meal\nCorn,grain\nOats,\nSalt,N/A\n")
    return str(path)


def write_usage(folder):
    (folder / "global_usage.csv").write_text(
        "Ingredient  Name,Ingredient Amount,Ingredient Stock\nSoya,\"2,000\",1\nsoya flour,600,1\nZinc,100,0\n"
    )


@pytest.fixture(scope="module")
def combined(tmp_path_factory):
    root = tmp_path_factory.mktemp("combined")
    for day, extra in (("20250811", 1.0), ("20250812", 2.0)):
        xlsx.write(
            root / "input" / day / "deliveries.xlsx",
            {
                "SUMMARY": [["ignored"], ["PRODUCT", QTY], ["Soya", 999.0]],
                "SAILING": [["REPORT", None], ["title", None], ["PRODUCT", QTY], ["Soya", 10.0 * extra], [" Oats ", 4.0], ["Salt", 3.0]],
                "LANDED.PULL OUT": [
                    ["x", None, None], ["LANDED TABLE", None, None], ["PRODUCT", QTY, "NOTE"], ["Corn", 1.0, "n"],
                    [None, None, None], ["Soya", "bad", "n"], ["PULL-OUT TABLE", None, None], ["PRODUCT", QTY, "NOTE"], ["Rye", 6.0, "n"],
                ],
                "UNSERVED LOCAL": [
                    ["RAW MATERIALS", "SUPPLIER", LOCAL_QTY], ["Soya", "S1", 3000.0], [None, "S2", 1000.0], [None, None, 4000.0],
                    ["Corn", "S1", None], [None, None, 9000.0],
                ],
                "UNSERVED IMPORTED": [["y", None], ["PRODUCT", "AMOUNT"], ["Soya", 1.0]],
                "CHARTS": [["z", None], ["ONE", "TWO"], ["a", "b"]],
            },
            {"UNSERVED LOCAL": ["A2:A3", "A5:A6"]},
        )
        xlsx.write(root / "input" / day / "inventory.xlsx", {"Sheet1": INVENTORY})
        write_usage(root / "input" / day)
    return root


@pytest.fixture(scope="module")
def combined_results(spark, combined):
    return run(spark, str(combined / "input"), write_dimension(combined))


def fact_rows(results, day="2025-08-11"):
    rows = results.fact.filter(F.col("ingest_date") == day).collect()
    return sorted((r["status"], r["product"], r["quantity"], r["category"]) for r in rows if r["quantity"] is not None)


def test_combined_fact(combined_results):
    assert fact_rows(combined_results) == [
        ("GLOBAL USAGE", "Soya", 2.0, "meal"),
        ("GLOBAL USAGE", "Zinc", 0.1, "Zinc"),
        ("GLOBAL USAGE", "soya flour", 0.6, "soya flour"),
        ("INVENTORY", "Rye", 2.0, ""),
        ("INVENTORY", "Soya", 5.0, "meal"),
        ("LANDED", "Corn", 1.0, "grain"),
        ("PULLOUT", "Rye", 6.0, ""),
        ("SAILING", " Oats ", 4.0, ""),
        ("SAILING", "Salt", 3.0, "N/A"),
        ("SAILING", "Soya", 10.0, "meal"),
        ("UNSERVED LOCAL", "Soya", 1.0, "meal"),
        ("UNSERVED LOCAL", "Soya", 3.0, "meal"),
    ]
    # Unparsable quantities keep their row; summary rows (no supplier) are gone.
    bad = combined_results.fact.filter("quantity is null").collect()
    assert {(r["status"], r["product"]) for r in bad} == {
        ("LANDED", "Soya"), ("INVENTORY", "Corn"), ("UNSERVED LOCAL", "Corn"),
    }


def test_combined_rejects(combined_results):
    rejected = {(r["sheet"], r["reason"]) for r in combined_results.rejects.collect()}
    assert rejected == {
        ("UNSERVED IMPORTED", "missing columns: TOTAL"),
        ("CHARTS", "no column mapping"),
    }


def test_combined_reports(combined_results):
    pivot = {(r["ingest_date"].day, r["category"]): r for r in combined_results.pivot.collect()}
    assert pivot[11, "meal"]["TOTAL"] == 19.0 and pivot[12, "meal"]["TOTAL"] == 29.0
    assert pivot[11, "TOTAL"]["TOTAL"] == 19.0 + 1.0 + 12.0
    assert pivot[11, "meal"]["GLOBAL USAGE"] == 2.0
    assert not any(category == "N/A" for _, category in pivot)
    enhanced = {(r["ingest_date"].day, r["category"]): r for r in combined_results.enhanced_pivot.collect()}
    assert enhanced[11, "meal"]["3 Month Projection"] == 13.0
    assert enhanced[11, "Zinc"]["1 Month Projection"] == pytest.approx(-0.1)
    assert sorted(r["product"] for r in combined_results.new_products.collect()) == ["Rye", "Zinc", "soya flour"]
    assert [r["product"] for r in combined_results.blank_category_products.collect()] == ["Oats"]
    assert combined_results.dimension.count() == 7
    assert combined_results.status_counts.first()["n_rows"] == 6


def test_dates_limit_the_run(spark, combined):
    results = run(spark, str(combined / "input"), write_dimension(combined), dates=["20250812"], usage_file=None)
    assert {r["ingest_date"] for r in results.fact.collect()} == {dt.date(2025, 8, 12)}
    assert results.fact.filter("status = 'GLOBAL USAGE'").count() == 0
    assert results.enhanced_pivot.filter("category = 'meal'").first()["1 Month Projection"] == 29.0


def test_annual_fuzzy_usage(spark, combined):
    results = run(
        spark, str(combined / "input"), write_dimension(combined), dates=["20250811"],
        options=Options(usage_mode="annual_fuzzy"),
    )
    rows = {r["category"]: r for r in results.enhanced_pivot.collect()}
    # Soya's first ingredient in the file is Soya itself: 2000 a year.
    assert rows["meal"][V.MONTHLY_USAGE] == pytest.approx(2000 / 12)
    assert rows["Zinc"][V.MONTHLY_USAGE] == pytest.approx(100 / 12)
    categories = {r["product"]: r["category"] for r in results.dimension.collect()}
    assert categories["Zinc"] == "N/A" and "soya flour" in categories


def test_legacy_units(spark, combined):
    rows = sheet_rows(scan_workbooks(spark, str(combined / "input" / "20250811")))
    from supplyview.operators.facts import quantity_fact

    fact = quantity_fact(tables(rows).projected, legacy_units=True)
    assert fact.filter("status = 'UNSERVED LOCAL'").agg(F.sum("quantity")).first()[0] == 4_000_000.0


def test_whole_tables_keep_every_column(spark, combined):
    rows = sheet_rows(scan_workbooks(spark, str(combined / "input" / "20250811")))
    profile = {(r["table"], r["column"]): r for r in Q.grid_profile(whole_tables(rows)).collect()}
    assert profile["INVENTORY", "BIN"]["n_columns"] == 3
    assert profile["SAILING", QTY]["dtype"] == "double" and profile["SAILING", "PRODUCT"]["dtype"] == "string"
    assert profile["UNSERVED LOCAL", "SUPPLIER"]["null_count"] == 2


def test_finished_tables_are_saved_with_their_own_columns(spark, combined, tmp_path):
    rows = sheet_rows(scan_workbooks(spark, str(combined / "input" / "20250811")))
    finished = finished_tables(rows).cache()
    K.write_tables_csv(finished, str(tmp_path / "csv"))

    def saved(table, sheet):
        path = tmp_path / "csv" / f"table={table}" / "ingest_date=2025-08-11"
        (file,) = path.glob(f"workbook=*/sheet={sheet}/part-*")
        return file.read_text().splitlines()

    assert {p.name for p in (tmp_path / "csv").glob("table=*")} == {
        f"table={t}" for t in ("CHARTS", "INVENTORY", "LANDED", "PULLOUT", "SAILING", "SUMMARY", "UNSERVED IMPORTED", "UNSERVED LOCAL")
    }
    assert saved("LANDED", "LANDED.PULL OUT") == [f"PRODUCT,{QTY},NOTE", "Corn,1,n", "Soya,bad,n"]
    # Merged products are filled and summary rows lose theirs; row 5 is merged into Corn's range.
    assert saved("UNSERVED LOCAL", "UNSERVED LOCAL") == [
        f"RAW MATERIALS,SUPPLIER,{LOCAL_QTY}", "Soya,S1,3000", "Soya,S2,1000", ",,4000", "Corn,S1,", ",,9000",
    ]
    # Descriptions and quantities alone, no blank rows; nulls are blanks.
    assert saved("INVENTORY", "Sheet1") == [
        "ITEM DESCRIPTION,QTY IN KGS", "Soya,5000", 'Corn,"1,000"', "  ,7", "Rye,2000",
    ]
    profile = {(r["table"], r["column"]) for r in Q.grid_profile(finished).collect()}
    assert ("INVENTORY", "BIN") not in profile and ("LANDED", "NOTE") in profile


def test_finished_split_tables_have_the_usual_names(spark, split):
    rows = sheet_rows(scan_workbooks(spark, str(split / "input")))
    found = finished_tables(rows, Options(layout="split")).filter("table = 'UNSERVED LOCAL' and sheet = 'UNSERVED LOCAL'")
    local = found.orderBy("row_idx").collect()
    assert local[0]["header"] == ["RAW MATERIALS", "SUPPLIER", LOCAL_QTY]
    assert [r["cells"][0] for r in local] == ["Soya", "Soya", "", "Corn"]


@pytest.mark.parametrize("layout", ["split", "sheets"])
def test_whole_tables_of_the_other_layouts(spark, split, combined, layout):
    folder = (split if layout == "split" else combined) / "input" / "20250811"
    rows = sheet_rows(scan_workbooks(spark, str(folder)))
    got = {r["table"] for r in whole_tables(rows, Options(layout=layout)).select("table").distinct().collect()}
    if layout == "split":
        assert got == {"SAILING", "LANDED", "PULLOUT", "UNSERVED IMPORTED", "UNSERVED LOCAL", "INVENTORY"}
    else:
        assert {"SUMMARY", "SAILING", "LANDED", "OTHER"} <= got


def test_layout_is_checked(spark, combined):
    rows = sheet_rows(scan_workbooks(spark, str(combined / "input" / "20250811")))
    with pytest.raises(ValueError):
        tables(rows, Options(layout="other"))


# --- split layout ------------------------------------------------------------


@pytest.fixture(scope="module")
def split(tmp_path_factory):
    root = tmp_path_factory.mktemp("split")
    day = root / "input" / "20250811"
    xlsx.write(
        day / "imports.xlsx",
        {
            "Sailling": [["t", None, None], ["Contract No", "PRODUCT", QTY], ["c1", "Soya", 10.0]],
            "Landed": [["t", None, None], ["u", None, None], ["Bill of Lading", "PRODUCT", QTY], ["b1", "Corn", 2.0]],
            "For Pull out Return": [["t", None, None], ["BILL OF LADING", "PRODUCT", QTY], ["b2", "Rye", 3.0]],
            "UNSERVED": [["PRODUCT", "TOTAL"], ["Soya", 4.0]],
            "Notes": [["a"], ["b"]],
        },
    )
    xlsx.write(
        day / "local.xlsx",
        {
            "UNSERVED LOCAL": [
                ["t", None, None], ["Raw Material", "SUPPLIER", "Still to deliver (KG)"],
                ["Soya", "S1", 1000.0], [None, "S2", 2000.0], [None, None, 3000.0], ["Corn", "S1", 500.0],
            ],
            "Broken": [["t", None], ["RAW MATERIALS", "SUPPLIER"], ["Soya", "S1"]],
        },
    )
    xlsx.write(day / "inventory.xlsx", {"Sheet1": INVENTORY, "More": INVENTORY, "Empty": [["a"], ["b"]]})
    return root


@pytest.fixture(scope="module")
def split_results(spark, split):
    return run(spark, str(split / "input"), write_dimension(split), usage_file=None, options=Options(layout="split"))


def test_split_fact(split_results):
    assert [r for r in fact_rows(split_results) if r[0] != "INVENTORY"] == [
        ("LANDED", "Corn", 2.0, "grain"),
        ("PULLOUT", "Rye", 3.0, ""),
        ("SAILING", "Soya", 10.0, "meal"),
        ("UNSERVED IMPORTED", "Soya", 4.0, "meal"),
        ("UNSERVED LOCAL", "Corn", 0.5, "grain"),
        ("UNSERVED LOCAL", "Soya", 1.0, "meal"),
        ("UNSERVED LOCAL", "Soya", 2.0, "meal"),
    ]
    # The first inventory sheet counts.
    assert sum(r[2] for r in fact_rows(split_results) if r[0] == "INVENTORY" and r[1] == "Soya") == 5.0


def test_all_inventory_sheets_on_request(spark, split):
    rows = sheet_rows(scan_workbooks(spark, str(split / "input")))
    found = tables(rows, Options(layout="split", all_inventory_sheets=True))
    stock = found.projected.filter("table = 'INVENTORY' and product = 'Soya'").collect()
    assert sorted(r["sheet"] for r in stock) == ["More", "Sheet1"]
    assert ("Empty", "missing columns: ITEM DESCRIPTION, QTY IN KGS") in {
        (r["sheet"], r["reason"]) for r in found.rejects.collect()
    }


def test_split_rejects_and_new_aliases(split_results):
    assert {(r["sheet"], r["reason"]) for r in split_results.rejects.collect()} == {
        ("Broken", f"missing columns: {LOCAL_QTY}"),
    }
    assert {(r["expected"], r["alias"]) for r in split_results.aliases.collect()} == {
        ("RAW MATERIALS", "Raw Material"), (LOCAL_QTY, "Still to deliver (KG)"),
    }


def test_stored_aliases_are_applied(spark, split):
    rows = sheet_rows(scan_workbooks(spark, str(split / "input")))
    found = tables(rows, Options(layout="split", aliases={"RAW MATERIALS": ["raw material"], LOCAL_QTY: ["SUPPLIER"]}))
    assert found.aliases.count() == 0


# --- sheet-only layouts ------------------------------------------------------


@pytest.mark.parametrize("layout, pulled", [("sheets", {"Rye"}), ("sheets_advanced", {"Rye"})])
def test_sheet_layouts(spark, tmp_path, layout, pulled):
    xlsx.write(
        tmp_path / "20250811" / "book.xlsx",
        {
            "SUMMARY": [["a", "b"], ["PRODUCT", QTY], ["Soya", 1.0]],
            "SAILING": [["a", "b"], ["PRODUCT", QTY], ["Soya", 10.0]],
            "LANDED.PULL-OUT": [
                ["a", "b"], ["PRODUCT", QTY], ["Corn", 2.0], [None, None], ["PRODUCT", QTY], ["Rye", 3.0],
            ],
            "UNSERVED LOCAL": [["a", "b"], ["RAW MATERIALS", LOCAL_QTY], ["Soya", 5.0], [None, 6.0]],
            "EXTRA": [["a", "b"], ["PRODUCT", QTY], ["Soya", 1.0]],
        },
    )
    rows = sheet_rows(scan_workbooks(spark, str(tmp_path)))
    projected = tables(rows, Options(layout=layout)).projected
    got = {(r["table"], r["product"]) for r in projected.collect()}
    # The older rules fill a missing product from above, never a quantity.
    assert projected.filter("table = 'UNSERVED LOCAL' and product = 'Soya'").count() == 2
    assert got == {("SAILING", "Soya"), ("LANDED", "Corn"), ("PULLOUT", "Rye"), ("UNSERVED LOCAL", "Soya")}
    assert {p for t, p in got if t == "PULLOUT"} == pulled


# --- sinks -------------------------------------------------------------------


def test_fact_and_csv_sinks(spark, combined_results, tmp_path):
    out = str(tmp_path / "fact")
    K.write_fact(combined_results.fact, out)
    K.write_fact(combined_results.fact.filter("ingest_date = '2025-08-12'"), out)
    back = spark.read.parquet(out)
    assert back.count() == combined_results.fact.count()
    assert back.filter("status = 'SAILING' and ingest_date = '2025-08-11'").count() == 3
    K.write_combined_csv(combined_results.fact, str(tmp_path / "csv"))
    csv = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert set(csv.columns) == {"PRODUCT", "QUANTITY", "STATUS", "CATEGORY", "ingest_date"}


def test_pivot_sink_replaces_only_its_dates(spark, combined_results, tmp_path):
    pivot, out = combined_results.pivot, str(tmp_path / "pivot")
    K.write_pivot_csv(pivot, out)
    K.write_pivot_csv(pivot.filter("ingest_date = '2025-08-12'"), out)
    for day in (11, 12):
        files = sorted((tmp_path / "pivot" / f"ingest_date=2025-08-{day}").glob("*.csv"))
        lines = [line for f in files for line in f.read_text().splitlines()]
        rows = [line for line in lines if not line.startswith("CATEGORY,INVENTORY")]
        assert len(rows) == pivot.filter(F.col("ingest_date") == f"2025-08-{day}").count()
        assert rows[-1].startswith("TOTAL,")


def test_dimension_versions_and_aliases(spark, combined_results, split_results, tmp_path):
    path = K.write_dimension(combined_results.dimension, str(tmp_path / "dim"), "2")
    (file,) = list((tmp_path / "dim" / "version=2").glob("*.csv"))
    assert file.read_text().splitlines() == [
        "Product,Category", "Corn,grain", "Soya,meal", "Oats,", "Rye,", "Salt,N/A", "Zinc,", "soya flour,",
    ]
    from supplyview.sources.files import read_dimension

    again = read_dimension(spark, path)
    assert again.count() == 7
    K.write_aliases(split_results.aliases, str(tmp_path / "aliases"))
    (stored,) = list((tmp_path / "aliases").glob("*.json"))
    first = json.loads(stored.read_text().splitlines()[0])
    assert first == {"table": "UNSERVED_LOCAL", "expected": "RAW MATERIALS", "aliases": ["Raw Material"]}


def test_table_csv_has_a_column_per_header(spark, combined, tmp_path):
    rows = sheet_rows(scan_workbooks(spark, str(combined / "input"))).filter("sheet = 'Sheet1'")
    promoted = H.promote_header(rows, H.header_required(rows)).withColumn("table", F.lit("INVENTORY"))
    K.write_tables_csv(promoted, str(tmp_path / "inventory"))
    back = spark.read.option("header", True).csv(str(tmp_path / "inventory"))
    assert {"BIN", "ITEM DESCRIPTION", "QTY IN KGS", "ingest_date"} <= set(back.columns)
    assert back.count() == 10


def test_a_large_table_is_written_by_several_tasks_in_order(spark, tmp_path):
    n = 5000
    table = spark.range(n).select(
        F.lit("LANDED").alias("table"), F.lit("s").alias("sheet"), F.col("id").alias("row_idx"),
        F.array(F.lit("PRODUCT"), F.lit("a,b")).alias("header"),
        F.array(F.col("id").cast("string"), F.lit("x")).alias("cells"),
    )
    small = table.filter("row_idx < 3").withColumn("table", F.lit("SAILING"))
    out = tmp_path / "csv"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        K.write_tables_csv(table.unionByName(small).repartition(5), str(out), ["sheet"], part_rows=500)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = sorted((out / "table=LANDED" / "sheet=s").glob("part-*"))
    assert len(files) > 3
    lines = []
    for file in files:
        head, *rest = file.read_text().splitlines()
        assert head == 'PRODUCT,"a,b"' and rest
        lines += rest
    assert lines == [f"{i},x" for i in range(n)]
    (whole,) = (out / "table=SAILING" / "sheet=s").glob("part-*")
    assert whole.read_text().splitlines() == ['PRODUCT,"a,b"', "0,x", "1,x", "2,x"]
    listed = K.table_files(spark, str(out)).filter("table = 'LANDED'").orderBy("part").collect()
    assert [r["file"] for r in listed] == [f.name for f in files] and listed[0]["n_parts"] == len(files)
    # Readers of the folder do not see the manifest.
    assert spark.read.text(str(out)).count() == n + 3 + len(files) + 1


def test_csv_lines_are_quoted(spark):
    df = spark.createDataFrame([(["a,b", None, 'say "x"', "two\nlines", ""],)], "v array<string>")
    assert df.select(K.tables.csv_line(F.col("v"))).first()[0] == '"a,b",,"say ""x""","two\nlines",'


# --- nothing is lost ---------------------------------------------------------


def test_a_half_read_sheet_is_rejected_whole(spark, tmp_path):
    import zipfile

    path = tmp_path / "20250811" / "deliveries.xlsx"
    good = [["t", None], ["PRODUCT", QTY], ["Soya", 1.0], ["Corn", 2.0], ["Rye", 3.0]]
    xlsx.write(path, {"SAILING": good, "LANDED": good, "EMPTY": []})
    with zipfile.ZipFile(path) as book:
        parts = {n: book.read(n) for n in book.namelist()}
    parts["xl/worksheets/sheet1.xml"] = parts["xl/worksheets/sheet1.xml"].replace(b'<row r="5">', b'<row r="5"><broken')
    with zipfile.ZipFile(path, "w") as book:
        for n, data in parts.items():
            book.writestr(n, data)
    scanned = scan_workbooks(spark, str(tmp_path)).cache()
    assert scanned.filter("sheet = 'SAILING' and row_idx is not null").count() > 0
    rows = sheet_rows(scanned)
    assert {r["table"] for r in tables(rows).projected.collect()} == {"LANDED"}
    assert [r["sheet"] for r in unreadable(scanned).collect()] == ["SAILING"]
    assert {r["sheet"] for r in sheet_listing(scanned).collect()} == {"SAILING", "LANDED", "EMPTY"}


def test_stacked_sheets_without_a_split_are_rejected(spark, tmp_path):
    xlsx.write(
        tmp_path / "20250811" / "deliveries.xlsx",
        {"LANDED.PULL OUT": [["t", None], ["PRODUCT", QTY], ["Soya", 1.0], ["PRODUCT", QTY], ["Corn", 2.0]]},
    )
    found = tables(sheet_rows(scan_workbooks(spark, str(tmp_path))))
    assert found.projected.count() == 0
    assert [(r["table"], r["reason"]) for r in found.rejects.collect()] == [("STACKED", "no rule splits the sheet")]


def test_third_tables_are_rejected(spark, tmp_path):
    table = [["PRODUCT", QTY], ["Soya", 1.0], [None, None]]
    xlsx.write(tmp_path / "20250811" / "book.xlsx", {"LANDED.PULL OUT": [["label", "x"], *table, *table, *table]})
    found = tables(sheet_rows(scan_workbooks(spark, str(tmp_path))), Options(layout="sheets_advanced"))
    assert sorted(r["table"] for r in found.projected.collect()) == ["LANDED", "PULLOUT"]
    assert [r["reason"] for r in found.rejects.collect()] == ["table beyond the second: rows 6 to 7"]


def test_audit_adds_up(spark):
    from pathlib import Path

    from supplyview.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("driver tables not present")
    rows = QUERIES["sheet_audit"](spark, sf).collect()
    for r in rows:
        assert r["n_read"] == r["n_table"] + r["n_header"] + r["n_blank"] + r["n_rejected"] + r["n_aside"]
    assert any(r["n_rejected"] for r in rows) and any(r["n_table"] for r in rows)


def test_optional_inputs_may_be_absent(spark, tmp_path):
    xlsx.write(tmp_path / "20250811" / "deliveries.xlsx", {"SAILING": [["t", None], ["PRODUCT", QTY], ["Soya", 1.0]]})
    (tmp_path / "empty.csv").write_text("")
    for dim in (None, str(tmp_path / "none.csv"), str(tmp_path / "empty.csv")):
        results = run(
            spark, str(tmp_path), dim, mapping_path=str(tmp_path / "m.json"), alias_path=str(tmp_path / "a.json")
        )
        assert [(r["product"], r["status"]) for r in results.fact.collect()] == [("Soya", "SAILING")]
        assert results.pivot.count() == 2 and results.dimension.count() == 1


def test_one_call_writes_everything_and_leaves_nothing_behind(spark, combined, tmp_path):
    from pathlib import Path

    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    out = tmp_path / "out"
    report(spark, str(combined / "input"), write_dimension(combined), str(out), "1", dates=["20250811"])
    assert set(shared.iterdir()) == before
    assert {p.name for p in out.iterdir()} == {
        "fact", "combined", "pivot", "enhanced_pivot", "tables", "dimension", "reports", "aliases",
    }
    assert spark.read.parquet(str(out / "fact")).count() == 15
    with pytest.raises(ZeroDivisionError):
        with run_folder(spark):
            run(spark, str(combined / "input"), None, dates=["20250811"])
            1 / 0
    assert set(shared.iterdir()) == before


def test_stored_aliases_come_back(spark, split, tmp_path):
    results = run(spark, str(split / "input"), None, usage_file=None, options=Options(layout="split"))
    K.write_aliases(results.aliases, str(tmp_path / "aliases"))
    again = run(
        spark, str(split / "input"), None, usage_file=None, options=Options(layout="split"),
        alias_path=str(tmp_path / "aliases"),
    )
    stored = {(r["expected"], r["alias"]) for r in results.aliases.collect()}
    assert stored and {(r["expected"], r["alias"]) for r in again.aliases.collect()} == stored


# --- stream ------------------------------------------------------------------


def test_new_folders_are_reported_once(spark, combined, tmp_path):
    root = tmp_path / "input"
    dim = write_dimension(tmp_path)

    def arrive(day, *names):
        (root / day).mkdir(parents=True, exist_ok=True)
        for name in names:
            (root / day / name).write_bytes((combined / "input" / day / name).read_bytes())

    def go():
        query = report_new_dates(spark, str(root), dim, str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination(300)
        assert query.exception() is None
        return {r["ingest_date"].day: r["n"] for r in spark.read.parquet(str(tmp_path / "out" / "fact")).groupBy("ingest_date").agg(F.count("*").alias("n")).collect()}

    arrive("20250811", "deliveries.xlsx", "inventory.xlsx")
    arrive("20250812", "deliveries.xlsx")
    first = go()
    assert set(first) == {11}
    assert {p.name for p in (tmp_path / "out").iterdir()} >= {"fact", "pivot", "tables", "dimension", "reports"}
    arrive("20250812", "inventory.xlsx")
    second = go()
    assert set(second) == {11, 12} and second[11] == first[11]


def test_files_of_a_date_over_three_batches_give_one_report(spark, combined, tmp_path, monkeypatch):
    from supplyview.streaming import arrivals

    root, reported = tmp_path / "input", []
    monkeypatch.setattr(arrivals, "report", lambda *a, dates, **k: reported.append(dates))

    def arrive(day, name):
        (root / day).mkdir(parents=True, exist_ok=True)
        (root / day / name).write_bytes(b"x")

    def go(wait_ms=arrivals.DAY_MS):
        query = report_new_dates(
            spark, str(root), "", str(tmp_path / "out"), str(tmp_path / "cp"), wait_ms=wait_ms,
            required=("deliveries.xlsx", "inventory.xlsx", "global_usage.csv"),
        )
        query.awaitTermination(300)
        assert query.exception() is None
        done, reported[:] = list(reported), []
        return done

    arrive("20250811", "deliveries.xlsx")
    arrive("20250813", "deliveries.xlsx")
    arrive("notes", "inventory.xlsx")
    assert go(wait_ms=1) == []
    arrive("20250811", "inventory.xlsx")
    arrive("20250811", "notes.txt")
    assert go() == []
    arrive("20250811", "global_usage.csv")
    assert go() == [["20250811"]]
    # A restart from the checkpoint repeats nothing; a further file of the date is a new report.
    assert go() == []
    arrive("20250811", "more.xlsx")
    arrive("20250812", "inventory.xlsx")
    assert go() == [["20250811"]]
    # Both dates had waited too long when the second batch ran.
    late = spark.read.option("header", True).csv(str(tmp_path / "out" / "late")).collect()
    assert ("20250813", "inventory.xlsx, global_usage.csv") in {(r["date"], r["missing"]) for r in late}


# --- merged cells and raw names ----------------------------------------------


def merged_rows(spark, tmp_path, name, sheet, header, top=0):
    rows = [["t", None, None]] * top + [header, ["Soya", "S1", 1.0], [None, "S2", 2.0], [None, None, 3.0]]
    first = top + 2
    xlsx.write(tmp_path / "20250811" / name, {sheet: rows}, {sheet: [f"A{first}:A{first + 2}"]})
    return sheet_rows(scan_workbooks(spark, str(tmp_path)))


def products(found):
    return [r["product"] for r in found.projected.orderBy("row_idx").collect()]


def test_merged_products_of_unserved_local(spark, tmp_path):
    header = ["RAW MATERIALS", "SUPPLIER", LOCAL_QTY]
    assert products(tables(merged_rows(spark, tmp_path / "a", "d.xlsx", "UNSERVED LOCAL", header))) == ["Soya", "Soya", ""]
    # Wherever the header is found.
    low = merged_rows(spark, tmp_path / "b", "d.xlsx", "UNSERVED LOCAL", header, top=9)
    assert products(tables(low)) == ["Soya", "Soya", ""]
    # Other tables keep their gaps.
    other = merged_rows(spark, tmp_path / "c", "d.xlsx", "SAILING", ["PRODUCT", "SUPPLIER", QTY])
    assert products(tables(other)) == ["Soya", None, None]


def test_merged_products_of_the_inventory_on_request(spark, tmp_path):
    rows = merged_rows(spark, tmp_path, "inventory.xlsx", "S", ["ITEM DESCRIPTION", "x", "QTY IN KGS"], top=1)
    assert products(tables(rows)) == ["Soya", None, None]
    assert products(tables(rows, Options(fill_inventory=True))) == ["Soya", "Soya", "Soya"]


def test_landed_names_are_taken_as_they_are(spark, tmp_path):
    xlsx.write(
        tmp_path / "20250811" / "imports.xlsx",
        {
            "Landed": [["t", None, None], ["u", None, None], ["Bill of Lading", " PRODUCT ", QTY], ["b", "Corn", 2.0]],
            "Sailling": [["t", None, None], ["u", None, None], ["Contract", " PRODUCT ", QTY], ["b", "Corn", 2.0]],
        },
    )
    found = tables(sheet_rows(scan_workbooks(spark, str(tmp_path))), Options(layout="split"))
    assert [(r["table"], r["product"]) for r in found.projected.collect()] == [("SAILING", "Corn")]
    assert [r["reason"] for r in found.rejects.collect()] == ["missing columns: PRODUCT"]
