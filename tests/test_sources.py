"""Workbook scan, CSV and JSON readers, date folders."""

import datetime as dt
import json
import zipfile

import numpy as np
import xlsx
from pyspark.sql import functions as F

from supplyview.operators.fill import merged_fill, merged_ranges, with_span
from supplyview.sources import files, folders
from supplyview.sources import workbook as B


def scanned(spark, path):
    return B.scan_workbooks(spark, str(path))


def cells(rows, sheet):
    found = rows.filter(F.col("sheet") == sheet).orderBy("row_idx").collect()
    return {r["row_idx"]: r["cells"] for r in found}


def test_scan_reads_values_gaps_and_sheets(spark, tmp_path):
    xlsx.write(
        tmp_path / "20250811" / "deliveries.xlsx",
        {
            "A": [["label", None], ["Soya & co", 12.0], [None, None], [1.5, True], ["N/A", "inline:x"]],
            "B": [[None, xlsx.Date(45880)], [1e6, "  padded "]],
        },
    )
    rows = B.sheet_rows(scanned(spark, tmp_path))
    assert cells(rows, "A") == {
        -1: ["label"], 0: ["Soya & co", "12"], 1: [], 2: ["1.5", "True"], 3: [None, "x"],
    }
    assert cells(rows, "B") == {-1: [None, "2025-08-11 00:00:00"], 0: ["1000000", "  padded "]}
    one = rows.first()
    assert one["ingest_date"] == dt.date(2025, 8, 11) and one["workbook"] == "deliveries.xlsx"
    assert {r["sheet"] for r in B.sheet_listing(rows).collect()} == {"A", "B"}


def test_merged_ranges_reach_every_row(spark, tmp_path):
    xlsx.write(
        tmp_path / "local.xlsx",
        {"S": [["RAW MATERIALS", "SUPPLIER"], ["Soya", "a"], [None, "b"], [None, "c"], ["Corn", "d"]]},
        {"S": ["A2:A3", "B4:C4"]},
    )
    rows = B.sheet_rows(scanned(spark, tmp_path))
    filled = with_span(rows, merged_ranges(rows), 0).orderBy("row_idx").select(
        merged_fill(F.col("cells"), F.col("span"), F.lit(0)).alias("p")
    )
    assert [r["p"] for r in filled.collect()] == ["RAW MATERIALS", "Soya", "Soya", None, "Corn"]
    found = B.merged_cells(rows).select("row_idx", "col_idx", "anchor_row", "anchor_value")
    assert {tuple(r) for r in found.collect()} == {
        (0, 0, 0, "Soya"), (1, 0, 0, "Soya"), (2, 1, 2, "c"), (2, 2, 2, "c"),
    }


def spoil(path, part, text="<worksheet><sheetData><row r='1'>"):
    """Replace a part of a workbook by a text that no parser reads to its end."""
    with zipfile.ZipFile(path) as book:
        parts = {n: book.read(n) for n in book.namelist()}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for name, data in parts.items():
            book.writestr(name, text if name == part else data)


def three_sheets(tmp_path):
    xlsx.write(
        tmp_path / "20250811" / "d.xlsx",
        {"A": [["a"], ["b"]], "B": [["c"]], "C": [["d"], ["e"], ["f"]]},
    )
    return tmp_path / "20250811" / "d.xlsx"


def test_sheets_of_a_workbook_are_read_by_several_tasks(spark, tmp_path):
    three_sheets(tmp_path)
    apart = B.scan_workbooks(spark, str(tmp_path), partition_bytes=1)
    tasks = apart.withColumn("task", F.spark_partition_id()).groupBy("sheet").agg(
        F.count_distinct("task").alias("n"), F.min("task").alias("task")
    ).collect()
    assert len({r["task"] for r in tasks}) == 3 and {r["n"] for r in tasks} == {1}
    together = B.scan_workbooks(spark, str(tmp_path))
    assert together.rdd.getNumPartitions() == 1
    order = ["sheet", "row_idx"]
    assert apart.orderBy(*order).collect() == together.orderBy(*order).collect()


def test_listing_reads_no_rows(spark, tmp_path):
    path = three_sheets(tmp_path)
    spoil(path, "xl/worksheets/sheet2.xml")
    spoil(path, "xl/sharedStrings.xml", "<sst><si>")
    listed = B.list_sheets(spark, str(tmp_path)).orderBy("sheet_pos").collect()
    assert [(r["sheet"], r["sheet_pos"], r["error"]) for r in listed] == [("A", 0, None), ("B", 1, None), ("C", 2, None)]
    assert {r["sheet"] for r in B.sheet_listing(B.list_sheets(spark, str(tmp_path))).collect()} == {"A", "B", "C"}


def test_half_read_sheets_are_rejects_and_others_stay(spark, tmp_path):
    spoil(three_sheets(tmp_path), "xl/worksheets/sheet3.xml", "<worksheet><sheetData><row r='1'><c><v>1</v></c></row><row")
    all_rows = B.scan_workbooks(spark, str(tmp_path), partition_bytes=1)
    assert {r["sheet"] for r in all_rows.filter("row_idx is not null").collect()} == {"A", "B", "C"}
    assert {r["sheet"] for r in B.sheet_rows(all_rows).collect()} == {"A", "B"}
    (bad,) = B.unreadable(all_rows).collect()
    assert (bad["sheet"], "ParseError" in bad["reason"]) == ("C", True)


def test_filters_and_columns_reach_the_source(spark, tmp_path):
    path = three_sheets(tmp_path)
    spoil(path, "xl/worksheets/sheet2.xml")
    only = B.scan_workbooks(spark, str(tmp_path), columns=["row_idx"], sheets=["C"], partition_bytes=1)
    assert only.columns == ["ingest_date", "workbook", "sheet", "row_idx", "path"]
    assert only.rdd.getNumPartitions() == 1
    # The spoiled sheet would give a row with an error.
    assert [tuple(r) for r in only.select("sheet", "row_idx").orderBy("row_idx").collect()] == [("C", -1), ("C", 0), ("C", 1)]
    reader = B.WorkbookReader(B.SCAN, {"path": str(tmp_path), "partitionbytes": "1"})
    list(reader.pushFilters([B.EqualTo(("path",), f"file:{path}x")]))
    assert reader.partitions() == [B.Sheets("", [])]


def test_many_workbooks_are_not_opened_by_the_driver(spark, tmp_path, monkeypatch):
    three_sheets(tmp_path)
    xlsx.write(tmp_path / "20250812" / "e.xlsx", {"B": [["x"]]})
    monkeypatch.setattr(B, "PLANNED_FILES", 1)
    reader = B.WorkbookReader(B.SCAN, {"path": str(tmp_path)})
    list(reader.pushFilters([B.In(("sheet",), ("B", "C"))]))
    parts = reader.partitions()
    assert [p.sheets for p in parts] == [None, None]
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted((r["sheet"], r["row_idx"]) for r in rows) == [("B", -1), ("B", -1), ("C", -1), ("C", 0), ("C", 1)]


def test_folders_by_pattern(spark, tmp_path):
    for date in ("20250811", "20250812", "20250813"):
        xlsx.write(tmp_path / date / "d.xlsx", {"S": [["a"]]})
    xlsx.write(tmp_path / "20250811" / ".hidden.xlsx", {"S": [["a"]]})

    def dates(path):
        return sorted(r["ingest_date"].day for r in B.scan_workbooks(spark, path).collect())

    assert dates(f"{tmp_path}/{{20250811,20250813}}") == [11, 13]
    assert dates(f"{tmp_path}/*") == dates(f"file://{tmp_path}") == [11, 12, 13]
    assert dates(f"{tmp_path}/2025081[12]") == [11, 12]
    assert dates(f"{tmp_path}/20250812/d.xlsx") == [12] and dates(f"{tmp_path}/none") == []


def test_old_workbooks_are_named(spark, tmp_path):
    xlsx.write(tmp_path / "20250811" / "d.xlsx", {"S": [["a"]]})
    (tmp_path / "20250811" / "old.xls").write_bytes(b"\xd0\xcf\x11\xe0")
    (bad,) = B.unreadable(scanned(spark, tmp_path)).collect()
    assert bad["workbook"] == "old.xls" and "OldFormat" in bad["reason"]


def test_bytes_from_spark_give_the_same_rows(spark, tmp_path):
    three_sheets(tmp_path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    order = ["sheet", "row_idx"]
    ours = scanned(spark, tmp_path).drop("path").orderBy(*order).collect()
    assert B.scan_files(files).drop("path").orderBy(*order).collect() == ours


def test_a_large_range_stands_once(spark, tmp_path):
    """16,384 columns by 100,000 rows: one entry in the scan, one copy per bucket of rows."""
    n = 100_000
    xlsx.write(tmp_path / "w.xlsx", {"S": [["head"], ["all of it"]] + [[None, 1.0]] * (n - 1)}, {"S": [f"A2:XFD{n + 1}"]})
    rows = B.sheet_rows(scanned(spark, tmp_path))
    ranges = merged_ranges(rows)
    (only,) = ranges.collect()
    assert (only["top"], only["left"], only["right"], only["last_row"], only["value"]) == (0, 0, 16383, n - 1, "all of it")
    for position in (0, F.lit(16_383)):
        filled = with_span(rows, ranges, position).groupBy("span").count().collect()
        assert {(r["span"] and r["span"]["value"], r["count"]) for r in filled} == {(None, 1), ("all of it", n)}


def test_spans_equal_a_loop(spark):
    random = np.random.default_rng(8)
    cells, spans, ranges = [], {}, []
    for sheet in ("a", "b"):
        for column in range(3):
            at = 0
            while at < 300:
                size = int(random.integers(1, 40))
                if random.random() < 0.5:
                    ranges.append((sheet, at, column, column, at + size - 1, f"{sheet}{column}-{at}"))
                    spans.update({(sheet, column, r): (at, f"{sheet}{column}-{at}") for r in range(at, at + size)})
                at += size + 1
        cells += [(sheet, i, i % 2) for i in range(-1, 320)]
    rows = spark.createDataFrame(cells, "sheet string, row_idx long, _over int")
    found = spark.createDataFrame(ranges, "sheet string, top long, left int, right int, last_row long, value string")
    for position, own in ((2, lambda r: 2), (F.col("_over"), lambda r: r["_over"])):
        for r in with_span(rows, found, position, ["sheet"], bucket_rows=16).collect():
            want = spans.get((r["sheet"], own(r), r["row_idx"]))
            assert (r["span"] and (r["span"]["top"], r["span"]["value"])) == want


def test_a_broken_workbook_does_not_stop_the_others(spark, tmp_path):
    xlsx.write(tmp_path / "good.xlsx", {"S": [["a"], ["b"]]})
    (tmp_path / "bad.xlsx").write_bytes(b"no zip file")
    all_rows = scanned(spark, tmp_path)
    assert B.sheet_rows(all_rows).count() == 2
    (bad,) = B.unreadable(all_rows).collect()
    assert bad["workbook"] == "bad.xlsx" and "BadZipFile" in bad["reason"]


def test_batches_of_rows_lose_nothing(spark, tmp_path):
    n = B.BATCH_ROWS + 10
    xlsx.write(tmp_path / "long.xlsx", {"S": [["head"]] + [[float(i)] for i in range(n)]})
    rows = B.sheet_rows(scanned(spark, tmp_path))
    got = rows.agg(F.count("*"), F.min("row_idx"), F.max("row_idx"), F.count_distinct("row_idx")).first()
    assert tuple(got) == (n + 1, -1, n - 1, n + 1)


def test_grid_round_trip_keeps_blank_rows(spark, tmp_path):
    xlsx.write(tmp_path / "w.xlsx", {"S": [["l"], ["a", None, "b"], [None], ["c"]]})
    rows = B.sheet_rows(scanned(spark, tmp_path)).filter("row_idx >= 0")
    dims = rows.groupBy("ingest_date", "workbook", "sheet").agg(
        (F.max("row_idx") + 1).alias("n_rows"), F.max(F.size("cells")).alias("n_cols")
    )
    back = B.rows_of(B.cells_of(rows), dims).orderBy("row_idx")
    assert [r["cells"] for r in back.collect()] == [["a", None, "b"], [None] * 3, ["c", None, None]]


def test_usage_file(spark, tmp_path):
    folder = tmp_path / "20250811"
    folder.mkdir()
    (folder / "global_usage.csv").write_text(
        '"Ingredient  Name","Ingredient\nAmount","Ingredient Stock"\n'
        '" Soya ","1,234.5",10\n"","5",1\nCorn,abc,\nN/A,1,1\n"A ""b""",7,8\n'
    )
    rows = files.read_usage(spark, str(folder / "global_usage.csv")).orderBy("file_pos").collect()
    assert [tuple(r)[:3] for r in rows] == [
        ("Soya", 1234.5, 10.0), ("Corn", 0.0, 0.0), ('A "b"', 7.0, 8.0),
    ]
    assert rows[0]["ingest_date"] == dt.date(2025, 8, 11)


def test_dimension_file_keeps_na_and_last_duplicate(spark, tmp_path):
    path = tmp_path / "product_categories.csv"
    path.write_text("Product,Category\nSoya,meal\n Corn ,N/A\nOats,\nSoya, oil \n")
    dim = files.read_dimension(spark, str(path)).orderBy("file_pos").collect()
    assert [(r["product"], r["category"]) for r in dim] == [
        ("Soya", "oil"), ("Corn", "N/A"), ("Oats", ""),
    ]


def test_configuration_files(spark, tmp_path):
    mapping = tmp_path / "mapping.json"
    mapping.write_text(json.dumps({"table_column_mapping": {
        "LANDED": {"product_column": "PRODUCT", "quantity_column": "QTY (MT) /BL"},
        "global_usage": {"product_column": "a", "quantity_column": "b"},
    }}, indent=1))
    assert files.mapping_dict(files.read_mapping(spark, str(mapping))) == {
        "LANDED": ("PRODUCT", "QTY (MT) /BL")
    }
    aliases = tmp_path / "aliases.json"
    aliases.write_text(json.dumps({"UNSERVED_LOCAL": {"RAW MATERIALS": ["RAW MATERIAL", "STUFF"]}}))
    read = files.read_aliases(spark, str(aliases))
    assert files.alias_dict(read, "UNSERVED_LOCAL") == {"RAW MATERIALS": ["RAW MATERIAL", "STUFF"]}


def test_date_comes_from_the_directory(spark):
    paths = ["in/20250811/a.xlsx", "in/x/20250811.xlsx", "in/20251399/a.xlsx", "in/120250811/a.xlsx"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    default = F.lit("2020-01-01").cast("date")
    got = df.select(folders.ingest_date_of(F.col("path"), default).cast("string")).collect()
    assert [r[0] for r in got] == ["2025-08-11", "2020-01-01", "2020-01-01", "2020-01-01"]


def test_folder_status_and_spine(spark, tmp_path):
    for folder, names in {
        "20250811": ["imports.xlsx", "local.xlsx", "inventory.xlsx"],
        "20250813": ["imports.xlsx"],
        "notes": ["imports.xlsx"],
    }.items():
        (tmp_path / folder).mkdir()
        for name in names:
            (tmp_path / folder / name).write_bytes(b"x")
    status = folders.partition_status(folders.list_files(spark, str(tmp_path)))
    assert [tuple(r) for r in status.collect()] == [
        ("20250811", "Ready", ""),
        ("20250813", "Missing files", "local.xlsx, inventory.xlsx"),
    ]
    dates = status.select(F.to_date("folder", "yyyyMMdd").alias("ingest_date"))
    assert [r[0] for r in folders.missing_dates(dates).collect()] == [dt.date(2025, 8, 12)]
    spine = folders.date_spine(spark, F.lit("2025-12-30").cast("date"), 3)
    assert [r[0].isoformat() for r in spine.orderBy("ingest_date").collect()] == [
        "2025-12-30", "2025-12-31", "2026-01-01",
    ]


def test_rows_are_listed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(B, "CHUNK_ROWS", 3)
    cells = spark.createDataFrame([("s", 6, 0, "x")], "sheet string, row_idx bigint, col_idx int, value string")
    dims = spark.createDataFrame([("s", 8, 2), ("t", 3, 1)], "sheet string, n_rows int, n_cols int")
    rows = B.rows_of(cells, dims, ["sheet"]).orderBy("sheet", "row_idx").collect()
    assert [(r["sheet"], r["row_idx"]) for r in rows] == [("s", i) for i in range(8)] + [("t", i) for i in range(3)]
    assert rows[6]["cells"] == ["x", None] and rows[10]["cells"] == [None]
