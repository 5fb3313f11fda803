"""The reporting inputs as views over the benchmark tables.

Each view is a plain rule over whole tables, so its size follows theirs:
products come from ``part``, deliveries from ``lineitem``, spreadsheet grids from
``events`` and ``orders``. Row numbers inside a sheet are arithmetic on dense ids,
so no ordering job is needed to lay out a sheet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyview.operators import usage as U
from supplyview.operators.fill import nothing_merged
from supplyview.operators.joins import lookup_join
from supplyview.schemas import (
    INVENTORY_STATUS,
    TABLE_COLUMNS,
    USAGE_AMOUNT,
    USAGE_NAME,
    USAGE_STOCK,
)

KEYS = ("workbook", "sheet")
SHEET_ROWS = 256
ORDER_SHEET_ROWS = 128

# Which delivery table a line item belongs to; the sixth pair is unmapped.
LINE_TABLES = {
    ("A", "F"): "LANDED",
    ("N", "F"): "PULLOUT",
    ("R", "F"): "SAILING",
    ("A", "O"): "UNSERVED IMPORTED",
    ("N", "O"): "UNSERVED LOCAL",
}


# The tables' columns; given, no job has to look them up.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double,"
    " l_returnflag string, l_linestatus string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, user_id bigint, event_type string, value double, props string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def category_rule(name: Column) -> Column:
    """N/A for red products, blank for old ones, else the noun."""
    return (
        F.when(name.startswith("red "), "N/A")
        .when(name.startswith("old "), "")
        .otherwise(F.substring_index(name, " ", -1))
    )


def part_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts by name, which the dimension, the inventory and the usage files read.

    Decimal sums of prices, so that the whole part does not depend on the summing order.
    """
    price = F.col("p_retailprice").cast("decimal(18,2)")
    return read(spark, sf_dir, "part").groupBy("p_name").agg(
        F.min("p_partkey").alias("file_pos"),
        F.sum(price).alias("price"),
        F.sum("p_size").alias("size"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def dimension(spark: SparkSession, sf_dir: str, parts: DataFrame | None = None) -> DataFrame:
    """Known products: all but the hot ones; file position is the first part key.

    ``parts``: the parts by name, when they are staged already; so below.
    """
    parts = part_sums(spark, sf_dir) if parts is None else parts
    return parts.filter(~F.col("p_name").startswith("hot ")).select(
        F.col("p_name").alias("product"), category_rule(F.col("p_name")).alias("category"), "file_pos"
    )


def raw_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An uncleaned category file: padded names, repeated with changing categories."""
    return read(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("product"),
        F.when(F.col("p_size") % 5 == 0, F.lit(None))
        .when(F.col("p_size") % 5 == 1, F.lit("N/A"))
        .otherwise(F.concat(F.col("p_type"), F.lit("  ")))
        .alias("category"),
        F.col("p_partkey").alias("file_pos"),
    )


def line_table() -> Column:
    """Delivery table of a line item, null for the unmapped pair."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    whens = [((flag == f) & (status == s), t) for (f, s), t in LINE_TABLES.items()]
    first, *rest = whens
    return reduce(lambda c, w: c.when(*w), rest, F.when(*first))


def _part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("product"))


def delivery_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per mapped line item: l_orderkey, product, quantity, table."""
    lines = (
        read(spark, sf_dir, "lineitem")
        .select(
            "l_orderkey",
            F.col("l_partkey").alias("p_partkey"),
            F.col("l_quantity").alias("quantity"),
            line_table().alias("table"),
        )
        .filter(F.col("table").isNotNull())
    )
    return lookup_join(lines, _part_names(spark, sf_dir), ["p_partkey"]).drop("p_partkey")


def delivery_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity and rows per (product, table).

    Lines are summed by part before the join, with one column pair per table: a
    part is one row whatever its share of the lines, and the rows are already
    hashed by the join key.
    """
    names = list(LINE_TABLES.values())
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), "l_quantity", line_table().alias("table")
    )
    here = [F.col("table") == name for name in names]
    by_part = (
        lines.filter(F.col("table").isNotNull())
        .groupBy("p_partkey")
        .agg(
            *[F.sum(F.when(h, F.col("l_quantity"))).alias(f"_q{i}") for i, h in enumerate(here)],
            *[F.count_if(h).alias(f"_n{i}") for i, h in enumerate(here)],
        )
    )
    columns = [f"_{kind}{i}" for kind in "qn" for i in range(len(names))]
    by_product = (
        by_part.join(_part_names(spark, sf_dir), "p_partkey")
        .groupBy("product")
        .agg(*[F.sum(c).alias(c) for c in columns])
    )
    entries = [
        F.struct(
            F.lit(name).alias("table"),
            F.col(f"_q{i}").alias("quantity"),
            F.col(f"_n{i}").alias("n_rows"),
        )
        for i, name in enumerate(names)
    ]
    return by_product.select("product", F.inline(F.array(*entries))).filter("n_rows > 0")


def inventory_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_name").alias("product"),
        F.col("p_size").cast("double").alias("quantity"),
        F.lit(INVENTORY_STATUS).alias("table"),
    )


def inventory_sums(spark: SparkSession, sf_dir: str, parts: DataFrame | None = None) -> DataFrame:
    parts = part_sums(spark, sf_dir) if parts is None else parts
    return parts.select(
        F.col("p_name").alias("product"),
        F.lit(INVENTORY_STATUS).alias("table"),
        F.col("size").cast("double").alias("quantity"),
        "n_rows",
    )


def _usage_text(parts: DataFrame, name: Column) -> DataFrame:
    """A usage file: one line per name, amounts as text with thousands commas."""
    return parts.groupBy(name.alias(USAGE_NAME)).agg(
        F.format_number(F.floor(F.sum("price")), 0).alias(USAGE_AMOUNT),
        F.format_number(F.sum("size"), 0).alias(USAGE_STOCK),
        F.min("file_pos").alias("file_pos"),
    )


def raw_usage(spark: SparkSession, sf_dir: str, parts: DataFrame | None = None) -> DataFrame:
    """Ingredient names are the product names."""
    return _usage_text(part_sums(spark, sf_dir) if parts is None else parts, F.col("p_name"))


def usage(spark: SparkSession, sf_dir: str, parts: DataFrame | None = None) -> DataFrame:
    return U.clean_usage(raw_usage(spark, sf_dir, parts))


def loose_usage(spark: SparkSession, sf_dir: str, parts: DataFrame | None = None) -> DataFrame:
    """Ingredient names that match products in full, in part or not at all."""
    parts = part_sums(spark, sf_dir) if parts is None else parts
    name = F.col("p_name")
    noun = F.substring_index(name, " ", -1)
    loose = (
        F.when(name.startswith("hot "), noun)
        .when(name.startswith("cold "), F.concat(F.upper(name), F.lit(" Premium")))
        .when(name.startswith("new "), F.concat(F.lit("alloy "), F.substring(noun, 1, 2)))
        .otherwise(name)
    )
    return U.clean_usage(_usage_text(parts, loose))


def _texts(*values) -> Column:
    """A row of cells; None gives a null cell, text a literal."""
    return F.array(
        *[
            v.cast("string") if isinstance(v, Column) else F.lit(v).cast("string")
            for v in values
        ]
    )


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy sheets of 256 rows and five columns out of the events.

    Blank rows, repeated rows, header rows, table markers and gaps stand at fixed
    multiples of the event id, so each sheet has its own arrangement.
    """
    n = F.col("event_id")

    def every(k: int) -> Column:
        return n % k == 0

    kind = F.when(n % 3 != 1, F.col("event_type"))
    value = F.when(every(29), F.lit("-")).otherwise(F.col("value").cast("string"))
    supplier = F.when(
        ~every(5), F.concat(F.lit("SUP "), (F.col("user_id") % 20).cast("string"))
    )
    product_name = (
        F.when(F.col("user_id") % 4 == 0, "RAW MATERIALS")
        .when(F.col("user_id") % 4 == 1, "raw materials")
        .when(F.col("user_id") % 4 == 2, "RAW MATERIAL")
        .otherwise("Raw Material Name")
    )
    quantity_name = (
        F.when(F.col("user_id") % 3 == 0, "STILL TO BE DELIVERED (in kilos)")
        .when(F.col("user_id") % 3 == 1, "Still to deliver (KG)")
        .otherwise("QTY")
    )
    props = F.col("props")
    cells = (
        F.when(every(17), _texts(None, None, None, None, None))
        .when(n % 37 <= 1, _texts("repeat", "1", "same", None, None))
        .when(every(23), _texts("ITEM DESCRIPTION", "QTY IN KGS", "SUPPLIER", "REMARKS", None))
        .when(every(41), _texts(kind, "LANDED TABLE", supplier, props, None))
        .when(every(43), _texts(kind, value, "PULL-OUT TABLE", props, None))
        .when(every(47), _texts("FOR PULL-OUT", value, supplier, props, None))
        .when(every(53), _texts("LANDED", value, supplier, props, None))
        .when(every(59), _texts(product_name, quantity_name, "SUPPLIER", "REMARKS", None))
        .when(every(61), _texts("BILL OF LADING NO", value, supplier, props, None))
        .when(every(67), _texts("Contract No", value, supplier, props, None))
        .otherwise(_texts(kind, value, supplier, props, None))
    )
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("wb"), F.floor(n / (4 * SHEET_ROWS)).cast("string")).alias("workbook"),
        F.concat(F.lit("S"), (F.floor(n / SHEET_ROWS) % 4).cast("string")).alias("sheet"),
        (n % SHEET_ROWS).alias("row_idx"),
        cells.alias("cells"),
        "event_id",
    )


# Sheets of a delivery workbook, in turn; the stacked sheet holds two tables.
ORDER_SHEETS = (
    "LANDED.PULL OUT", "SAILING", "UNSERVED IMPORTED", "UNSERVED LOCAL", "SUMMARY", "NOTES",
)


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sheet rows; the product is named after the customer's number."""
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("material "), (F.col("o_custkey") % 500).cast("string")).alias("product"),
        F.col("o_totalprice").cast("string").alias("price"),
        "o_orderpriority",
        F.floor(F.col("o_orderkey") / ORDER_SHEET_ROWS).alias("sheet_no"),
        (F.col("o_orderkey") % ORDER_SHEET_ROWS).alias("pos"),
    )


def _placed(row_idx: Column, cells: Column) -> Column:
    return F.struct(row_idx.cast("bigint").alias("row_idx"), cells.alias("cells"))


def delivery_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery workbooks out of the orders: title, header and data rows per sheet.

    The row that opens a sheet (and the one that opens the second table of a
    stacked sheet) also brings the title or marker row and the header row.
    """
    pos, half = F.col("pos"), ORDER_SHEET_ROWS // 2
    turn = F.col("sheet_no") % len(ORDER_SHEETS)
    kind = F.element_at(F.lit(list(ORDER_SHEETS)), (turn + 1).cast("int"))
    stacked, local = turn == 0, turn == 3
    product = F.when(local, TABLE_COLUMNS["UNSERVED_LOCAL"][0]).otherwise("PRODUCT")
    quantity = (
        F.when(turn <= 1, TABLE_COLUMNS["LANDED"][1])
        .when(turn == 2, TABLE_COLUMNS["UNSERVED_IMPORTED"][1])
        .when(local, TABLE_COLUMNS["UNSERVED_LOCAL"][1])
        .otherwise("AMOUNT")
    )
    header = _texts(product, quantity, "SUPPLIER", None)
    # Summary rows have no supplier; unserved local names a product once per group.
    supplier = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority"))
    shown = F.when(~local | (F.col("o_orderkey") % 4 == 0), F.col("product"))
    price = F.when(F.col("o_orderkey") % 11 == 0, F.lit("n.a.")).otherwise(F.col("price"))
    data = _texts(shown, price, supplier, None)
    in_second = stacked & (pos >= half)
    offset = F.when(in_second, F.lit(4)).otherwise(F.lit(2))
    here = [_placed(pos + offset, data)]
    title = F.when(stacked, F.lit("LANDED TABLE")).otherwise(F.lit("REPORT 1"))
    first = [
        _placed(F.lit(0), _texts(title, None, None, None)),
        _placed(F.lit(1), header),
    ]
    second = [
        _placed(F.lit(half + 2), _texts("PULL-OUT TABLE", None, None, None)),
        _placed(F.lit(half + 3), header),
    ]
    placed = (
        F.when(pos == 0, F.array(*first, *here))
        .when(stacked & (pos == half), F.array(*second, *here))
        .otherwise(F.array(*here))
    )
    return (
        _order_rows(spark, sf_dir)
        .select(
            F.concat(F.lit("deliveries"), F.floor(F.col("sheet_no") / 6).cast("string")).alias(
                "workbook"
            ),
            kind.alias("sheet"),
            F.inline(placed),
        )
        .withColumn("merged", nothing_merged())
    )


# Sheets of imports and local workbooks, in turn.
SPLIT_SHEET_NAMES = ("Sailling", "Landed", "For Pull out Return", "UNSERVED", "Sheet1", "Other")


def split_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imports and local workbooks out of the orders.

    The unserved sheet has its header in the label row, the others below a title;
    the local workbook (fifth sheet) spells its headers in varying ways.
    """
    pos = F.col("pos")
    turn = F.col("sheet_no") % 6
    kind = F.element_at(F.lit(list(SPLIT_SHEET_NAMES)), (turn + 1).cast("int"))
    is_local, is_labelled = turn == 4, turn == 3
    variant = F.floor(F.col("sheet_no") / 6) % 3
    local_header = (
        F.when(
            variant == 0,
            _texts("RAW MATERIALS", "SUPPLIER", "STILL TO BE DELIVERED (in kilos)", None),
        )
        .when(variant == 1, _texts("Raw Material", "SUPPLIER", "Still to deliver (KG)", None))
        .otherwise(_texts("raw materials", "SUPPLIER", "REMAINING", None))
    )
    quantity = F.when(is_labelled, "TOTAL").otherwise("QTY (MT) /BL")
    anchor = F.when(turn == 0, "Contract No").otherwise("Bill of Lading")
    header = F.when(is_local, local_header).otherwise(_texts("PRODUCT", anchor, quantity, None))
    supplier = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority"))
    shown = F.when(~is_local | (F.col("o_orderkey") % 4 == 0), F.col("product"))
    data = F.when(
        F.col("o_orderkey") % 13 == 0, _texts(None, None, None, None)
    ).otherwise(_texts(shown, supplier, F.col("price"), None))
    header_at = F.when(is_labelled, F.lit(-1)).otherwise(F.lit(1))
    opening = [
        _placed(F.when(is_labelled, F.lit(0)).otherwise(F.lit(-1)), _texts("note", None, None, None)),
        _placed(F.when(is_labelled, F.lit(1)).otherwise(F.lit(0)), _texts("title", None, None, None)),
        _placed(header_at, header),
    ]
    here = _placed(pos + 2, data)
    placed = F.when(pos == 0, F.array(*opening, here)).otherwise(F.array(here))
    prefix = F.when(is_local, "local").otherwise("imports")
    return (
        _order_rows(spark, sf_dir)
        .select(
            F.concat(prefix, F.floor(F.col("sheet_no") / 6).cast("string")).alias("workbook"),
            kind.alias("sheet"),
            F.inline(placed),
        )
        .withColumn("merged", nothing_merged())
    )


def inventory_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory sheets out of the parts; every fifth sheet lacks a proper header."""
    sheet_no = F.floor(F.col("p_partkey") / ORDER_SHEET_ROWS)
    pos = F.col("p_partkey") % ORDER_SHEET_ROWS
    proper = sheet_no % 5 != 4
    header = _texts(
        "ITEM DESCRIPTION", F.when(proper, "QTY IN KGS").otherwise("KGS"), "QTY OPEN", "BRAND"
    )
    product = (
        F.when(F.col("p_partkey") % 19 == 0, F.lit("  "))
        .when(F.col("p_partkey") % 19 == 1, F.lit(None))
        .otherwise(F.col("p_name"))
    )
    data = F.when(
        F.col("p_partkey") % 23 == 0, _texts(None, None, None, None)
    ).otherwise(
        _texts(product, F.col("p_size"), F.lit(None).cast("string"), F.col("p_brand"))
    )
    opening = [
        _placed(F.lit(0), _texts("STOCK LIST", None, None, None)),
        _placed(F.lit(1), _texts(None, None, None, None)),
        _placed(F.lit(2), header),
    ]
    here = _placed(pos + 3, data)
    placed = F.when(pos == 0, F.array(*opening, here)).otherwise(F.array(here))
    return (
        read(spark, sf_dir, "part")
        .select(
            F.concat(F.lit("inventory"), F.floor(sheet_no / 8).cast("string")).alias("workbook"),
            F.concat(F.lit("S"), (sheet_no % 8).cast("string")).alias("sheet"),
            (sheet_no % 8).cast("int").alias("sheet_pos"),
            F.inline(placed),
        )
        .withColumn("merged", nothing_merged())
    )


# Rows of a merged range in the inventory, and which ranges there are.
MERGED_ROWS, MERGED_TURN = 4, 5


def merged_inventory_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory sheets with merged product cells: every fifth group of four rows below
    the header has its product in the first row alone."""
    rows = inventory_grid(spark, sf_dir)
    group = F.floor((F.col("row_idx") - 3) / MERGED_ROWS)
    first = 3 + group * MERGED_ROWS
    is_merged = (F.col("row_idx") >= 3) & (group % MERGED_TURN == 2)
    name = F.concat(F.lit("pack widget "), group.cast("string"))
    span = F.struct(
        F.lit(0).alias("left"), F.lit(0).alias("right"),
        (first + MERGED_ROWS - 1).alias("last_row"), name.alias("value"),
    )
    starts = is_merged & (F.col("row_idx") == first)
    own = F.when(F.col("row_idx") == first, name)
    return rows.withColumns({
        "cells": F.when(
            is_merged,
            F.concat(F.array(own), F.slice("cells", 2, F.size("cells"))),
        ).otherwise(F.col("cells")),
        "merged": F.when(starts, F.array(span)).otherwise(F.col("merged")),
    })


def audit_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery sheets with blank rows, and stacked sheets whose second table has no
    marker in every third workbook."""
    rows = delivery_grid(spark, sf_dir)
    number = F.replace(F.col("workbook"), F.lit("deliveries"), F.lit("")).cast("bigint")
    blank = (F.col("row_idx") > 1) & (F.col("row_idx") % 29 == 0)
    unmarked = number % 3 == 1
    shown = F.transform(
        "cells",
        lambda c: F.when(blank, F.lit(None))
        .when(unmarked & (c == "PULL-OUT TABLE"), F.lit("CONTINUED"))
        .otherwise(c),
    )
    return rows.withColumn("cells", shown)
