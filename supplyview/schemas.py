"""Schemas and fixed names used across the library."""

from __future__ import annotations

from pyspark.sql import types as T

# A sheet is identified by these columns; every sheet operator takes ``keys``.
SHEET_KEYS = ("ingest_date", "workbook", "sheet")

# Table -> (product column, quantity column).
TABLE_COLUMNS = {
    "LANDED": ("PRODUCT", "QTY (MT) /BL"),
    "PULLOUT": ("PRODUCT", "QTY (MT) /BL"),
    "SAILING": ("PRODUCT", "QTY (MT) /BL"),
    "UNSERVED_IMPORTED": ("PRODUCT", "TOTAL"),
    "UNSERVED_LOCAL": ("RAW MATERIALS", "STILL TO BE DELIVERED (in kilos)"),
    "LANDED.PULL OUT": ("PRODUCT", "INVOICE QTY(MT)"),
    "UNSERVED CONTRACT": ("PRODUCT", "BL QTY(MT)"),
}
INVENTORY_COLUMNS = ("ITEM DESCRIPTION", "QTY IN KGS")

# Headers of the usage file (two blanks in the first one).
USAGE_NAME = "Ingredient  Name"
USAGE_AMOUNT = "Ingredient Amount"
USAGE_STOCK = "Ingredient Stock"

# Statuses and category labels.
DELIVERY_STATUSES = ("SAILING", "LANDED", "PULLOUT", "UNSERVED IMPORTED", "UNSERVED LOCAL")
INVENTORY_STATUS = "INVENTORY"
USAGE_STATUS = "GLOBAL USAGE"
ALL_STATUSES = (
    "GLOBAL USAGE", "INVENTORY", "LANDED", "PULLOUT", "SAILING",
    "UNSERVED IMPORTED", "UNSERVED LOCAL",
)
UNCATEGORIZED = "Uncategorized"
ACKNOWLEDGED = "N/A"
TOTAL = "TOTAL"
PROJECTION_MONTHS = (1, 2, 3, 4, 5, 6)

# A merged range, on its first row: columns, last row, and the value of its top-left cell.
MERGED_RANGE = T.StructType([
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("last_row", T.LongType()),
    T.StructField("value", T.StringType()),
])

# One spreadsheet row. row_idx -1 is spreadsheet row 1 (the label row); sheet_pos is the
# sheet's place in its workbook, from 0; merged holds the ranges that start on this row.
ROWS = T.StructType([
    T.StructField("ingest_date", T.DateType()),
    T.StructField("workbook", T.StringType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("sheet_pos", T.IntegerType()),
    T.StructField("row_idx", T.LongType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
    T.StructField("merged", T.ArrayType(MERGED_RANGE)),
])

FACT = T.StructType([
    T.StructField("ingest_date", T.DateType()),
    T.StructField("product", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("category", T.StringType()),
])

DIMENSION = T.StructType([
    T.StructField("product", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("file_pos", T.LongType()),
])

USAGE = T.StructType([
    T.StructField("ingredient_name", T.StringType()),
    T.StructField("ingredient_amount", T.DoubleType()),
    T.StructField("ingredient_stock", T.DoubleType()),
    T.StructField("file_pos", T.LongType()),
])

MAPPING = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("product_column", T.StringType()),
    T.StructField("quantity_column", T.StringType()),
])

ALIASES = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("expected", T.StringType()),
    T.StructField("alias", T.StringType()),
])
