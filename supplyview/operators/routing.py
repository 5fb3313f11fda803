"""Which table a sheet holds, and whether it holds it properly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyview.schemas import INVENTORY_COLUMNS, SHEET_KEYS, TABLE_COLUMNS

STACKED = "STACKED"
SUMMARY = "SUMMARY"

# Sheet names of the split layout and the table each one holds.
SPLIT_SHEETS = {
    "SAILLING": "SAILING",
    "LANDED": "LANDED",
    "FOR PULL OUT RETURN": "PULLOUT",
    "UNSERVED": "UNSERVED IMPORTED",
}

# Sheets the sheet-only layout knows; other sheets are only cleaned.
NAMED_SHEETS = {
    "SUMMARY": SUMMARY,
    "SAILING": "SAILING",
    "LANDED PULL OUT": STACKED,
    "UNSERVED IMPORTED": "UNSERVED IMPORTED",
    "UNSERVED LOCAL": "UNSERVED LOCAL",
}
OTHER = "OTHER"


def normalize_name(name: Column) -> Column:
    """Upper case with every run of non-letters as one blank."""
    return F.trim(F.regexp_replace(F.upper(name), "[^A-Z]+", " "))


def normalize_text(name: str) -> str:
    """The same for a configuration key."""
    letters = [ch if "A" <= ch <= "Z" else " " for ch in name.upper()]
    return " ".join("".join(letters).split())


def _lookup(entries: Mapping[str, str], key: Column) -> Column:
    pairs = [F.lit(text) for item in entries.items() for text in item]
    return F.try_element_at(F.create_map(*pairs), key)


def route_combined(sheet: Column) -> Column:
    """G26, one delivery workbook: summary, stacked, or a table named like the sheet."""
    name = F.upper(sheet)
    return F.when(name.contains("LANDED") & name.contains("PULL"), STACKED).otherwise(
        normalize_name(sheet)
    )


def route_split(workbook: Column, sheet: Column) -> Column:
    """G26, imports and local workbooks: any local sheet is unserved local; unknown
    import sheets give null."""
    is_local = F.lower(workbook).contains("local")
    return F.when(is_local, "UNSERVED LOCAL").otherwise(
        _lookup(SPLIT_SHEETS, normalize_name(sheet))
    )


def route_named(sheet: Column) -> Column:
    """G26, sheet-only layout."""
    return F.coalesce(_lookup(NAMED_SHEETS, normalize_name(sheet)), F.lit(OTHER))


def status_of(table: Column) -> Column:
    """Status text of a table name."""
    return F.regexp_replace(table, "_", " ")


def mapping_columns(
    table: Column, mapping: Mapping[str, Sequence[str]] = TABLE_COLUMNS
) -> tuple[Column, Column]:
    """Product and quantity header of a table; null for an unmapped table.

    The mapping is a configuration file of a few entries, so it is a literal map.
    """
    key = normalize_name(table)
    products = {normalize_text(t): c[0] for t, c in mapping.items()}
    quantities = {normalize_text(t): c[1] for t, c in mapping.items()}
    products[normalize_text("INVENTORY")], quantities[normalize_text("INVENTORY")] = (
        INVENTORY_COLUMNS
    )
    return _lookup(products, key), _lookup(quantities, key)


def locate_columns(
    headers: DataFrame,
    mapping: Mapping[str, Sequence[str]] = TABLE_COLUMNS,
    header: str = "header",
    table: str = "table",
) -> DataFrame:
    """0-based positions of the mapped columns in each sheet's header.

    Adds ``product_pos``, ``quantity_pos``, ``supplier_pos`` and ``reason``; the
    reason is null when the sheet can be projected (G25, G33).
    """
    product, quantity = mapping_columns(F.col(table), mapping)

    def position(name: Column) -> Column:
        return F.nullif(F.array_position(F.col(header), name), F.lit(0)) - 1

    missing = F.array_join(
        F.array_except(F.array(product, quantity), F.col(header)), ", "
    )
    return headers.select(
        "*",
        position(product).alias("product_pos"),
        position(quantity).alias("quantity_pos"),
        position(F.lit("SUPPLIER")).alias("supplier_pos"),
        F.when(product.isNull(), F.lit("no column mapping"))
        .when(missing != "", F.concat(F.lit("missing columns: "), missing))
        .alias("reason"),
    )


def usable(located: DataFrame) -> DataFrame:
    """Sheets that can be projected."""
    return located.filter(F.col("reason").isNull()).drop("reason")


def rejects(located: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """The quarantined sheets with the reason; other sheets go on unharmed."""
    return located.filter(F.col("reason").isNotNull()).select(*keys, "table", "reason")


def require_columns(df: DataFrame, table: str, mapping=TABLE_COLUMNS) -> None:
    """G25 for a single wide table: raise when a mapped column is missing."""
    entries = {normalize_text(t): c for t, c in mapping.items()}
    required = entries.get(normalize_text(table), ())
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"{table}: missing required columns {absent}; found {df.columns}")
