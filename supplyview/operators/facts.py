"""From late-named rows to the (product, quantity, status, category) fact
(P1-P6, P13, P14, J1, U1)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyview.functions import is_blank, lenient_double, strip
from supplyview.operators.fill import with_span
from supplyview.operators.joins import BROADCAST_BYTES, lookup_join
from supplyview.operators.routing import status_of
from supplyview.schemas import ACKNOWLEDGED, FACT, INVENTORY_STATUS, USAGE_STATUS

KILOS_PER_TON = 1000.0

# Columns of projected rows that the fact replaces or drops.
PROJECTED = (
    "product", "quantity_text", "supplier", "has_supplier", "product_pos", "header_row",
    "n_columns", "table", "start_row", "cells", "merged",
)

POSITIONS = ("product_pos", "quantity_pos", "supplier_pos", "n_columns", "header_row")


def project_cells(attached: DataFrame) -> DataFrame:
    """P1 + P2: pick product, quantity and supplier cells by position.

    ``attached`` holds rows with their sheet's ``product_pos``, ``quantity_pos``,
    ``supplier_pos`` and ``table``.
    """
    cells = F.col("cells")
    return attached.select(
        *[c for c in attached.columns if c not in POSITIONS],
        F.get(cells, F.col("product_pos")).alias("product"),
        F.get(cells, F.col("quantity_pos")).alias("quantity_text"),
        F.get(cells, F.col("supplier_pos")).alias("supplier"),
        F.col("supplier_pos").isNotNull().alias("has_supplier"),
        "product_pos",
        "header_row",
        "n_columns",
    )


def fill_merged_products(
    projected: DataFrame, ranges: DataFrame | None, where: Column, keys: Sequence[str]
) -> DataFrame:
    """G14 on the rows ``where`` holds: the product of a merged cell is its range's
    top-left value. Rows without a supplier are summary rows and lose theirs.

    Only for products in the first column, wherever the header stands; other rows
    are not joined. ``ranges`` are those of the whole sheets (``merged_ranges``); None: there
    are none.
    """
    where = F.coalesce(where & (F.col("product_pos") == 0), F.lit(False))
    is_summary = F.col("has_supplier") & F.coalesce(F.col("supplier") == "", F.lit(True))
    slim = projected.drop("cells", "merged")
    if ranges is None:
        emptied = F.when(where & is_summary, F.lit("")).otherwise(F.col("product"))
        return slim.withColumn("product", emptied)
    found = with_span(slim.filter(where), ranges, 0, keys, "_span")
    own = F.when(F.col("_span").isNotNull(), F.col("_span.value")).otherwise(F.col("product"))
    filled = found.withColumn("product", F.when(is_summary, F.lit("")).otherwise(own)).drop("_span")
    return filled.unionByName(slim.filter(~where))


def nonempty_product(df: DataFrame, column: str = "product") -> DataFrame:
    """Drop rows whose product is null, empty or white space."""
    return df.filter(~is_blank(F.col(column)))


def is_local(table: Column) -> Column:
    """Tables counted in kilos: the name holds UNSERVED and LOCAL."""
    name = F.upper(table)
    return name.contains("UNSERVED") & name.contains("LOCAL")


def to_tons(quantity: Column, table: Column, legacy: bool = False) -> Column:
    """Kilos to tons for unserved local, inventory and usage.

    ``legacy`` (P7): unserved local is multiplied by 1000 and nothing is divided.
    """
    if legacy:
        return F.when(is_local(table), quantity * KILOS_PER_TON).otherwise(quantity)
    in_kilos = is_local(table) | table.isin(INVENTORY_STATUS, USAGE_STATUS)
    return F.when(in_kilos, quantity / KILOS_PER_TON).otherwise(quantity)


def quantity_fact(projected: DataFrame, legacy_units: bool = False) -> DataFrame:
    """Status, parsed quantity in tons, empty products dropped."""
    parsed = lenient_double(F.col("quantity_text"))
    return nonempty_product(projected).select(
        *[c for c in projected.columns if c not in PROJECTED],
        "product",
        to_tons(parsed, F.col("table"), legacy_units).alias("quantity"),
        status_of(F.col("table")).alias("status"),
    )


def category_lookup(
    fact: DataFrame, dim: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Category of the stripped product, '' when it is unknown."""
    keyed = fact.withColumn("_product", strip(F.col("product")))
    known = dim.select(F.col("product").alias("_product"), "category")
    joined = lookup_join(keyed, known, ["_product"], broadcast_bytes)
    return joined.withColumn("category", F.coalesce("category", F.lit(""))).drop("_product")


def combine(tables: Iterable[DataFrame], spark=None) -> DataFrame:
    """Union by name, missing columns null; nothing to union gives an empty fact."""
    tables = list(tables)
    if not tables:
        return spark.createDataFrame([], FACT)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def with_status(fact: DataFrame, status: str) -> DataFrame:
    """Status filter ignoring case."""
    return fact.filter(F.upper("status") == status.upper())


def usage_rows(fact: DataFrame) -> DataFrame:
    """P14."""
    return fact.filter(F.col("status") == USAGE_STATUS)


def is_acknowledged(category: Column) -> Column:
    """Products marked ``N/A`` on purpose; trimmed, ignoring case."""
    return F.coalesce(F.upper(strip(category)) == ACKNOWLEDGED, F.lit(False))
