"""Undoing merged cells and gaps in tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyview.operators.blocks import BLOCK_ROWS, with_running
from supplyview.schemas import MERGED_RANGE, SHEET_KEYS


# Rows that look up their merged ranges together. Ranges do not overlap, so of one column a
# bucket holds no more ranges than rows.
BUCKET_ROWS = 256
SPAN = "struct<top:bigint,last_row:bigint,value:string>"


def nothing_merged() -> Column:
    return F.array().cast(T.ArrayType(MERGED_RANGE))


def no_span() -> Column:
    return F.lit(None).cast(SPAN)


def merged_ranges(rows: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """(keys, top, left, right, last_row, value), one row per merged range.

    ``rows`` are whole sheets: a range stands on its first row alone, which filters or
    headers may take away.
    """
    return rows.filter(F.size("merged") > 0).select(
        *keys, F.col("row_idx").alias("top"), F.inline("merged")
    )


def any_merged(rows: DataFrame) -> bool:
    """Whether some sheet has a merged range: a job that reads one column and stops at the
    first one. Most workbooks have none, and their rows are then joined with nothing."""
    return "merged" in rows.columns and not rows.filter(F.size("merged") > 0).select("merged").isEmpty()


def with_span(
    rows: DataFrame,
    ranges: DataFrame,
    position: int | Column,
    keys: Sequence[str] = SHEET_KEYS,
    name: str = "span",
    bucket_rows: int = BUCKET_ROWS,
    row: str = "row_idx",
) -> DataFrame:
    """Rows with the merged range their cell at ``position`` lies in, as (top, last_row, value),
    null outside of any. ``row`` is the place in the sheet.

    An interval join bucketed by row: the ranges over the wanted column are dealt to the buckets
    of rows they cover, each bucket's list meets its rows by (sheet, bucket), and a row
    looks through a list no longer than the bucket. A range is copied once per bucket, never per
    row or column.
    """
    taken = {c.lower() for c in rows.columns} | {k.lower() for k in keys}
    over, at = (_unused(x, taken) for x in ("_over", "_bucket"))
    on = [*keys, at]
    if isinstance(position, int):
        covering = ranges.filter((F.col("left") <= position) & (F.col("right") >= position))
    else:
        # One position per header: a few rows per sheet.
        rows = rows.withColumn(over, position)
        on.append(over)
        places = rows.select(*keys, over).filter(F.col(over).isNotNull()).distinct()
        covering = ranges.join(places, list(keys)).filter(F.col(over).between(F.col("left"), F.col("right")))
    first, last = (F.floor(F.col(c) / bucket_rows) for c in ("top", "last_row"))
    lists = (
        covering.select("*", F.explode(F.sequence(first, last)).alias(at))
        .groupBy(*on).agg(F.collect_list(F.struct("top", "last_row", "value")).alias(name))
    )
    here = F.filter(name, lambda r: F.col(row).between(r.top, r.last_row))
    return (
        rows.withColumn(at, F.floor(F.col(row) / bucket_rows))
        .join(lists, on, "left")
        .withColumn(name, F.get(here, F.lit(0)))
        .select(*[c for c in rows.columns if c != over], name)
    )


def _unused(name: str, taken: set[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name


def merged_fill(cells: Column, span: Column, position: Column) -> Column:
    """Value of the cell at 0-based ``position``, taken from the top-left cell
    of its merged range (``with_span``) when it lies in one."""
    return F.when(span.isNotNull(), span.value).otherwise(F.get(cells, position))


def ffill(
    rows: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = SHEET_KEYS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Forward fill the named columns inside each sheet, in one pass."""
    filled = with_running(
        rows,
        last={f"_fill_{c}": F.col(c) for c in columns},
        keys=keys,
        block_rows=block_rows,
    )
    return filled.select(
        *[
            F.col(f"_fill_{c}").alias(c) if c in columns else F.col(c)
            for c in rows.columns
        ]
    )


def ffill_summary(
    rows: DataFrame,
    column: str,
    supplier: str | None,
    keys: Sequence[str] = SHEET_KEYS,
    null_only: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Forward fill ``column``, then empty it on summary rows.

    A summary row has a null or empty ``supplier`` (``null_only``: a null one).
    With no supplier column nothing is emptied.
    """
    filled = ffill(rows, [column], keys, block_rows)
    if supplier is None:
        return filled
    is_summary = F.col(supplier).isNull()
    if not null_only:
        is_summary = is_summary | (F.col(supplier) == "")
    return filled.withColumn(column, F.when(is_summary, F.lit("")).otherwise(F.col(column)))


def fill_nulls(df: DataFrame, numbers: bool = False) -> DataFrame:
    """Empty text for null strings; with ``numbers`` also 0 for null numbers."""
    filled = df.na.fill("")
    return filled.na.fill(0) if numbers else filled
