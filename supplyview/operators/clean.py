"""Dropping empty rows and columns, number formatting, column choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyview.functions import is_blank, plain_number_text
from supplyview.operators.segments import is_blank_row
from supplyview.schemas import SHEET_KEYS


def drop_blank_rows(rows: DataFrame, whitespace_too: bool = False) -> DataFrame:
    """Keep rows with a non-null cell; G22 (``whitespace_too``): with visible text."""
    if not whitespace_too:
        return rows.filter(~is_blank_row(F.col("cells")))
    return rows.filter(~is_blank(F.array_join("cells", "")))


def used_columns(rows: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """G20 on a grid: ``(keys, col_idx, n_values)`` of columns that hold any value."""
    return (
        rows.filter(F.col("row_idx") >= 0)
        .select(*keys, F.posexplode("cells").alias("col_idx", "_value"))
        .filter(F.col("_value").isNotNull())
        .groupBy(*keys, F.col("col_idx").cast("bigint").alias("col_idx"))
        .agg(F.count(F.lit(1)).alias("n_values"))
    )


def drop_blank_columns(df: DataFrame) -> DataFrame:
    """G20 on a wide table: a counting job first, then a plain projection. Which columns
    there are depends on the data."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] > 0])


def whole_number_format(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole double columns become bigint, others text without a final ``.0``.

    One aggregate, run right away, decides for all columns, so the types depend on the
    data; nulls stay null. ``plain_number_text`` is the same value by value.
    """
    doubles = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        and (columns is None or f.name in columns)
    ]
    if not doubles:
        return df
    whole = df.agg(
        *[
            F.every(F.coalesce(F.col(f"`{c}`") == F.floor(F.col(f"`{c}`")), F.lit(True))).alias(c)
            for c in doubles
        ]
    ).first()

    def shown(name: str) -> Column:
        c = F.col(f"`{name}`")
        if name not in doubles:
            return c
        # An empty table has no non-whole value, so it counts as whole.
        if whole[name] is not False:
            return c.cast("bigint").alias(name)
        return plain_number_text(c).alias(name)

    return df.select(*[shown(c) for c in df.columns])


def is_inventory_column(name: Column) -> Column:
    """Header names holding ``DESCRIPTION`` or ``QTY``."""
    return F.coalesce(name.contains("DESCRIPTION") | name.contains("QTY"), F.lit(False))


def inventory_columns(df: DataFrame) -> DataFrame:
    """G24 on a wide table; a table without such a column is kept as it is."""
    kept = [c for c in df.columns if "DESCRIPTION" in c or "QTY" in c]
    return df.select(*[F.col(f"`{c}`") for c in kept]) if kept else df
