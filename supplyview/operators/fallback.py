"""Splitting stacked sheets by the first rule that works (G9, then G10 or G11-G13).

Each rule sees the sheets that the rules before it left. A sheet has two tables,
LANDED and PULLOUT; what a rule finds beyond the second is reported, not dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyview.operators import segments as S
from supplyview.operators.blocks import BLOCK_ROWS, attach_facts
from supplyview.operators.headers import last_rows
from supplyview.operators.routing import STACKED
from supplyview.schemas import SHEET_KEYS
from supplyview.session import stage


def first_two(
    found: DataFrame,
    lasts: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    block_rows: int = BLOCK_ROWS,
    one_is_enough: bool = False,
) -> DataFrame:
    """The first two ``(start_row, end_row)`` ranges of a sheet as its two tables.

    Two aggregates rather than a sorted list, since a sheet may have any number
    of ranges. Sheets with a single range are left out unless ``one_is_enough``.
    """
    at = found.withColumn("row_idx", F.col("start_row"))
    first = at.groupBy(*keys).agg(
        F.min("start_row").alias("landed_start"),
        F.min_by("end_row", "start_row").alias("landed_end"),
        F.max("row_idx").alias("last_row"),
    )
    later = attach_facts(at, first.select(*keys, "landed_start", "last_row"), keys, block_rows)
    second = (
        later.filter(F.col("start_row") > F.col("landed_start"))
        .groupBy(*keys)
        .agg(
            F.min("start_row").alias("pullout_start"),
            F.min_by("end_row", "start_row").alias("pullout_end"),
        )
    )
    how = "left" if one_is_enough else "inner"
    both = first.drop("last_row").join(second, list(keys), how)
    return both.join(lasts, list(keys)).select(
        *keys, "last_row", *S.RANGE
    )


def beyond_two(
    found: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(keys, start_row, end_row)`` of the third and later ranges of the split sheets."""
    at = found.withColumn("row_idx", F.col("start_row"))
    facts = ranges.select(*keys, "pullout_start", "last_row")
    return (
        attach_facts(at, facts, keys, block_rows)
        .filter(F.col("start_row") > F.col("pullout_start"))
        .select(*keys, "start_row", "end_row")
    )


def without(
    rows: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows of the sheets that have no ranges yet."""
    split = ranges.select(*keys, "last_row", F.lit(True).alias("_split"))
    left = attach_facts(rows, split, keys, block_rows, "left").filter(F.col("_split").isNull())
    return left.select(*rows.columns)


def basic_rules(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """Ranges by markers in the first column (G9), else by the first blank row."""
    marked = stage(S.first_column_ranges(rows, keys, block_rows), "marked")
    rest = without(rows, marked, keys, block_rows)
    return marked.unionByName(S.blank_row_ranges(rest, keys)), None


def advanced_rules(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Ranges by markers (G9), else table boundaries (G11), else null patterns (G12), else
    the midpoint (G13), and the tables beyond the second.

    The grid is read once: every row leaves a few bits (``segments.evidence``), staged, and
    each rule is an aggregate of them. Rules drop the sheets of the rules before by their
    ranges, not by their rows.
    """
    seen = stage(S.evidence(rows, keys, block_rows), "evidence")
    # One row per sheet: its end and its marks.
    sheets = stage(S.mark_starts(seen, keys), "sheets")
    lasts = sheets.select(*keys, "last_row")
    marked = S.mark_ranges(sheets, keys)

    def left(found: DataFrame, *chosen: DataFrame) -> DataFrame:
        at = found.withColumn("row_idx", F.col("start_row"))
        for ranges in chosen:
            at = without(at, ranges, keys, block_rows)
        return at.select(*found.columns)

    bounded = stage(left(S.boundary_ranges(seen, keys, "_table"), marked), "boundaries")
    by_bounds = first_two(bounded, lasts, keys, block_rows)
    patterned = stage(left(S.pattern_ranges(seen, keys, "_run"), marked, by_bounds), "patterns")
    by_pattern = first_two(patterned, lasts, keys, block_rows, one_is_enough=True)
    further = beyond_two(bounded, by_bounds, keys, block_rows).unionByName(
        beyond_two(patterned, by_pattern, keys, block_rows)
    )
    done = [marked, by_bounds, by_pattern]
    split = reduce(DataFrame.unionByName, [x.select(*keys) for x in done])
    open_sheets = lasts.join(split, list(keys), "left_anti")
    return reduce(DataFrame.unionByName, [*done, S.halves(seen, open_sheets, keys)]), further


def marker_rules(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """Ranges by marker cells in any column (G8) alone."""
    return S.marker_ranges(rows, keys, block_rows), None


def advanced_split(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rows of both tables by the advanced rules."""
    return S.cut_tables(rows, advanced_rules(rows, keys, block_rows)[0], keys, block_rows)


def basic_split(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rows of both tables by the basic rules."""
    return S.cut_tables(rows, basic_rules(rows, keys, block_rows)[0], keys, block_rows)


def split_rejects(
    rows: DataFrame,
    ranges: DataFrame,
    further: DataFrame | None,
    keys: Sequence[str] = SHEET_KEYS,
) -> DataFrame:
    """``(keys, table, reason)`` of stacked sheets that no rule splits, and of the
    tables beyond the second."""
    unsplit = rows.select(*keys).distinct().join(ranges.select(*keys), list(keys), "left_anti")
    out = unsplit.select(*keys, F.lit(STACKED).alias("table"), F.lit("no rule splits the sheet").alias("reason"))
    if further is None:
        return out
    beyond = further.select(
        *keys,
        F.lit(STACKED).alias("table"),
        F.concat(
            F.lit("table beyond the second: rows "), F.col("start_row").cast("string"),
            F.lit(" to "), F.col("end_row").cast("string"),
        ).alias("reason"),
    )
    return out.unionByName(beyond)
