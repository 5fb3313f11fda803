"""Splitting one sheet into several tables.

Every splitter first works out the row ranges of a sheet's tables, one small row
per sheet; only ``cut_tables`` then moves whole rows. Per-sheet decisions are
partial aggregates over the few marker rows; row-to-row comparisons and running
numbers use the block helpers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyview.functions import lenient_double
from supplyview.operators.blocks import (
    BLOCK,
    BLOCK_ROWS,
    attach_facts,
    with_neighbours,
    with_running,
)
from supplyview.operators.headers import last_rows, row_text, valid_header_cells
from supplyview.schemas import SHEET_KEYS

LANDED, PULLOUT = "LANDED", "PULLOUT"
RANGE = ("landed_start", "landed_end", "pullout_start", "pullout_end")


def is_blank_row(cells: Column) -> Column:
    """True when every cell is null (``array_max`` skips nulls and is compiled code)."""
    return F.array_max(cells).isNull()


def trim_row(cells: Column) -> Column:
    """Drop trailing nulls, so rows of different stored width compare equal."""
    positions = F.transform(cells, lambda c, i: F.when(c.isNotNull(), i + 1).otherwise(0))
    return F.slice(cells, 1, F.coalesce(F.array_max(positions), F.lit(0)))


def _body(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("row_idx") >= 0)


def marker_kind(cells: Column) -> Column:
    """``LANDED`` or ``PULLOUT`` by the first marker cell of a row, else null.

    Cell by cell only where the row mentions a marker word at all.
    """
    text = row_text(cells)
    mentioned = text.contains("LANDED") | text.contains("PULL")

    def kind(cell: Column, i: Column) -> Column:
        titled = (i == 0) | cell.contains("HEADER") | cell.contains("TABLE")
        return F.when(cell.contains("LANDED") & titled, LANDED).when(
            cell.contains("PULL") & titled, PULLOUT
        )

    uppercase = F.transform(cells, lambda c: F.upper(c))
    kinds = F.array_compact(F.transform(uppercase, kind))
    return F.when(mentioned, F.get(kinds, F.lit(0)))


def marker_starts(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(keys, landed_start, pullout_start)`` of sheets with a usable split.

    The scan stops at the first row where both kinds were seen; before that a
    later marker replaces an earlier one of its kind.
    """
    markers = (
        _body(rows)
        .select(*keys, "row_idx", marker_kind(F.col("cells")).alias("kind"))
        .filter(F.col("kind").isNotNull())
    )
    is_landed, is_pullout = F.col("kind") == LANDED, F.col("kind") == PULLOUT
    row_idx = F.col("row_idx")
    # Null when one kind is missing: then there is no stop and the last hit counts.
    stops = markers.groupBy(*keys).agg(
        F.min(F.when(is_landed, row_idx)).alias("_landed"),
        F.min(F.when(is_pullout, row_idx)).alias("_pullout"),
        F.max("row_idx").alias("last_row"),
    ).select(
        *keys,
        "last_row",
        F.when(
            F.col("_landed").isNotNull() & F.col("_pullout").isNotNull(),
            F.greatest("_landed", "_pullout"),
        ).alias("stop"),
    )
    seen = F.col("stop").isNull() | (row_idx <= F.col("stop"))
    starts = (
        attach_facts(markers, stops, keys, block_rows)
        .groupBy(*keys)
        .agg(
            (F.max(F.when(seen & is_landed, row_idx)) + 1).alias("landed_start"),
            (F.max(F.when(seen & is_pullout, row_idx)) + 1).alias("pullout_start"),
        )
    )
    return starts.withColumn(
        "landed_start", F.coalesce("landed_start", F.lit(0))
    ).filter(F.col("pullout_start") > F.col("landed_start"))


def cut_tables(
    rows: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows of both tables, tagged with ``table`` and its ``start_row``.

    ``ranges``: ``(keys, last_row, landed_start, landed_end, pullout_start,
    pullout_end)``, one row per sheet, ends included; a null start is no table.
    This is the only step of a split that touches whole rows.
    """
    row_idx = F.col("row_idx")
    in_landed = row_idx.between(F.col("landed_start"), F.col("landed_end"))
    in_pullout = row_idx.between(F.col("pullout_start"), F.col("pullout_end"))
    table = F.when(in_landed, LANDED).when(in_pullout, PULLOUT)
    start = F.when(in_landed, F.col("landed_start")).otherwise(F.col("pullout_start"))
    return (
        attach_facts(_body(rows), ranges.select(*keys, "last_row", *RANGE), keys, block_rows)
        .withColumn("table", table)
        .filter(F.col("table").isNotNull())
        .withColumn("start_row", start)
        .select(*keys, "table", "start_row", *[c for c in rows.columns if c not in keys])
    )


def _ranges(
    facts: DataFrame,
    keys: Sequence[str],
    landed: tuple[Column, Column],
    pullout: tuple[Column, Column],
) -> DataFrame:
    bounds = [c.cast("bigint") for c in (*landed, *pullout)]
    return facts.select(*keys, "last_row", *[c.alias(n) for c, n in zip(bounds, RANGE)])


def marker_ranges(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """G8 as ranges; sheets without a usable split are absent."""
    facts = marker_starts(rows, keys, block_rows).join(last_rows(_body(rows), keys), list(keys))
    landed, pullout = F.col("landed_start"), F.col("pullout_start")
    return _ranges(facts, keys, (landed, pullout - 2), (pullout, F.col("last_row")))


def split_markers(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Two stacked tables told apart by marker cells in any column."""
    return cut_tables(rows, marker_ranges(rows, keys, block_rows), keys, block_rows)


def first_column_ranges(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """G9 as ranges: tables start below the first marker of their kind that stands in
    the first column above valid headers (G7), in either order."""
    landed, pullout = first_column_marks(F.col("cells"))
    narrow = _body(rows).select(
        *keys,
        "row_idx",
        landed.alias("_landed"),
        pullout.alias("_pullout"),
        valid_header_cells(F.col("cells")).alias("_valid"),
    )
    hits = with_neighbours(
        narrow, following={"_next_valid": "_valid"}, keys=keys, block_rows=block_rows
    ).filter(F.col("_next_valid") & (F.col("_landed") | F.col("_pullout")))
    return mark_ranges(mark_starts(hits, keys).drop("last_row").join(last_rows(_body(rows), keys), list(keys)), keys)


def first_column_marks(cells: Column) -> tuple[Column, Column]:
    """Whether the first cell names the landed and the pull-out table."""
    text = F.upper(F.get(cells, F.lit(0)))
    return tuple(F.coalesce(text.contains(word), F.lit(False)) for word in ("LANDED", "FOR PULL-OUT"))


def mark_starts(rows: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """(keys, last_row, landed, pullout): the first rows below marks (``_landed``,
    ``_pullout``) of each kind, null without."""
    return rows.groupBy(*keys).agg(
        F.max("row_idx").alias("last_row"),
        (F.min(F.when(F.col("_landed"), F.col("row_idx"))) + 1).alias("landed"),
        (F.min(F.when(F.col("_pullout"), F.col("row_idx"))) + 1).alias("pullout"),
    )


def mark_ranges(starts: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """G9 from ``mark_starts``; sheets without any mark are absent."""
    facts = starts.filter(F.col("landed").isNotNull() | F.col("pullout").isNotNull())
    landed, pullout, last = F.col("landed"), F.col("pullout"), F.col("last_row")
    # A table ends above the other table's marker row when that one comes later.
    landed_end = F.when(landed < pullout, pullout - 2).otherwise(last)
    pullout_end = F.when(pullout <= landed, landed - 2).otherwise(last)
    return _ranges(facts, keys, (landed, landed_end), (pullout, pullout_end))


def split_first_col(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Stacked tables in either order; with one marker the other table is empty."""
    return cut_tables(rows, first_column_ranges(rows, keys, block_rows), keys, block_rows)


def blank_row_ranges(rows: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """G10 as ranges: the first blank row parts the tables; without one all is table 1."""
    facts = _body(rows).groupBy(*keys).agg(
        F.min(F.when(is_blank_row(F.col("cells")), F.col("row_idx"))).alias("_blank"),
        F.max("row_idx").alias("last_row"),
    )
    blank, last = F.col("_blank"), F.col("last_row")
    return _ranges(
        facts, keys, (F.lit(0), F.coalesce(blank - 1, last)), (blank + 1, last)
    )


def split_blank_row(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """G10."""
    return cut_tables(rows, blank_row_ranges(rows, keys), keys, block_rows)


def table_boundaries(
    rows: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    legacy: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(keys, start_row, end_row)`` of the tables between separator rows.

    Separators are blank rows and rows equal to the row below. Tables are the
    runs of other rows. ``legacy`` keeps the older rule, where in a run of
    separators every second one is inert and opens the next table.
    """
    body = _body(rows).select(*keys, "row_idx", trim_row(F.col("cells")).alias("cells"))
    flagged = with_neighbours(
        body, following={"_next": "cells"}, keys=keys, block_rows=block_rows, keep_block=True
    ).select(
        *keys,
        BLOCK,
        "row_idx",
        (
            (F.size("cells") == 0)
            | F.coalesce((F.size("_next") > 0) & (F.col("cells") == F.col("_next")), F.lit(False))
        ).alias("_sep"),
    )
    if legacy:
        run = with_running(
            flagged,
            last={"_before": F.when(~F.col("_sep"), F.col("row_idx"))},
            keys=keys,
            block_rows=block_rows,
            source=rows,
        )
        offset = F.col("row_idx") - F.coalesce(F.col("_before") + 1, F.lit(0))
        odd = F.pmod(offset, F.lit(2)) == 1
        opens_sheet = F.col("_before").isNull()
        flagged = run.select(
            *keys,
            "row_idx",
            (F.col("_sep") & F.when(opens_sheet, odd).otherwise(~odd)).alias("_sep"),
        )
    numbered = with_running(
        flagged,
        total={"_segment": F.col("_sep").cast("bigint")},
        keys=keys,
        block_rows=block_rows,
        source=rows,
    )
    return boundary_ranges(numbered, keys)


def boundary_ranges(numbered: DataFrame, keys: Sequence[str] = SHEET_KEYS, segment: str = "_segment") -> DataFrame:
    """G11 from rows with ``_sep`` and the number of separators so far."""
    row_idx = F.when(~F.col("_sep"), F.col("row_idx"))
    found = numbered.groupBy(*keys, segment).agg(
        F.min(row_idx).alias("start_row"),
        F.max(row_idx).alias("end_row"),
        F.max("row_idx").alias("_last"),
    )
    # A sheet of separators only is one table.
    only = (
        found.groupBy(*keys)
        .agg(F.max("start_row").alias("_any"), F.max("_last").alias("end_row"))
        .filter(F.col("_any").isNull())
        .select(*keys, F.lit(0).cast("bigint").alias("start_row"), "end_row")
    )
    return (
        found.filter(F.col("start_row").isNotNull())
        .select(*keys, "start_row", "end_row")
        .unionByName(only)
    )


def null_pattern(trimmed: Column) -> Column:
    """Which cells of a trimmed row are null, as text; '' for a blank row."""
    return F.array_join(F.transform(trimmed, lambda c: F.when(c.isNull(), "-").otherwise("x")), "")


def null_pattern_segments(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Runs of rows with the same non-null columns; blank runs are dropped.

    ``(keys, start_row, end_row)``; sheets without any change give nothing (G13).
    """
    body = _body(rows).select(*keys, "row_idx", null_pattern(trim_row(F.col("cells"))).alias("_pattern"))
    flagged = with_neighbours(
        body, previous={"_previous": "_pattern"}, keys=keys, block_rows=block_rows, keep_block=True
    ).select(
        *keys,
        BLOCK,
        "row_idx",
        (F.col("_pattern") == "").alias("_blank"),
        F.coalesce(F.col("_pattern") != F.col("_previous"), F.lit(False)).alias("_change"),
    )
    numbered = with_running(
        flagged,
        total={"_segment": F.col("_change").cast("bigint")},
        keys=keys,
        block_rows=block_rows,
        source=rows,
    )
    return pattern_ranges(numbered, keys)


def pattern_ranges(numbered: DataFrame, keys: Sequence[str] = SHEET_KEYS, segment: str = "_segment") -> DataFrame:
    """G12 from rows with ``_change``, ``_blank`` and the number of changes so far."""
    # The first changed row also tells segment 0 that it is not the whole sheet.
    tells = F.when(F.col("_change") & (F.col(segment) == 1), F.lit(0).cast("bigint"))
    told = numbered.withColumn("_to", F.explode(F.array(segment, tells))).filter(
        F.col("_to").isNotNull()
    )
    own = F.col("_to") == F.col(segment)
    runs = told.groupBy(*keys, "_to").agg(
        F.min(F.when(own, F.col("row_idx"))).alias("start_row"),
        F.max(F.when(own, F.col("row_idx"))).alias("end_row"),
        F.every(~own | F.col("_blank")).alias("_blank"),
        F.max(~own).alias("_followed"),
    )
    return runs.filter(~F.col("_blank") & ((F.col("_to") > 0) | F.col("_followed"))).select(
        *keys, "start_row", "end_row"
    )


def text_kinds(cells: Column) -> Column:
    """A letter per cell: t for text, . for numbers and nulls."""
    is_text = lambda c: c.isNotNull() & lenient_double(c).isNull()
    return F.array_join(F.transform(cells, lambda c: F.when(is_text(c), "t").otherwise(".")), "")


def midpoint_ranges(rows: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """G13 as ranges: halves of the sheets with a number column and a text column."""
    body = _body(rows)
    kinds = body.select(*keys, text_kinds(F.col("cells")).alias("_kinds"))
    return halves(kinds, last_rows(body, keys), keys)


def halves(kinds: DataFrame, lasts: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """G13 from the kinds of the rows' cells (``_kinds``) and the sheets' last rows."""
    # Rows of the same kinds say the same; there are few of them in a sheet.
    columns = (
        kinds.select(*keys, "_kinds").distinct()
        .select(*keys, F.posexplode(F.split("_kinds", "")).alias("col_idx", "_kind"))
        .filter("_kind <> ''")
        .groupBy(*keys, "col_idx")
        .agg(F.max((F.col("_kind") == "t").cast("int")).alias("_text"))
        .groupBy(*keys)
        .agg(F.max("_text").alias("_has_text"), F.min("_text").alias("_all_text"))
        .filter("_has_text = 1 and _all_text = 0")
        .select(*keys)
    )
    facts = lasts.join(columns, list(keys), "left_semi")
    half, last = F.floor((F.col("last_row") + 1) / 2), F.col("last_row")
    return _ranges(facts, keys, (F.lit(0), half - 1), (half, last))


def evidence(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """What rules G9 and G11 to G13 need of every row, in one pass and one shuffle of the rows.

    ``(keys, row_idx, _sep, _change, _blank, _landed, _pullout, _kinds, _table, _run)``: a few
    bits per row, with the numbers of separators and of pattern changes so far; the marks are
    null but for rows above a valid header. Every rule is an aggregate of these by sheet.
    """
    own = with_neighbours(
        _body(rows).select(*keys, "row_idx", "cells"),
        previous={"_before": "cells"}, following={"_next": "cells"},
        keys=keys, block_rows=block_rows, keep_block=True,
    )
    here, before, below = (trim_row(F.col(c)) for c in ("cells", "_before", "_next"))
    landed, pullout = first_column_marks(F.col("cells"))
    marks = F.coalesce(valid_header_cells(F.col("_next")), F.lit(False)) & (landed | pullout)
    flagged = own.select(
        *keys,
        BLOCK,
        "row_idx",
        (
            is_blank_row(F.col("cells"))
            | F.coalesce(~is_blank_row(F.col("_next")) & (here == below), F.lit(False))
        ).alias("_sep"),
        F.coalesce(null_pattern(here) != null_pattern(before), F.lit(False)).alias("_change"),
        is_blank_row(F.col("cells")).alias("_blank"),
        F.when(marks, landed).alias("_landed"),
        F.when(marks, pullout).alias("_pullout"),
        text_kinds(F.col("cells")).alias("_kinds"),
    )
    return with_running(
        flagged,
        total={"_table": F.col("_sep").cast("bigint"), "_run": F.col("_change").cast("bigint")},
        keys=keys,
        block_rows=block_rows,
        source=rows,
    )


def midpoint_split(
    rows: DataFrame, keys: Sequence[str] = SHEET_KEYS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """G13."""
    return cut_tables(rows, midpoint_ranges(rows, keys), keys, block_rows)
