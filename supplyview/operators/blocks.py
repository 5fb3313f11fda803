"""Ordered operators over sheets that stay parallel when one sheet is huge.

A window partitioned by sheet puts a whole sheet into one task. Here every sheet
is cut into blocks of ``block_rows`` consecutive ``row_idx`` values; windows run
inside ``(sheet, block)`` and only one summary row per block crosses block
borders. A smaller sheet is a single block, so it costs what a plain window costs.

All functions need ``row_idx`` to be dense inside a sheet (blank rows included),
which the sources guarantee.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyview.schemas import SHEET_KEYS

# As many rows as one spreadsheet can hold: only larger grids have a second block.
BLOCK_ROWS = 1_048_576
BLOCK = "_block"


def block_of(row_idx: Column, block_rows: int) -> Column:
    """Block number of a row; the label row -1 belongs to block 0."""
    return F.floor(F.greatest(row_idx, F.lit(0)) / F.lit(block_rows)).cast("bigint")


def attach_facts(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    block_rows: int = BLOCK_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Join per-sheet ``facts`` (with a ``last_row`` column) onto the sheet's rows.

    The fact row is repeated once per block, so the join key is (sheet, block)
    and no task holds more than ``block_rows`` rows of one sheet. There is no
    broadcast hint: the number of sheets grows with the data, so Spark's own size
    threshold decides.
    """
    per_block = facts.withColumn(
        BLOCK, F.explode(F.sequence(F.lit(0), block_of(F.col("last_row"), block_rows)))
    ).drop("last_row")
    return (
        rows.withColumn(BLOCK, block_of(F.col("row_idx"), block_rows))
        .join(per_block, [*keys, BLOCK], how)
        .drop(BLOCK)
    )


def with_neighbours(
    rows: DataFrame,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    keys: Sequence[str] = SHEET_KEYS,
    block_rows: int = BLOCK_ROWS,
    keep_block: bool = False,
) -> DataFrame:
    """Add columns of the previous / following row under new names (new -> column).

    Rows at a block border are also sent to the neighbouring block, so a single
    shuffle by (sheet, block) is enough. All columns of ``rows`` are shuffled:
    pass only those needed. ``keep_block`` leaves the block number in place, which
    spares ``with_running`` its own shuffle.
    """
    previous, following = dict(previous or {}), dict(following or {})
    own = block_of(F.col("row_idx"), block_rows)
    offset = F.pmod(F.col("row_idx"), F.lit(block_rows))
    inner_edge = F.col("row_idx") >= 0
    visible = [own]
    if previous:
        visible.append(F.when(inner_edge & (offset == block_rows - 1), own + 1))
    if following:
        visible.append(F.when(inner_edge & (offset == 0) & (own > 0), own - 1))
    shown = rows.withColumn(BLOCK, F.explode(F.array(*visible))).filter(F.col(BLOCK).isNotNull())
    w = Window.partitionBy(*keys, BLOCK).orderBy("row_idx")
    both = shown.select(
        "*",
        *[F.lag(c).over(w).alias(name) for name, c in previous.items()],
        *[F.lead(c).over(w).alias(name) for name, c in following.items()],
    ).filter(block_of(F.col("row_idx"), block_rows) == F.col(BLOCK))
    return both if keep_block else both.drop(BLOCK)


def with_running(
    rows: DataFrame,
    last: Mapping[str, Column] | None = None,
    total: Mapping[str, Column] | None = None,
    keys: Sequence[str] = SHEET_KEYS,
    block_rows: int = BLOCK_ROWS,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add running columns over all rows of the sheet up to and including this one.

    ``last``: last non-null value so far (forward fill). ``total``: running sum.
    ``source``: the sheets' rows before any windows, to find the large sheets by a
    plain filter; ``rows`` itself by default.
    """
    last, total = dict(last or {}), dict(total or {})
    if BLOCK not in rows.columns:
        rows = rows.withColumn(BLOCK, block_of(F.col("row_idx"), block_rows))
    w = (
        Window.partitionBy(*keys, BLOCK)
        .orderBy("row_idx")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.select(
        "*",
        *[F.last(c, ignorenulls=True).over(w).alias(n) for n, c in last.items()],
        *[F.sum(c).over(w).alias(n) for n, c in total.items()],
    )
    carried = _carried(
        rows, _large_blocks(rows if source is None else source, keys, block_rows), last, total, keys
    )
    joined = local.join(carried, [*keys, BLOCK], "left")
    kept = [c for c in local.columns if c not in (BLOCK, *last, *total)]
    return joined.select(
        *kept,
        *[F.coalesce(F.col(n), F.col(f"_carry_{n}")).alias(n) for n in last],
        *[
            (F.col(n) + F.coalesce(F.col(f"_carry_{n}"), F.lit(0))).alias(n)
            for n in total
        ],
    )


def _large_blocks(rows: DataFrame, keys: Sequence[str], block_rows: int) -> DataFrame:
    """(keys, block) of all sheets with more than one block, one row each."""
    row_idx = F.col("row_idx")
    later = rows.filter((row_idx >= block_rows) & (F.pmod(row_idx, F.lit(block_rows)) == 0))
    own, zero = block_of(row_idx, block_rows), F.lit(0).cast("bigint")
    # The second block also tells of the first.
    both = F.when(row_idx == block_rows, F.array(zero, own)).otherwise(F.array(own))
    return later.select(*keys, F.explode(both).alias(BLOCK))


def _carried(
    rows: DataFrame,
    large: DataFrame,
    last: Mapping[str, Column],
    total: Mapping[str, Column],
    keys: Sequence[str],
) -> DataFrame:
    """What every later block takes over from the blocks before it, one row per block.

    Only the blocks of ``large`` sheets take part. Both sides are keyed by (sheet,
    block) like the windows, so no task holds a sheet; without large sheets Spark
    drops this whole branch at run time.
    """
    handed_on = (
        rows.join(large, [*keys, BLOCK], "left_semi")
        .groupBy(*keys, BLOCK)
        .agg(
            *[
                F.max_by(c, F.when(c.isNotNull(), F.col("row_idx"))).alias(n)
                for n, c in last.items()
            ],
            *[F.sum(c).alias(n) for n, c in total.items()],
        )
    )
    before = (
        Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    return handed_on.select(
        *keys,
        BLOCK,
        *[F.last(n, ignorenulls=True).over(before).alias(f"_carry_{n}") for n in last],
        *[F.sum(n).over(before).alias(f"_carry_{n}") for n in total],
    ).filter(F.col(BLOCK) > 0)
