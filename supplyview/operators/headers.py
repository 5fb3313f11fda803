"""Finding and using header rows.

A rule is a rank for rows, null for rows that cannot be the header; the best rank
of a sheet wins. Candidates are cut down by a filter before anything is shuffled,
and the winner is a partial aggregate, never a window over the sheet.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyview.functions import (
    is_header_text_lenient,
    is_header_text_strict,
    is_label_text,
    strip,
)
from supplyview.operators.blocks import BLOCK_ROWS, attach_facts
from supplyview.schemas import INVENTORY_COLUMNS, SHEET_KEYS, TABLE_COLUMNS

# How many rows each rule looks at.
SCORE_SCAN_ROWS = 10
REQUIRED_SCAN_ROWS = 25
PRIORITY_EXACT_SCAN_ROWS = 150
PRIORITY_TEXT_SCAN_ROWS = 200

# Worse than any rank a header rule gives.
LABEL_RANK = 1_000_000

# Anchor texts per status.
ANCHORS = {"SAILING": "CONTRACT", "LANDED": "BILL OF LADING", "PULLOUT": "BILL OF LADING"}

LOCAL_PRODUCT, LOCAL_QUANTITY = TABLE_COLUMNS["UNSERVED_LOCAL"]


def count_cells(cells: Column, rule: Callable[[Column], Column]) -> Column:
    """Number of cells of a row that satisfy ``rule``."""
    return F.size(F.filter(cells, rule)).cast("bigint")


def row_text(cells: Column) -> Column:
    """All cells as one upper-case text. A word without line breaks is in some cell
    exactly when it is in here, and no cell-by-cell function has to run."""
    return F.upper(F.array_join(cells, "\n"))


def has_cell(cells: Column, text: str) -> Column:
    """True when a stripped cell equals ``text`` exactly."""
    return F.exists(cells, lambda c: F.coalesce(strip(c) == text, F.lit(False)))


def pick_header(rows: DataFrame, rank: Column, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """The row with the lowest ``rank`` of every sheet, the earliest one on ties.

    Rows with a null rank are no candidates. They are filtered out before the
    shuffle, so only the few candidates of a sheet are compared.
    """
    candidates = rows.select(*keys, "row_idx", "cells", rank.cast("bigint").alias("rank")).filter(
        F.col("rank").isNotNull()
    )
    best = candidates.groupBy(*keys).agg(
        F.min_by(F.struct("row_idx", "cells", "rank"), F.struct("rank", "row_idx")).alias("_best")
    )
    return best.select(
        *keys,
        F.col("_best.row_idx").alias("header_row"),
        F.col("_best.cells").alias("header_cells"),
        F.col("_best.rank").alias("rank"),
    )


def score_rank(
    rule: Callable[[Column], Column] = is_header_text_strict,
    scan_rows: int = SCORE_SCAN_ROWS,
    min_score: int = 2,
    start: Column | None = None,
) -> Column:
    """Minus the number of header-like cells, within the first ``scan_rows``.

    ``start`` is the first row of a table that does not begin at row 0.
    """
    offset = F.col("row_idx") - (F.lit(0) if start is None else start)
    score = count_cells(F.col("cells"), rule)
    return F.when(
        (F.col("row_idx") >= 0) & offset.between(0, scan_rows - 1) & (score >= min_score), -score
    )


def required_rank(
    labels: Sequence[str] = INVENTORY_COLUMNS, scan_rows: int = REQUIRED_SCAN_ROWS
) -> Column:
    """Rows holding every label exactly, within the first ``scan_rows``."""
    holds = F.col("row_idx").between(0, scan_rows - 1)
    for label in labels:
        holds = holds & has_cell(F.col("cells"), label)
    return F.when(holds, 0)


def anchor_rank(anchor: str) -> Column:
    """Rows with a cell containing ``anchor``, ignoring case; no row limit."""
    return F.when((F.col("row_idx") >= 0) & row_text(F.col("cells")).contains(anchor), 0)


def priority_rank(product: str = LOCAL_PRODUCT, quantity: str = LOCAL_QUANTITY) -> Column:
    """1 names the product column, 2 has both labels, 3 has two text cells."""
    cells, row_idx = F.col("cells"), F.col("row_idx")
    # The cheap test on the whole row comes first and rules out nearly all rows.
    names_product = row_text(cells).contains(product.upper()) & F.exists(
        cells, lambda c: F.coalesce(F.upper(strip(c)) == product.upper(), F.lit(False))
    )
    both = (
        (row_idx < PRIORITY_EXACT_SCAN_ROWS) & has_cell(cells, product) & has_cell(cells, quantity)
    )
    texty = (row_idx < PRIORITY_TEXT_SCAN_ROWS) & (
        count_cells(cells, is_header_text_lenient) >= 2
    )
    return F.when(
        row_idx >= 0, F.when(names_product, 1).when(both, 2).when(texty, 3)
    )


def or_label_row(rank: Column) -> Column:
    """Without any other candidate the label row (row -1) is the header."""
    return F.coalesce(rank, F.when(F.col("row_idx") == -1, LABEL_RANK))


def header_strict(rows: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """G1, with the winning ``score``."""
    near = rows.filter(F.col("row_idx") < SCORE_SCAN_ROWS)
    found = pick_header(near, score_rank(is_header_text_strict), keys)
    return found.withColumn("score", -F.col("rank")).drop("rank")


def header_lenient(rows: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """G2, for sheets of at least two rows, with the winning ``score``."""
    near = rows.filter(F.col("row_idx") < SCORE_SCAN_ROWS)
    found = pick_header(near, score_rank(is_header_text_lenient), keys)
    long_enough = near.filter(F.col("row_idx") == 1).select(*keys)
    return (
        found.join(long_enough, list(keys), "left_semi")
        .withColumn("score", -F.col("rank"))
        .drop("rank")
    )


def header_required(rows: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """G3."""
    near = rows.filter(F.col("row_idx") < REQUIRED_SCAN_ROWS)
    return pick_header(near, required_rank(), keys).drop("rank")


def header_anchor(rows: DataFrame, anchor: str, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """G4."""
    return pick_header(rows, anchor_rank(anchor), keys).drop("rank")


def header_priority(rows: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """G5, with the ``step`` (1, 2 or 3) that decided."""
    return pick_header(rows, priority_rank(), keys).withColumnRenamed("rank", "step")


def header_names(cells: Column, base: int = 0, raw: bool = False) -> Column:
    """Stripped names, ``Column_{i}`` for blanks; later duplicates get ``_2``, ``_3``
    and so on; a numbered name that is taken already gets a further number.

    ``raw`` keeps the cell text unstripped (landed and pull-out split sheets).
    """
    named = F.transform(
        cells,
        lambda c, i: F.when(
            F.coalesce(strip(c), F.lit("")) == "",
            F.concat(F.lit("Column_"), (i + base).cast("string")),
        ).otherwise(c if raw else strip(c)),
    )

    def numbered(name: Column, i: Column) -> Column:
        seen = F.size(F.filter(F.slice(named, 1, i + 1), lambda other: other == name))
        return F.when(seen > 1, F.concat(name, F.lit("_"), seen.cast("string"))).otherwise(name)

    plain = F.transform(named, numbered)

    def free(done: Column, name: Column) -> Column:
        """The name, or with a number that no finished or plain name has."""
        tries = F.transform(
            F.sequence(F.lit(2), F.size(plain) + 1),
            lambda n: F.concat(name, F.lit("_"), n.cast("string")),
        )
        left = F.array_except(F.array_except(tries, done), plain)
        return F.when(F.array_contains(done, name), F.get(left, F.lit(0))).otherwise(name)

    # Only a name like QTY_2 beside two QTY makes a clash.
    unique = F.aggregate(
        plain,
        F.array().cast("array<string>"),
        lambda done, name: F.concat(done, F.array(free(done, name))),
    )
    return F.when(F.size(F.array_distinct(plain)) == F.size(plain), plain).otherwise(unique)


def last_rows(rows: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """Last row index of every sheet."""
    return rows.groupBy(*keys).agg(F.max("row_idx").alias("last_row"))


def promote_header(
    rows: DataFrame,
    headers: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    base: int = 0,
    raw: bool = False,
    block_rows: int = BLOCK_ROWS,
    sheet_row: bool = False,
) -> DataFrame:
    """Rows below the header with the header's names.

    ``(keys, row_idx, header array, cells)``; ``row_idx`` counts from 0 again, and on
    request ``sheet_row`` keeps the row's place in the sheet.
    """
    facts = (
        headers.select(
            *keys, "header_row", header_names(F.col("header_cells"), base, raw).alias("header")
        )
        .join(last_rows(rows, keys), list(keys))
    )
    body = attach_facts(rows, facts, keys, block_rows).filter(F.col("row_idx") > F.col("header_row"))
    if sheet_row:
        body = body.withColumn("sheet_row", F.col("row_idx"))
    return (
        body.withColumn("row_idx", F.col("row_idx") - F.col("header_row") - 1)
        .drop("header_row")
    )


def named_values(table: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """A promoted table in long form: one row per non-null named cell."""
    return (
        table.select(*keys, "row_idx", F.posexplode(F.arrays_zip("header", "cells")))
        .select(
            *keys,
            "row_idx",
            F.col("col.header").alias("column"),
            F.col("col.cells").alias("value"),
        )
        .filter(F.col("value").isNotNull() & F.col("column").isNotNull())
    )


def valid_header_cells(cells: Column) -> Column:
    """At least two non-null cells and at least two text cells."""
    return (count_cells(cells, lambda c: c.isNotNull()) >= 2) & (
        count_cells(cells, is_label_text) >= 2
    )


def _contains_all(name: Column, *words: str) -> Column:
    test = F.lit(True)
    for word in words:
        test = test & name.contains(word)
    return test


def looks_like_product(name: Column) -> Column:
    """``raw`` and ``material`` in a lower-cased header."""
    return F.coalesce(_contains_all(name, "raw", "material"), F.lit(False))


def looks_like_quantity(name: Column) -> Column:
    """``still``, ``deliver`` and ``kilo`` or ``kg`` in a lower-cased header."""
    return F.coalesce(
        _contains_all(name, "still", "deliver") & (name.contains("kilo") | name.contains("kg")),
        F.lit(False),
    )


def _put(position: Column, text: str) -> Callable[[Column, Column], Column]:
    """Replace the name at the 1-based ``position``."""
    return lambda name, i: F.when(i + 1 == position, F.lit(text)).otherwise(name)


LOCAL_LABELS = {LOCAL_PRODUCT: looks_like_product, LOCAL_QUANTITY: looks_like_quantity}


def rename_headers(
    headers: DataFrame,
    column: str = "header",
    labels: Mapping[str, Callable[[Column], Column]] | None = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rename the first matching header of each expected label.

    Order of preference: same text ignoring case, a stored alias, the fuzzy rule.
    Adds ``captured``: the (expected, alias) pairs the fuzzy rule found (G18).
    """
    labels = LOCAL_LABELS if labels is None else labels
    aliases = aliases or {}
    lowered = F.transform(F.col(column), lambda c: F.lower(strip(c)))
    renamed, captured = F.col(column), []
    for expected, fuzzy in labels.items():
        known = [a.strip().lower() for a in aliases.get(expected, ())]
        exact = F.nullif(F.array_position(lowered, expected.lower()), F.lit(0))
        by_alias = (
            F.nullif(F.array_position(F.transform(lowered, lambda c: c.isin(known)), True), F.lit(0))
            if known
            else F.lit(None).cast("bigint")
        )
        by_rule = F.nullif(F.array_position(F.transform(lowered, fuzzy), True), F.lit(0))
        position = F.coalesce(exact, by_alias, by_rule)

        renamed = F.transform(renamed, _put(position, expected))
        is_new = exact.isNull() & by_alias.isNull() & by_rule.isNotNull()
        captured.append(
            F.when(
                is_new,
                F.struct(
                    F.lit(expected).alias("expected"),
                    F.try_element_at(F.col(column), by_rule.cast("int")).alias("alias"),
                ),
            )
        )
    return headers.withColumn("captured", F.array_compact(F.array(*captured))).withColumn(
        column, renamed
    )


def captured_aliases(renamed: DataFrame, table: str) -> DataFrame:
    """The fuzzy hits as alias rows ``(table, expected, alias)``."""
    return renamed.select(F.explode("captured").alias("hit")).select(
        F.lit(table).alias("table"), "hit.expected", "hit.alias"
    )
