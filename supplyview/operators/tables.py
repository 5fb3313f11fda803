"""Compositions: from routed sheets to projected tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyview.functions import is_blank, is_header_text_lenient, is_header_text_strict
from supplyview.operators import headers as H
from supplyview.operators.blocks import BLOCK_ROWS, attach_facts, with_running
from supplyview.operators.clean import drop_blank_rows, is_inventory_column
from supplyview.operators.facts import (
    fill_merged_products,
    nonempty_product,
    project_cells,
)
from supplyview.operators.fill import (
    any_merged,
    ffill_summary,
    merged_fill,
    merged_ranges,
    no_span,
    with_span,
)
from supplyview.operators.routing import locate_columns, rejects, usable
from supplyview.schemas import INVENTORY_COLUMNS, INVENTORY_STATUS, SHEET_KEYS, TABLE_COLUMNS
from supplyview.session import stage

LOCAL = "UNSERVED LOCAL"


def locate(
    rows: DataFrame,
    rank: Column,
    keys: Sequence[str],
    mapping: Mapping[str, Sequence[str]],
    base: int = 0,
    aliases: Mapping[str, Sequence[str]] | None = None,
    raw_tables: Sequence[str] = (),
) -> DataFrame:
    """Header rows by ``rank``, their names, and where the mapped columns stand
    (G6, G17, P1).

    ``keys`` end with ``table``: one header per sheet and table. A table without
    any header is kept, with a reason. ``aliases`` turns the fuzzy names on, for
    sailing and unserved local; new aliases are captured from the latter. Label rows
    and ``raw_tables`` keep their names unstripped.
    """
    found = H.pick_header(rows, rank, keys)
    is_raw = (F.col("header_row") == -1) | F.col("table").isin(*raw_tables)
    names = F.when(is_raw, H.header_names(F.col("header_cells"), base, raw=True)).otherwise(
        H.header_names(F.col("header_cells"), base)
    )
    named = (
        H.last_rows(rows, keys)
        .join(found, list(keys), "left")
        .withColumn("header", F.coalesce(names, F.array().cast("array<string>")))
    )
    if aliases is not None:
        is_local = F.col("table") == LOCAL
        renamed = H.rename_headers(named.withColumn("_names", F.col("header")), aliases=aliases)
        named = renamed.withColumns(
            {
                "header": F.when(is_local | (F.col("table") == "SAILING"), F.col("header"))
                .otherwise(F.col("_names")),
                "captured": F.when(is_local, F.col("captured")),
            }
        ).drop("_names")
    # Staged (one row per sheet): projection, rejects and aliases all read it.
    return stage(locate_columns(named, mapping), "located")


def project_tables(
    rows: DataFrame, located: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Data rows of the usable tables, projected; blank rows are gone."""
    facts = usable(located).select(
        *keys,
        "header_row",
        "last_row",
        "product_pos",
        "quantity_pos",
        "supplier_pos",
        F.size("header").alias("n_columns"),
    )
    attached = attach_facts(rows, facts, keys, block_rows).filter(
        F.col("row_idx") > F.col("header_row")
    )
    return project_cells(drop_blank_rows(attached))


def fill_products(
    projected: DataFrame,
    keys: Sequence[str],
    summary_rows: Column,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Forward fill the product, then empty it on the summary rows."""
    marked = projected.withColumn("_supplier", F.when(~summary_rows, F.lit("-")))
    return ffill_summary(
        marked, "product", "_supplier", keys, null_only=True, block_rows=block_rows
    ).drop("_supplier")


def _with_merged(projected: DataFrame, rows: DataFrame, where: Column, keys: Sequence[str]) -> DataFrame:
    ranges = merged_ranges(rows, keys) if any_merged(rows) else None
    return fill_merged_products(projected, ranges, where, keys)


def delivery_table(
    rows: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    mapping: Mapping[str, Sequence[str]] = TABLE_COLUMNS,
    lenient: bool = False,
    block_rows: int = BLOCK_ROWS,
    summary_columns: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """G28 (strict rule) and G30/G31 (``lenient``, names counted from 1).

    ``rows`` carry a ``table`` and may carry its ``start_row``. Returns (projected
    rows, rejects). Unserved local takes its product from merged cells; the older
    rules forward fill every product instead, but never a quantity, and look for
    summary rows in unserved local tables of at least ``summary_columns`` columns.
    """
    keys = [*keys, "table"]
    rule = is_header_text_lenient if lenient else is_header_text_strict
    start = F.col("start_row") if "start_row" in rows.columns else None
    rank = H.or_label_row(H.score_rank(rule, start=start))
    located = locate(rows, rank, keys, mapping, base=1 if lenient else 0)
    found = project_tables(rows, located, keys, block_rows)
    if lenient:
        wide_local = (F.col("table") == LOCAL) & (F.col("n_columns") >= summary_columns)
        summary = wide_local & F.col("has_supplier") & F.col("supplier").isNull()
        filled = fill_products(found, keys, summary, block_rows)
    else:
        filled = _with_merged(found, rows, F.col("table") == LOCAL, keys[:-1])
    return filled, rejects(located, keys[:-1])


def inventory_table(
    rows: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    fill_merged: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Inventory rows, projected; sheets without the header are rejected.

    ``fill_merged`` takes product names from merged cells (G14).
    """
    rows = rows.withColumn("table", F.lit(INVENTORY_STATUS))
    keys = [*keys, "table"]
    located = locate(rows, H.required_rank(), keys, TABLE_COLUMNS)
    projected = project_tables(rows, located, keys, block_rows)
    if fill_merged:
        projected = _with_merged(
            projected.withColumn("has_supplier", F.lit(False)), rows, F.lit(True), keys[:-1]
        )
    return projected, rejects(located, keys[:-1])


def split_tables(
    rows: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    mapping: Mapping[str, Sequence[str]] = TABLE_COLUMNS,
    aliases: Mapping[str, Sequence[str]] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The split layout's routes. Returns (projected rows, rejects, new aliases).

    Sailing, landed and pull-out find their header by anchor text, unserved
    imported has it in the label row, unserved local by priority and with fuzzy
    names; its product column is forward filled (G15).
    """
    keys = [*keys, "table"]
    table = F.col("table")
    rank = H.or_label_row(
        F.when(table == "SAILING", H.anchor_rank(H.ANCHORS["SAILING"]))
        .when(table.isin("LANDED", "PULLOUT"), H.anchor_rank(H.ANCHORS["LANDED"]))
        .when(table == LOCAL, H.priority_rank())
    )
    located = locate(
        rows, rank, keys, mapping, aliases=aliases or {}, raw_tables=("LANDED", "PULLOUT")
    )
    found = project_tables(rows, located, keys, block_rows)
    # Without a supplier column no row is a summary row.
    summary = F.col("has_supplier") & F.coalesce(F.col("supplier") == "", F.lit(True))
    # One pass: other tables carry nothing forward and keep their products.
    is_local = table == LOCAL
    local = found.withColumn("_own", F.col("product")).withColumn(
        "product", F.when(is_local, F.col("product"))
    )
    filled = fill_products(local, keys, summary, block_rows).withColumn(
        "product", F.when(is_local, F.col("product")).otherwise(F.col("_own"))
    )
    projected = nonempty_product(filled.drop("_own"))
    return projected, rejects(located, keys[:-1]), H.captured_aliases(located, "UNSERVED_LOCAL")


def promoted_tables(
    rows: DataFrame,
    rank: Column,
    keys: Sequence[str] = SHEET_KEYS,
    base: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every table with all its columns: ``(keys, table, row_idx, header, cells, span)``.

    ``span`` is the merged range a row of unserved local or inventory has in its first
    column, the only one that is filled from ranges.

    The unmapped and summary sheets too; ``finish_tables`` makes them ready for saving.
    Blank rows are dropped (G19); an unnamed sheet gets numbered column names.
    """
    keys = [*keys, "table"]
    width = F.max(F.size("cells")).alias("_width")
    facts = (
        rows.groupBy(*keys)
        .agg(F.max("row_idx").alias("last_row"), width)
        .join(H.pick_header(rows, rank, keys), list(keys), "left")
    )
    # A header row may be shorter than the widest row.
    padded = F.when(
        F.col("_width") > 0,
        F.transform(
            F.sequence(F.lit(0), F.col("_width") - 1), lambda i: F.get(F.col("header_cells"), i)
        ),
    ).otherwise(F.array().cast("array<string>"))
    facts = facts.select(
        *keys,
        "last_row",
        F.coalesce("header_row", F.lit(-2)).alias("header_row"),
        H.header_names(padded, base).alias("header"),
    )
    attached = attach_facts(rows, facts, keys, block_rows)
    body = drop_blank_rows(attached.filter(F.col("row_idx") > F.col("header_row")))
    body = body.select(*keys, "row_idx", "header", "cells")
    if not any_merged(rows):
        return body.withColumn("span", no_span())
    fillable = F.col("table").isin(LOCAL, INVENTORY_STATUS)
    spanned = with_span(body.filter(fillable), merged_ranges(rows, keys[:-1]), 0, keys[:-1])
    return spanned.unionByName(body.filter(~fillable).withColumn("span", no_span()))


def _with_cell(cells: Column, position: Column, value: Column) -> Column:
    """The cells with another value at ``position``; null or negative: unchanged."""
    return F.when(
        position >= 0,
        F.transform(
            F.concat(cells, F.array_repeat(F.lit(None).cast("string"), (position + 1 - F.size(cells)).cast("int"))),
            lambda c, i: F.when(i == position, value).otherwise(c),
        ),
    ).otherwise(cells)


def _place(name: str) -> Column:
    """0-based position of a header name, null without it."""
    return F.nullif(F.array_position(F.col("header"), name), F.lit(0)) - 1


def finish_tables(
    promoted: DataFrame,
    keys: Sequence[str] = SHEET_KEYS,
    forward_fill: bool = False,
    rename: Sequence[str] = (),
    aliases: Mapping[str, Sequence[str]] | None = None,
    fill_inventory: bool = False,
    summary_columns: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Whole tables as they are saved: ``(keys, table, row_idx, header, cells)``.

    Unserved local takes its products from merged cells (G14), or from above with
    ``forward_fill`` (G15), and loses them on summary rows. The header names of the
    ``rename`` tables get their usual spelling (G17). Inventory keeps its description
    and quantity columns (G24), blanks for nulls (G21) and its visible rows (G22).
    """
    by = [*keys, "table"]
    named = promoted
    if rename:
        usual = H.rename_headers(
            named.withColumn("_header", F.col("header")), aliases=aliases or {}
        )
        named = usual.withColumn(
            "header", F.when(F.col("table").isin(*rename), F.col("header")).otherwise(F.col("_header"))
        ).drop("_header", "captured")
    local = F.col("table") == LOCAL
    stock = F.col("table") == INVENTORY_STATUS
    placed = named.withColumns({
        "_product": F.when(local, _place(H.LOCAL_PRODUCT))
        .when(stock & F.lit(fill_inventory), _place(INVENTORY_COLUMNS[0])),
        "_supplier": F.when(local, _place("SUPPLIER")),
    })
    own = F.get("cells", F.col("_product"))
    first = F.col("_product") == 0
    if forward_fill:
        above = with_running(
            placed.withColumn("_seen", F.when(local, own)),
            last={"_filled": F.col("_seen")}, keys=by, block_rows=block_rows,
        ).drop("_seen")
    else:
        above = placed.withColumn("_filled", own)
    merged = F.when(first, merged_fill(F.col("cells"), F.col("span"), F.col("_product"))).otherwise(own)
    filled = F.when(local & F.lit(forward_fill), F.col("_filled")).otherwise(merged)
    wide_enough = F.size("header") >= summary_columns
    summary = (
        local & wide_enough & (F.col("_supplier") >= 0)
        & (F.coalesce(F.get("cells", F.col("_supplier")), F.lit("")) == "")
        & (F.lit(forward_fill) | first)
    )
    product = F.when(summary, F.lit("")).otherwise(filled)
    done = above.withColumn("cells", _with_cell(F.col("cells"), F.col("_product"), product))
    kept = F.filter(
        F.transform(F.col("header"), lambda h, i: F.when(is_inventory_column(h), i)),
        lambda i: i.isNotNull(),
    )
    chosen = stock & (F.size(kept) > 0)
    narrowed = done.withColumns({
        "cells": F.when(
            chosen, F.transform(kept, lambda i: F.coalesce(F.get("cells", i), F.lit("")))
        ).when(stock, F.transform("cells", lambda c: F.coalesce(c, F.lit("")))).otherwise(F.col("cells")),
        "header": F.when(chosen, F.transform(kept, lambda i: F.get("header", i))).otherwise(F.col("header")),
    })
    visible = ~stock | ~is_blank(F.array_join("cells", ""))
    return narrowed.filter(visible).select(*by, "row_idx", "header", "cells")
