"""The reporting run: rows of all sheets to fact, pivots and quality reports.

One plan covers every date, workbook and sheet at once. What several results read (the
routed rows, split tables, dimension, usage, fact and its sums) is staged while the
run is set up; the results themselves are lazy. ``supplyview.report`` runs, writes
everything and removes the staged tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyview.functions import is_header_text_lenient, is_header_text_strict
from supplyview.operators import dimension as D
from supplyview.operators import facts as P
from supplyview.operators import headers as H
from supplyview.operators import pivot as V
from supplyview.operators import quality as Q
from supplyview.operators import routing as R
from supplyview.operators import tables as G
from supplyview.operators import usage as U
from supplyview.operators.blocks import BLOCK_ROWS
from supplyview.operators.fallback import (
    advanced_rules,
    basic_rules,
    marker_rules,
    split_rejects,
)
from supplyview.operators.segments import cut_tables
from supplyview.schemas import (
    ACKNOWLEDGED,
    ALIASES,
    DIMENSION,
    INVENTORY_STATUS,
    SHEET_KEYS,
    TABLE_COLUMNS,
    USAGE_STATUS,
)
from supplyview.session import run_folder, stage
from supplyview.sinks import write_results
from supplyview.sinks.store import Store, Version
from supplyview.sources.files import (
    alias_dict,
    mapping_dict,
    read_aliases,
    read_dimension,
    read_mapping,
    read_usage,
)
from supplyview.sources.workbook import scan_workbooks, sheet_rows, unreadable

LAYOUTS = ("combined", "split", "sheets", "sheets_advanced")


@dataclass(frozen=True)
class Options:
    """What a run does differently from the default.

    ``layout``: one delivery workbook (combined), imports plus local workbooks
    (split), or the older sheet-only rules (sheets, sheets_advanced).
    ``usage_mode``: usage already monthly, or annual with fuzzy ingredient names.
    ``fill_inventory``: take inventory product names from merged cells.
    ``all_inventory_sheets``: count every sheet of an inventory workbook, not the first alone.
    ``summary_columns``: the older layouts look for summary rows in unserved local
    tables of at least so many columns.
    """

    layout: str = "combined"
    usage_mode: str = "monthly"
    legacy_units: bool = False
    legacy_zero_total: bool = False
    fill_inventory: bool = False
    all_inventory_sheets: bool = False
    summary_columns: int = 0
    mapping: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(TABLE_COLUMNS))
    aliases: Mapping[str, Sequence[str]] = field(default_factory=dict)
    block_rows: int = BLOCK_ROWS


@dataclass(frozen=True)
class Tables:
    """Projected rows of every table, the sheets left out, and new header aliases."""

    projected: DataFrame
    rejects: DataFrame
    aliases: DataFrame


@dataclass(frozen=True)
class Results:
    fact: DataFrame
    rejects: DataFrame
    aliases: DataFrame
    new_products: DataFrame
    blank_category_products: DataFrame
    dimension: DataFrame
    sums: DataFrame
    pivot: DataFrame
    enhanced_pivot: DataFrame
    status_counts: DataFrame
    category_counts: DataFrame
    na_products: DataFrame
    tables: DataFrame | None = None


def route(rows: DataFrame, options: Options = Options()) -> DataFrame:
    """Add ``table``, null for rows no table takes.

    Done before staging, so the name rules run once per row and later scans
    filter on a plain column.
    """
    if options.layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    sheet, workbook = F.col("sheet"), F.col("workbook")
    if options.layout.startswith("sheets"):
        return rows.withColumn("table", R.route_named(sheet))
    delivery = (
        R.route_split(workbook, sheet)
        if options.layout == "split"
        else R.route_combined(sheet)
    )
    is_inventory = F.lower(workbook).contains("inventory")
    return rows.withColumn("table", F.when(is_inventory, INVENTORY_STATUS).otherwise(delivery))


def _unstacked(routed: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """Delivery rows with the ``start_row`` of their table, stacked sheets split in two,
    and the rejects of the split.

    Only the split rows are staged; the others are read where they are.
    """
    left_out = (INVENTORY_STATUS, R.SUMMARY, R.OTHER, R.STACKED)
    plain = routed.filter(~F.col("table").isin(*left_out)).withColumn(
        "start_row", F.lit(0).cast("bigint")
    )
    stacked = routed.filter(F.col("table") == R.STACKED).drop("table")
    rules = {
        "combined": marker_rules,
        "sheets": basic_rules,
        "sheets_advanced": advanced_rules,
    }[options.layout]
    ranges, further = rules(stacked, SHEET_KEYS, options.block_rows)
    ranges = stage(ranges, "ranges")
    parts = stage(cut_tables(stacked, ranges, SHEET_KEYS, options.block_rows), "tables")
    return plain.unionByName(parts), split_rejects(stacked, ranges, further, SHEET_KEYS)


def _inventory_rows(routed: DataFrame, options: Options) -> DataFrame:
    """Rows of the first sheet of each inventory workbook, or of all sheets."""
    rows = routed.filter(F.col("table") == INVENTORY_STATUS)
    if options.all_inventory_sheets or "sheet_pos" not in routed.columns:
        return rows
    return rows.filter(F.col("sheet_pos") == 0)


def tables(rows: DataFrame, options: Options = Options()) -> Tables:
    """Every table of every sheet, projected to product and quantity text.

    ``rows`` are read several times, so they should be staged; they are routed
    here unless they already are.
    """
    routed = rows if "table" in rows.columns else route(rows, options)
    if options.layout == "split":
        delivered, rejected, found = G.split_tables(
            routed.filter(F.col("table") != INVENTORY_STATUS),
            SHEET_KEYS,
            options.mapping,
            options.aliases,
            options.block_rows,
        )
    else:
        unstacked, unsplit = _unstacked(routed, options)
        delivered, rejected = G.delivery_table(
            unstacked,
            SHEET_KEYS,
            options.mapping,
            lenient=options.layout != "combined",
            block_rows=options.block_rows,
            summary_columns=options.summary_columns,
        )
        rejected = rejected.unionByName(unsplit)
        found = rows.sparkSession.createDataFrame([], ALIASES)
    if options.layout.startswith("sheets"):
        return Tables(delivered, rejected, found)
    stocked, missing = G.inventory_table(
        _inventory_rows(routed, options),
        SHEET_KEYS,
        options.fill_inventory,
        options.block_rows,
    )
    return Tables(
        delivered.unionByName(stocked, allowMissingColumns=True),
        rejected.unionByName(missing),
        found,
    )


def whole_tables(rows: DataFrame, options: Options = Options()) -> DataFrame:
    """Every table with all its columns, blank rows dropped.

    Summary sheets are included and sheets of no known table are only cleaned.
    """
    return _promoted(rows, options)


def finished_tables(rows: DataFrame, options: Options = Options()) -> DataFrame:
    """Every table as it is saved (K1) and profiled (A11): ``whole_tables`` with merged or
    missing products filled, local names in their usual spelling, and of the
    inventory only descriptions and quantities."""
    return G.finish_tables(
        _promoted(rows, options),
        SHEET_KEYS,
        forward_fill=options.layout != "combined",
        rename=("SAILING", G.LOCAL) if options.layout == "split" else (),
        aliases=options.aliases,
        fill_inventory=options.fill_inventory,
        summary_columns=options.summary_columns if options.layout.startswith("sheets") else 0,
        block_rows=options.block_rows,
    )


def _promoted(rows: DataFrame, options: Options) -> DataFrame:
    routed = rows if "table" in rows.columns else route(rows, options)
    if not options.all_inventory_sheets and "sheet_pos" in routed.columns:
        is_stock = F.coalesce(F.col("table") == INVENTORY_STATUS, F.lit(False))
        routed = routed.filter(~is_stock | (F.col("sheet_pos") == 0))
    lenient = options.layout.startswith("sheets")
    table = F.col("table")
    if options.layout == "split":
        split = routed.filter(table.isNotNull()).withColumn(
            "start_row", F.lit(0).cast("bigint")
        )
    else:
        aside = routed.filter(table.isin(INVENTORY_STATUS, R.SUMMARY, R.OTHER)).withColumn(
            "start_row", F.lit(0).cast("bigint")
        )
        split = _unstacked(routed, options)[0].unionByName(aside)
    scored = H.score_rank(
        is_header_text_lenient if lenient else is_header_text_strict, start=F.col("start_row")
    )
    by_table = F.when(table == INVENTORY_STATUS, H.required_rank())
    if options.layout == "split":
        by_table = (
            by_table.when(table == "SAILING", H.anchor_rank(H.ANCHORS["SAILING"]))
            .when(table.isin("LANDED", "PULLOUT"), H.anchor_rank(H.ANCHORS["LANDED"]))
            .when(table == G.LOCAL, H.priority_rank())
        )
    else:
        by_table = by_table.when(table != R.OTHER, scored)
    return G.promoted_tables(
        split, H.or_label_row(by_table), SHEET_KEYS, 1 if lenient else 0, options.block_rows
    )


def combine(
    projected: DataFrame, dim: DataFrame, usage: DataFrame | None, options: Options = Options()
) -> DataFrame:
    """The fact: quantities in tons with status and category, usage rows included."""
    measured = P.quantity_fact(projected, options.legacy_units).select(
        "ingest_date", "product", "quantity", "status"
    )
    parts = [P.category_lookup(measured, dim)]
    if usage is not None:
        parts.append(U.usage_fact(usage, dim))
    return P.combine(parts)


def reports(
    fact: DataFrame,
    dim: DataFrame,
    usage: DataFrame | None = None,
    options: Options = Options(),
    rejects: DataFrame | None = None,
    aliases: DataFrame | None = None,
) -> Results:
    """Pivots per date and the quality reports of a fact.

    The fact is summed by date, product, status and category once; all reports but
    the fact itself read these sums, which carry their number of rows.
    """
    by_date = ["ingest_date"]
    products = stage(V.product_sums(fact, by_date), "sums")
    sums = V.category_status_sums(products, by_date)
    per_category = None
    extended = dim
    if options.usage_mode == "annual_fuzzy" and usage is not None:
        mapping = U.ingredient_map_fuzzy(usage, dim, by_date)
        extended = D.append_products(dim, U.new_ingredients(mapping, dim), ACKNOWLEDGED)
        labelled = products.filter(~P.is_acknowledged(F.col("category"))).withColumn(
            "category", V.category_label(F.col("category"))
        )
        per_category = U.usage_by_category_fuzzy(labelled, usage, mapping, keys=by_date)
    added = D.new_products(products, extended)
    statuses = V.statuses_of(sums)
    with_usage = sorted({*statuses, USAGE_STATUS})
    return Results(
        fact=fact,
        rejects=rejects,
        aliases=aliases,
        new_products=added,
        blank_category_products=D.blank_category_products(
            products.filter(F.col("status") != USAGE_STATUS), dim
        ),
        dimension=D.append_products(extended, added),
        sums=sums,
        pivot=V.pivot_with_totals(sums, statuses, by_date),
        enhanced_pivot=V.enhanced_pivot(
            sums,
            per_category,
            with_usage,
            options.legacy_zero_total,
            keys=by_date,
        ),
        status_counts=Q.status_counts(products),
        category_counts=Q.category_counts(products),
        na_products=Q.na_products(products),
    )


def run(
    spark: SparkSession,
    root: str,
    dimension_path: str | None = None,
    dates: Sequence[str] | None = None,
    usage_file: str | None = "global_usage.csv",
    options: Options = Options(),
    mapping_path: str | None = None,
    alias_path: str | None = None,
) -> Results:
    """Read the date folders below ``root`` and report on them.

    ``dates`` (``yyyymmdd``) limits the run to those folders; other folders are
    not even listed. The category, usage, mapping and alias files may be absent.
    Stored aliases are applied; ``results.aliases`` holds them and the new ones.
    """
    folder = f"{root}/{{{','.join(dates)}}}" if dates else f"{root}/*"
    stored = spark.createDataFrame([], ALIASES)
    if mapping_path is not None:
        mapping = mapping_dict(read_mapping(spark, mapping_path))
        options = replace(options, mapping={**options.mapping, **mapping})
    if alias_path is not None:
        # Staged, since the same place may be written with the new ones.
        stored = stage(read_aliases(spark, alias_path), "aliases")
        options = replace(options, aliases={**options.aliases, **alias_dict(stored, "UNSERVED_LOCAL")})
    scanned = stage(route(scan_workbooks(spark, folder), options), "rows")
    rows = sheet_rows(scanned)
    found = tables(rows, options)
    # Staged too: file positions are fixed once, and the files are parsed once.
    dim = (
        stage(read_dimension(spark, dimension_path), "dimension")
        if dimension_path
        else spark.createDataFrame([], DIMENSION)
    )
    usage = stage(read_usage(spark, f"{folder}/{usage_file}"), "usage") if usage_file else None
    fact = stage(combine(found.projected, dim, usage, options), "fact")
    rejected = found.rejects.unionByName(unreadable(scanned))
    results = reports(fact, dim, usage, options, rejected, D.upsert_aliases(stored, found.aliases))
    return replace(results, tables=finished_tables(rows, options))


def report(
    spark: SparkSession,
    root: str,
    dimension_path: str | None,
    output: str,
    version: str,
    again: bool = False,
    **options,
) -> None:
    """Run (the arguments of ``run``), write everything below ``output``, and remove
    what was staged on the way."""
    with run_folder(spark):
        write_results(run(spark, root, dimension_path, **options), output, version, again)


def publish(
    spark: SparkSession,
    root: str,
    store_path: str,
    dimension_path: str | None = None,
    **options,
) -> Version:
    """Run (the arguments of ``run``) and publish everything as the next version of a store.

    The dimension and the aliases are the store's; ``dimension_path`` counts until it has a
    dimension of its own. Readers see all of the run or nothing.
    """
    store = Store(spark, store_path)
    base = store.latest()
    if base.dimension is not None:
        dimension_path = f"{store.root}/{base.dimension}"
    if base.aliases is not None:
        options["alias_path"] = f"{store.root}/{base.aliases}"
    with run_folder(spark):
        return store.publish(run(spark, root, dimension_path, **options), base)
