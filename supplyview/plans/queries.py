"""One query per operator of the inventory, over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyview.functions import (
    lenient_double,
)
from supplyview.operators import clean as C
from supplyview.operators import dimension as D
from supplyview.operators import facts as P
from supplyview.operators import fallback
from supplyview.operators import fill as L
from supplyview.operators import headers as H
from supplyview.operators import increments as N
from supplyview.operators import pivot as V
from supplyview.operators import quality as Q
from supplyview.operators import routing as R
from supplyview.operators import segments as S
from supplyview.operators import tables as G
from supplyview.operators import usage as U
from supplyview.plans import views as W
from supplyview.plans.views import KEYS
from supplyview.schemas import ALL_STATUSES, DELIVERY_STATUSES, TABLE_COLUMNS
from supplyview.session import stage
from supplyview.sinks import table_lines
from supplyview.sources import folders
from supplyview.sources.workbook import cells_of, rows_of, sheet_listing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _joined(cells: Column) -> Column:
    """Cells as one text, nulls shown as ``~``."""
    return F.array_join(cells, "|", "~")


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c in columns})


def _long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# --- the fact ----------------------------------------------------------------


def _to_status(df: DataFrame) -> DataFrame:
    return df.select(
        "product",
        P.to_tons(F.col("quantity"), F.col("table")).alias("quantity"),
        R.status_of(F.col("table")).alias("status"),
    )


@query
def combined_fact(spark, sf):
    """Every delivery, inventory and usage row."""
    dim = W.dimension(spark, sf)
    lines = W.delivery_lines(spark, sf).drop("l_orderkey").unionByName(W.inventory_lines(spark, sf))
    fact = P.category_lookup(_to_status(P.nonempty_product(lines)), dim)
    return P.combine([fact, U.usage_fact(W.usage(spark, sf), dim)])


@query
def category_lookup(spark, sf):
    """J1 on the line items."""
    lines = W.delivery_lines(spark, sf).select("l_orderkey", "product")
    return P.category_lookup(lines, W.dimension(spark, sf))


def _located(rows: DataFrame) -> DataFrame:
    keys = [*KEYS, "table"]
    start = F.col("start_row") if "start_row" in rows.columns else None
    return G.locate(rows, H.score_rank(start=start), keys, TABLE_COLUMNS)


def _unstacked(routed: DataFrame) -> DataFrame:
    """Delivery rows with their table; stacked sheets split, and only those staged again."""
    plain = routed.filter(~F.col("table").isin(R.STACKED, R.SUMMARY)).withColumn(
        "start_row", F.lit(0).cast("bigint")
    )
    stacked = routed.filter(F.col("table") == R.STACKED).drop("table")
    return plain.unionByName(stage(S.split_markers(stacked, KEYS), "tables"))


def _routed(spark, sf) -> DataFrame:
    """Staged like in a run."""
    rows = W.delivery_grid(spark, sf).withColumn("table", R.route_combined(F.col("sheet")))
    return _unstacked(stage(rows, "rows"))


@query
def mapped_projection(spark, sf):
    """Where the mapped columns stand in every table's header."""
    return _located(_routed(spark, sf)).select(
        *KEYS, "table", "header_row", "product_pos", "quantity_pos", "reason"
    )


@query
def nonempty_product(spark, sf):
    """P4 on padded, blank and null names."""
    names = W.read(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, F.lit(""))
        .when(F.col("event_id") % 7 == 1, F.lit("  \t"))
        .when(F.col("event_id") % 7 == 2, F.lit(None))
        .when(F.col("event_id") % 7 == 3, F.concat(F.lit(" "), F.col("event_type")))
        .otherwise(F.col("event_type"))
        .alias("product"),
    )
    return P.nonempty_product(names)


@query
def lenient_numeric(spark, sf):
    """P5 on the forms numbers take in spreadsheets."""
    value = F.col("value").cast("string")
    forms = [
        F.concat(F.lit(" "), value, F.lit("  ")), F.concat(F.lit("1,"), value),
        F.concat(value, F.lit("e3")), F.concat(F.lit("-"), value), F.concat(value, F.lit("d")),
        F.lit(""), F.lit("-"), F.lit("nan"), F.concat(F.lit("+"), value),
        F.concat(F.lit("0x"), F.col("user_id").cast("string")), F.lit(".5"), F.lit("5."),
        F.lit(None).cast("string"),
    ]
    text = F.element_at(F.array(*forms), (F.col("event_id") % len(forms) + 1).cast("int"))
    return W.read(spark, sf, "events").select(
        "event_id", lenient_double(text).alias("parsed")
    )


def _units(spark, sf, legacy: bool) -> DataFrame:
    sums = W.delivery_sums(spark, sf).unionByName(W.inventory_sums(spark, sf))
    totals = sums.groupBy("table").agg(F.sum("quantity").alias("quantity"))
    return totals.select(
        R.status_of(F.col("table")).alias("status"),
        F.round(P.to_tons(F.col("quantity"), F.col("table"), legacy), 6).alias("quantity"),
    )


@query
def unit_conversion(spark, sf):
    """Summed first, then converted, which is the same by linearity."""
    return _units(spark, sf, legacy=False)


@query
def unit_conversion_legacy(spark, sf):
    """P7."""
    return _units(spark, sf, legacy=True)


@query
def usage_clean(spark, sf):
    """S3, P8-P10."""
    return W.usage(spark, sf).drop("file_pos")


@query
def usage_fact(spark, sf):
    """P16, J4, X3."""
    return U.usage_fact(W.usage(spark, sf), W.dimension(spark, sf))


# --- reports -----------------------------------------------------------------


def _usage_sums(spark, sf, parts: DataFrame | None = None) -> DataFrame:
    """Usage as (product, table, quantity in kilos, rows)."""
    return W.usage(spark, sf, parts).select(
        F.col("ingredient_name").alias("product"),
        F.lit("GLOBAL USAGE").alias("table"),
        F.col("ingredient_amount").alias("quantity"),
        F.lit(1).cast("bigint").alias("n_rows"),
    )


def product_sums(spark, sf, parts: DataFrame | None = None) -> DataFrame:
    """(product, status, category, quantity, n_rows): the fact summed by product.

    Quantities stay in the tables' own units; sums of whole numbers are exact.
    """
    sums = (
        W.delivery_sums(spark, sf)
        .unionByName(W.inventory_sums(spark, sf, parts))
        .unionByName(_usage_sums(spark, sf, parts))
    )
    known = W.dimension(spark, sf, parts).select("product", "category", F.lit(True).alias("_known"))
    is_usage = F.col("table") == "GLOBAL USAGE"
    return sums.join(known, "product", "left").select(
        "product",
        R.status_of(F.col("table")).alias("status"),
        F.when(F.col("_known"), F.col("category"))
        .when(is_usage, F.col("product"))
        .otherwise("")
        .alias("category"),
        "quantity",
        "n_rows",
    )


def in_tons(products: DataFrame) -> DataFrame:
    """(category, status, quantity in tons) without acknowledged products."""
    sums = V.category_status_sums(products)
    return sums.withColumn("quantity", P.to_tons(F.col("quantity"), F.col("status")))


def category_sums(spark, sf) -> DataFrame:
    return in_tons(product_sums(spark, sf))


@query
def pivot_status(spark, sf):
    """A1, P11, P12, O4."""
    return _round(V.status_pivot(category_sums(spark, sf)), *ALL_STATUSES)


@query
def pivot_totals(spark, sf):
    """A1-A4: the flagship report."""
    return _round(V.pivot_with_totals(category_sums(spark, sf)), *ALL_STATUSES, "TOTAL")


@query
def pivot_after_changes(spark, sf):
    """The pivot after some products left the dimension and others changed their
    category, from the sums before and the changed products' partial sums."""
    parts = W.part_sums(spark, sf)
    before = W.dimension(spark, sf, parts)
    kind = F.col("file_pos") % 20
    after = before.filter(kind != 0).withColumn("category", F.when(kind == 1, "Moved").otherwise(F.col("category")))
    partials = stage(N.partial_sums(product_sums(spark, sf, parts), keys=()), "partials")
    changes = stage(N.changed_categories(before, after), "changes")
    sums = N.refreshed(N.category_sums(partials, before, keys=()), N.moved(partials, changes, keys=()), keys=())
    refreshed = sums.withColumn("quantity", F.col("quantity").cast("double"))
    return _round(V.pivot_with_totals(in_tons(refreshed)), *ALL_STATUSES, "TOTAL")


@query
def pivot_shape(spark, sf):
    """A13."""
    return Q.pivot_shape(category_sums(spark, sf))


@query
def usage_by_category(spark, sf):
    """A5, P14."""
    sums = product_sums(spark, sf)
    return V.usage_by_category(sums).withColumn(
        "monthly_usage", F.round(F.col("monthly_usage") / 1000, 6)
    )


@query
def usage_monthly(spark, sf):
    """One column per rule."""
    cleaned = W.usage(spark, sf)
    result = None
    for rule in U.USAGE_RULES:
        one = U.monthly_usage(cleaned, rule).select(
            "ingredient_name", F.round("monthly_usage", 6).alias(rule)
        )
        result = one if result is None else result.join(one, "ingredient_name")
    return result


@query
def projection_long(spark, sf):
    """X4, X7."""
    plan = V.category_plan(category_sums(spark, sf))
    return _round(V.projection_long(plan), "total", "monthly_usage", "projection")


def _enhanced_columns() -> list[str]:
    return [*ALL_STATUSES, "TOTAL", V.MONTHLY_USAGE, *[V.projection_name(m) for m in range(1, 7)]]


@query
def enhanced_pivot(spark, sf):
    """X5, J8."""
    return _round(V.enhanced_pivot(category_sums(spark, sf)), *_enhanced_columns())


def _fuzzy_category_usage(spark, sf, sums: DataFrame, parts: DataFrame) -> DataFrame:
    """Usage per category through products and loosely named ingredients."""
    labelled = sums.filter(~P.is_acknowledged(F.col("category"))).select(
        V.category_label(F.col("category")).alias("category"), "product"
    )
    loose = stage(W.loose_usage(spark, sf, parts), "loose")
    mapping = stage(U.ingredient_map_fuzzy(loose, W.dimension(spark, sf, parts)), "mapping")
    return U.usage_by_category_fuzzy(labelled, loose, mapping)


@query
def usage_by_category_fuzzy(spark, sf):
    """J9, X2."""
    parts = stage(W.part_sums(spark, sf), "parts")
    sums = product_sums(spark, sf, parts)
    return _round(_fuzzy_category_usage(spark, sf, sums, parts), "monthly_usage")


@query
def enhanced_pivot_fuzzy(spark, sf):
    """X6. What feeds several sides (parts by name, product sums, usage, mapping) is
    staged, so the parts are read twice: by name and for the line items."""
    parts = stage(W.part_sums(spark, sf), "parts")
    products = stage(product_sums(spark, sf, parts), "sums")
    per_category = _fuzzy_category_usage(spark, sf, products, parts)
    return _round(V.enhanced_pivot(in_tons(products), per_category), *_enhanced_columns())


@query
def inventory_risk(spark, sf):
    """X8."""
    plan = V.category_plan(category_sums(spark, sf))
    return _round(
        plan.select(
            "category",
            "inventory",
            "monthly_usage",
            V.inventory_flag(F.col("inventory"), F.col("monthly_usage")).alias("risk"),
        ),
        "inventory",
        "monthly_usage",
    )


@query
def projection_risk(spark, sf):
    """X9, X10."""
    long = V.projection_long(V.category_plan(category_sums(spark, sf)))
    flagged = long.select(
        "category",
        "month",
        V.projection_flag(F.col("total"), F.col("monthly_usage"), F.col("month")).alias("risk"),
        V.is_negative_projection(F.col("projection")).alias("is_negative"),
    )
    return flagged


@query
def pivot_display(spark, sf):
    """X11 on the report's figures, which carry six decimals."""
    return V.pivot_display(enhanced_pivot(spark, sf))


# --- the category dimension --------------------------------------------------


@query
def category_dim(spark, sf):
    """Trimmed, last duplicate wins, N/A kept."""
    return D.clean_dimension(W.raw_dimension(spark, sf))


@query
def category_dim_sorted(spark, sf):
    """K4, O1."""
    return D.dimension_sorted(D.clean_dimension(W.raw_dimension(spark, sf))).select(
        "is_uncategorized", "product", "category"
    )


def _fact_products(spark, sf) -> DataFrame:
    """Products of deliveries and inventory."""
    return W.delivery_sums(spark, sf).unionByName(W.inventory_sums(spark, sf)).select("product")


@query
def new_products(spark, sf):
    """J2, O2, U2, U4."""
    return D.new_products(_fact_products(spark, sf), W.dimension(spark, sf))


@query
def blank_category_products(spark, sf):
    """J3."""
    return D.blank_category_products(_fact_products(spark, sf), W.dimension(spark, sf))


@query
def ingredient_map_exact(spark, sf):
    """J5."""
    return U.ingredient_map_exact(W.usage(spark, sf), W.dimension(spark, sf)).drop("file_pos")


@query
def ingredient_map_fuzzy(spark, sf):
    """J6."""
    mapped = U.ingredient_map_fuzzy(W.loose_usage(spark, sf), W.dimension(spark, sf))
    return mapped.drop("file_pos")


@query
def new_ingredients(spark, sf):
    """The dimension with the unmatched ingredients as N/A."""
    dim = W.dimension(spark, sf)
    mapping = U.ingredient_map_fuzzy(W.loose_usage(spark, sf), dim)
    return D.append_products(dim, U.new_ingredients(mapping, dim), "N/A").drop("file_pos")


# --- quality reports ---------------------------------------------------------


@query
def status_counts(spark, sf):
    """A6, O3."""
    return Q.status_counts(product_sums(spark, sf))


@query
def status_counts_fixed(spark, sf):
    """A9, P13."""
    return Q.status_counts_fixed(product_sums(spark, sf), DELIVERY_STATUSES)


@query
def category_counts(spark, sf):
    """A7."""
    return Q.category_counts(product_sums(spark, sf))


@query
def na_products(spark, sf):
    """A8."""
    return Q.na_products(product_sums(spark, sf))


@query
def exclusion_counts(spark, sf):
    """A12."""
    return Q.exclusion_counts(product_sums(spark, sf))


@query
def uncategorized_counts(spark, sf):
    """A10."""
    return Q.uncategorized_counts(D.clean_dimension(W.raw_dimension(spark, sf)))


@query
def table_profile(spark, sf):
    """A11 on the dimension, the usage file and the sheet columns of the grid."""
    sheet = _sheet_columns(spark, sf).select(*SHEET_COLUMNS)
    return Q.table_profile(
        {
            "dimension": W.raw_dimension(spark, sf),
            "usage": W.usage(spark, sf).drop("file_pos"),
            "sheet": sheet,
        }
    )


@query
def grid_profile(spark, sf):
    """A11 on finished delivery tables whose columns are found in the data."""
    routed = _routed(spark, sf)
    rank = H.score_rank(start=F.col("start_row"))
    return Q.grid_profile(G.finish_tables(G.promoted_tables(routed, rank, KEYS), KEYS), KEYS)


@query
def finished_tables(spark, sf):
    """K1: deliveries and inventory as they are saved, as lines of CSV."""
    routed = _routed(spark, sf)
    rank = H.score_rank(start=F.col("start_row"))
    deliveries = G.finish_tables(G.promoted_tables(routed, rank, KEYS), KEYS)
    rows = W.merged_inventory_grid(spark, sf).withColumn("table", F.lit("INVENTORY"))
    proper = rows.join(H.header_required(rows, KEYS).select(*KEYS), list(KEYS), "left_semi")
    stock = G.finish_tables(
        G.promoted_tables(proper, H.required_rank(), KEYS), KEYS, fill_inventory=True
    )
    return table_lines(deliveries.unionByName(stock), KEYS)


def _inventory_promoted(rows: DataFrame) -> DataFrame:
    return H.promote_header(rows, H.header_required(rows, KEYS), KEYS, sheet_row=True)


def _widgets(spark, sf) -> DataFrame:
    rows = W.merged_inventory_grid(spark, sf)
    ranges = L.merged_ranges(rows, KEYS)
    return Q.product_search(_inventory_promoted(rows), "widget", "ITEM DESCRIPTION", KEYS, ranges=ranges)


@query
def product_search(spark, sf):
    """Widgets anywhere in the inventory sheets, merged cells included."""
    found = _widgets(spark, sf)
    return _long(found, "merged_from_row", "merged_to_row")


@query
def search_counts(spark, sf):
    """A14."""
    return Q.search_counts(_widgets(spark, sf), KEYS)


@query
def preview(spark, sf):
    """Ten rows under a total order."""
    return Q.preview(
        W.read(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"),
        ["o_orderpriority", "o_orderkey"],
    )


@query
def required_columns(spark, sf):
    """Sheets without their columns, and why."""
    rows = W.inventory_grid(spark, sf).withColumn("table", F.lit("INVENTORY"))
    return R.rejects(_located(rows), KEYS)


@query
def sheet_audit(spark, sf):
    """The rows of every delivery sheet, by what became of them; sheets without a usable
    split and unmapped sheets are rejected with all their rows."""
    rows = W.audit_grid(spark, sf).withColumn("table", R.route_combined(F.col("sheet")))
    routed = stage(rows, "rows")
    parts = _unstacked(routed)
    return Q.sheet_audit(routed, parts, _located(parts), (R.SUMMARY,), None, KEYS)


@query
def unsplit_sheets(spark, sf):
    """Stacked sheets that no rule splits."""
    rows = W.audit_grid(spark, sf).withColumn("table", R.route_combined(F.col("sheet")))
    stacked = rows.filter(F.col("table") == R.STACKED)
    ranges, further = fallback.marker_rules(stacked, KEYS)
    return fallback.split_rejects(stacked, ranges, further, KEYS)


@query
def tables_beyond_two(spark, sf):
    """G33 with G11-G13: tables of a stacked sheet after the second, with their rows."""
    _, further = fallback.advanced_rules(stage(W.grid(spark, sf), "rows"), KEYS)
    return further


@query
def merged_fill(spark, sf):
    """Inventory products from merged cells."""
    rows = W.merged_inventory_grid(spark, sf)
    return L.with_span(rows, L.merged_ranges(rows, KEYS), 0, KEYS).select(
        *KEYS, "row_idx",
        L.merged_fill(F.col("cells"), F.col("span"), F.lit(0)).alias("product"),
        F.col("span").isNotNull().cast("bigint").alias("n_merged"),
    )


# --- sheets ------------------------------------------------------------------


def _header(found: DataFrame, *more: str) -> DataFrame:
    return found.select(
        *KEYS, "header_row", _joined(F.col("header_cells")).alias("header"), *more
    )


@query
def header_strict(spark, sf):
    """G1."""
    return _header(H.header_strict(W.grid(spark, sf), KEYS), "score")


@query
def header_lenient(spark, sf):
    """G2."""
    return _header(H.header_lenient(W.grid(spark, sf), KEYS), "score")


@query
def header_required(spark, sf):
    """G3."""
    return _header(H.header_required(W.grid(spark, sf), KEYS))


@query
def header_anchor(spark, sf):
    """G4, both anchors."""
    rows = W.grid(spark, sf)
    found = None
    for anchor in sorted(set(H.ANCHORS.values())):
        one = _header(H.header_anchor(rows, anchor, KEYS)).withColumn("anchor", F.lit(anchor))
        found = one if found is None else found.unionByName(one)
    return found


@query
def header_priority(spark, sf):
    """G5."""
    return _header(H.header_priority(W.grid(spark, sf), KEYS), "step")


@query
def promote_header(spark, sf):
    """Named cells below the required header."""
    rows = W.grid(spark, sf)
    return H.named_values(H.promote_header(rows, H.header_required(rows, KEYS), KEYS), KEYS)


def _row_tables(parts: DataFrame) -> DataFrame:
    return parts.select(*KEYS, "table", "start_row", "row_idx", _joined(F.col("cells")).alias("cells"))


@query
def split_markers(spark, sf):
    """G8."""
    return _row_tables(S.split_markers(W.grid(spark, sf), KEYS))


@query
def split_first_col(spark, sf):
    """G9, G7."""
    return _row_tables(S.split_first_col(W.grid(spark, sf), KEYS))


@query
def split_blank_row(spark, sf):
    """G10."""
    return _row_tables(S.split_blank_row(W.grid(spark, sf), KEYS))


@query
def table_boundaries(spark, sf):
    """Runs of rows that are no separators."""
    return S.table_boundaries(W.grid(spark, sf), KEYS)


@query
def table_boundaries_legacy(spark, sf):
    """G11, the older rule for runs of separators."""
    return S.table_boundaries(W.grid(spark, sf), KEYS, legacy=True)


@query
def null_pattern_segments(spark, sf):
    """G12."""
    return S.null_pattern_segments(W.grid(spark, sf), KEYS)


@query
def midpoint_split(spark, sf):
    """Rows per half of every sheet."""
    halves = S.midpoint_split(W.grid(spark, sf), KEYS)
    return halves.groupBy(*KEYS, "table", "start_row").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("row_idx").alias("end_row")
    )


@query
def advanced_split(spark, sf):
    """G9 with G11, G12 and G13 behind it: rows per table."""
    parts = fallback.advanced_split(stage(W.grid(spark, sf), "rows"), KEYS)
    return parts.groupBy(*KEYS, "table", "start_row").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("row_idx").alias("end_row")
    )


SHEET_COLUMNS = ("kind", "value", "supplier", "props", "note")


def _sheet_columns(spark, sf) -> DataFrame:
    """The sheets with all five cells by name."""
    named = [F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(SHEET_COLUMNS)]
    return W.grid(spark, sf).select(*KEYS, "row_idx", *named)


@query
def ffill_summary(spark, sf):
    """G15."""
    return L.ffill_summary(_sheet_columns(spark, sf), "kind", "supplier", KEYS)


@query
def ffill_all(spark, sf):
    """G16."""
    return L.ffill(_sheet_columns(spark, sf), SHEET_COLUMNS, KEYS)


def _local_headers(spark, sf) -> DataFrame:
    """Every header row of the grid that names its columns in its own way."""
    first = F.lower(F.get("cells", F.lit(0)))
    return (
        W.grid(spark, sf)
        .filter(first.contains("raw") & first.contains("material"))
        .select(*KEYS, "row_idx", "cells", H.header_names(F.col("cells")).alias("header"))
    )


@query
def fuzzy_header(spark, sf):
    """G17 without a stored alias."""
    renamed = H.rename_headers(_local_headers(spark, sf))
    return renamed.select(*KEYS, "row_idx", _joined(F.col("header")).alias("header"))


@query
def fuzzy_header_alias(spark, sf):
    """G17 with a stored alias, which comes before the fuzzy rule."""
    aliases = {H.LOCAL_QUANTITY: ["qty"], H.LOCAL_PRODUCT: ["RAW MATERIAL"]}
    renamed = H.rename_headers(_local_headers(spark, sf), aliases=aliases)
    return renamed.select(
        *KEYS,
        "row_idx",
        _joined(F.col("header")).alias("header"),
        F.size("captured").cast("bigint").alias("n_captured"),
    )


@query
def alias_upsert(spark, sf):
    """Stored aliases (the header rows' second names) and the new hits."""
    headers = _local_headers(spark, sf)
    found = H.captured_aliases(H.rename_headers(headers), "UNSERVED_LOCAL")
    store = headers.filter(F.get("cells", F.lit(1)) == "QTY").select(
        F.lit("UNSERVED_LOCAL").alias("table"),
        F.lit(H.LOCAL_QUANTITY).alias("expected"),
        F.get("cells", F.lit(1)).alias("alias"),
    )
    return D.upsert_aliases(store, found)


@query
def drop_blank_rows(spark, sf):
    """Rows left per sheet."""
    rows = W.grid(spark, sf)
    spaced = rows.withColumn(
        "cells",
        F.transform("cells", lambda c: F.when(F.col("row_idx") % 19 == 0, F.lit(" ")).otherwise(c)),
    )
    kept = C.drop_blank_rows(rows).select(*KEYS, F.lit("null").alias("rule"), "row_idx")
    seen = C.drop_blank_rows(spaced, whitespace_too=True).select(
        *KEYS, F.lit("white space").alias("rule"), "row_idx"
    )
    return kept.unionByName(seen)


@query
def drop_blank_columns(spark, sf):
    """Columns in use per sheet."""
    return C.used_columns(W.grid(spark, sf), KEYS)


@query
def fill_nulls(spark, sf):
    """G21, text and numbers."""
    table = _sheet_columns(spark, sf).withColumn("value", lenient_double(F.col("value")))
    return L.fill_nulls(table, numbers=True)


@query
def whole_number_format(spark, sf):
    """Whole quantities as integers, prices as text."""
    return C.whole_number_format(
        W.read(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    )


@query
def inventory_columns(spark, sf):
    """Named cells of the inventory sheets, description and quantity columns only."""
    named = H.named_values(_inventory_promoted(W.inventory_grid(spark, sf)), KEYS)
    return named.filter(C.is_inventory_column(F.col("column")))


@query
def sheet_routing(spark, sf):
    """What each layout makes of the sheet names."""
    sheets = (
        sheet_listing(W.delivery_grid(spark, sf), KEYS)
        .unionByName(sheet_listing(W.split_grid(spark, sf), KEYS))
    )
    return sheets.select(
        *KEYS,
        R.route_combined(F.col("sheet")).alias("combined"),
        R.route_split(F.col("workbook"), F.col("sheet")).alias("split"),
        R.route_named(F.col("sheet")).alias("named"),
    )


def _table_rows(projected: DataFrame) -> DataFrame:
    return projected.select(*KEYS, "table", "row_idx", "product", "quantity_text")


@query
def delivery_table(spark, sf):
    """Projected rows of the delivery workbooks."""
    projected, _ = G.delivery_table(_routed(spark, sf), KEYS)
    return _table_rows(projected)


@query
def delivery_fact(spark, sf):
    """Quantities in tons out of the delivery workbooks."""
    projected, _ = G.delivery_table(_routed(spark, sf), KEYS)
    fact = P.quantity_fact(projected).select(*KEYS, "row_idx", "product", "quantity", "status")
    return fact


@query
def inventory_table(spark, sf):
    """Projected rows of the inventory workbooks."""
    projected, _ = G.inventory_table(W.inventory_grid(spark, sf), KEYS)
    return _table_rows(projected)


@query
def first_inventory_sheet(spark, sf):
    """Projected rows of each inventory workbook's first sheet, merged names filled."""
    rows = W.merged_inventory_grid(spark, sf).filter(F.col("sheet_pos") == 0)
    projected, _ = G.inventory_table(rows, KEYS, fill_merged=True)
    return _table_rows(projected)


def _split(spark, sf):
    rows = W.split_grid(spark, sf).withColumn(
        "table", R.route_split(F.col("workbook"), F.col("sheet"))
    )
    return G.split_tables(stage(rows, "rows").filter(F.col("table").isNotNull()), KEYS)


@query
def split_tables(spark, sf):
    """G32 (G4-G6, G15, G17): projected rows of the split workbooks."""
    return _table_rows(_split(spark, sf)[0])


@query
def split_rejects(spark, sf):
    """Split sheets left out, and why."""
    return _split(spark, sf)[1]


# --- sources -----------------------------------------------------------------


@query
def sheet_grid(spark, sf):
    """S1, S7 data model: rows rebuilt from the long cell grid, blank rows included."""
    rows = W.grid(spark, sf)
    dims = rows.groupBy(*KEYS).agg(
        (F.max("row_idx") + 1).alias("n_rows"), F.max(F.size("cells")).alias("n_cols")
    )
    rebuilt = rows_of(cells_of(rows, KEYS), dims, KEYS)
    return rebuilt.select(*KEYS, "row_idx", _joined(F.col("cells")).alias("cells"))


@query
def sheet_listing_query(spark, sf):
    return sheet_listing(W.grid(spark, sf), KEYS)


QUERIES["sheet_listing"] = QUERIES.pop("sheet_listing_query")


def _order_paths(spark, sf) -> DataFrame:
    """A delivery path per order; every tenth has no date, some an impossible one."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    folder = (
        F.when(F.col("o_orderkey") % 10 == 0, "undated")
        .when(F.col("o_orderkey") % 10 == 1, "20231345")
        .otherwise(day)
    )
    return W.read(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("input/"), folder, F.lit("/deliveries_20200101.xlsx")).alias("path"),
    )


@query
def date_from_path(spark, sf):
    """S8, P17."""
    path = F.col("path")
    default = F.lit("2024-01-01").cast("date")
    return _order_paths(spark, sf).select(
        "o_orderkey",
        folders.date_text(path).alias("date_text"),
        folders.is_date_text(folders.date_text(path)).alias("is_date_text"),
        F.date_format(folders.ingest_date_of(path, default), "yyyy-MM-dd").alias("ingest_date"),
    )


@query
def partition_status(spark, sf):
    """Which days have orders of every required priority."""
    files = W.read(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("folder"),
        F.col("o_orderpriority").alias("file"),
    )
    return folders.partition_status(files, ("1-URGENT", "2-HIGH", "3-MEDIUM"))


@query
def date_spine(spark, sf):
    """Days without an urgent order."""
    dates = (
        W.read(spark, sf, "orders")
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_orderdate").cast("date").alias("ingest_date"))
    )
    return folders.missing_dates(dates).select(
        F.date_format("ingest_date", "yyyy-MM-dd").alias("ingest_date")
    )
