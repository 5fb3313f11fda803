"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyview.functions import is_blank, lenient_double, strip
from supplyview.operators.blocks import BLOCK_ROWS, attach_facts
from supplyview.operators.facts import is_acknowledged
from supplyview.operators.fill import merged_fill, no_span, with_span
from supplyview.operators.segments import is_blank_row
from supplyview.schemas import DELIVERY_STATUSES, SHEET_KEYS, USAGE_STATUS

def n_rows(fact: DataFrame, test: Column | None = None) -> Column:
    """Rows where ``test`` holds. A fact summed by product carries them as ``n_rows``,
    so the reports read either and need no row-level join."""
    weight = F.col("n_rows") if "n_rows" in fact.columns else F.lit(1)
    counted = weight if test is None else F.when(test, weight)
    return F.coalesce(F.sum(counted), F.lit(0)).cast("bigint")


def status_counts(fact: DataFrame) -> DataFrame:
    """Rows per status, most frequent first."""
    return (
        fact.groupBy("status")
        .agg(n_rows(fact).alias("n_rows"))
        .orderBy(F.desc("n_rows"), "status")
    )


def category_counts(fact: DataFrame) -> DataFrame:
    """Rows per category; blank ones under "No category"."""
    label = F.when(is_blank(F.col("category")), "No category").otherwise(F.col("category"))
    return (
        fact.groupBy(label.alias("category"))
        .agg(n_rows(fact).alias("n_rows"))
        .orderBy(F.desc("n_rows"), "category")
    )


def na_products(fact: DataFrame) -> DataFrame:
    """Acknowledged products A-Z with their row counts."""
    return (
        fact.filter(is_acknowledged(F.col("category")))
        .groupBy("product")
        .agg(n_rows(fact).alias("n_rows"))
        .orderBy("product")
    )


def exclusion_counts(fact: DataFrame) -> DataFrame:
    """Rows in all, left out of the pivot, and kept."""
    out = is_acknowledged(F.col("category"))
    return fact.agg(
        n_rows(fact).alias("n_total"),
        n_rows(fact, out).alias("n_excluded"),
        n_rows(fact, ~out).alias("n_kept"),
    )


def status_counts_fixed(
    fact: DataFrame, statuses: Sequence[str] = DELIVERY_STATUSES
) -> DataFrame:
    """The five delivery statuses, 0 where a status is absent.

    One aggregate row, then one output row per status.
    """
    status = F.upper("status")
    counts = fact.agg(*[n_rows(fact, status == s.upper()).alias(s) for s in statuses])
    pairs = F.array(
        *[F.struct(F.lit(s).alias("status"), F.col(f"`{s}`").alias("n_rows")) for s in statuses]
    )
    return counts.select(F.inline(pairs))


def uncategorized_counts(dim: DataFrame) -> DataFrame:
    """A10: dimension entries with a blank category, and blank or N/A."""
    blank = is_blank(F.col("category"))
    return dim.agg(
        F.count_if(blank).alias("n_blank"),
        F.count_if(blank | is_acknowledged(F.col("category"))).alias("n_blank_or_na"),
    )


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column: rows, columns, type and nulls."""

    def profile(name: str, df: DataFrame) -> DataFrame:
        types = dict(df.dtypes)
        counted = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_nulls_{c}") for c in df.columns],
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(types[c]).alias("dtype"),
                    F.col(f"`_nulls_{c}`").alias("null_count"),
                )
                for c in df.columns
            ]
        )
        return counted.select(
            F.lit(name).alias("table"),
            F.col("_rows").alias("n_rows"),
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
            F.inline(entries),
        )

    profiles = [profile(name, df) for name, df in tables.items()]
    result = profiles[0]
    for other in profiles[1:]:
        result = result.unionByName(other)
    return result


def grid_profile(promoted: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """A11 for tables whose columns are data: one row per sheet, table and column.

    A column is a double when every value is a number, else a string; columns
    without any value are dropped like in the saved tables (G20).
    """
    by = [*keys, "table"]
    # One pass: a row tells its values by column, and under no name that it is there.
    told = F.explode(
        F.concat(
            F.array(F.struct(F.lit(None).cast("string").alias("_header"), F.lit(None).cast("string").alias("_value"))),
            F.filter(
                F.transform(
                    F.col("header"),
                    lambda h, i: F.struct(h.alias("_header"), F.get("cells", i).alias("_value")),
                ),
                lambda x: x["_header"].isNotNull() & x["_value"].isNotNull(),
            ),
        )
    )
    counted = (
        promoted.select(*by, told.alias("_x")).select(*by, "_x.*")
        .groupBy(*by, "_header")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.every(lenient_double(F.col("_value")).isNotNull()).alias("_numbers"),
        )
        .groupBy(*by)
        .agg(
            F.max(F.when(F.col("_header").isNull(), F.col("_n"))).alias("n_rows"),
            F.count("_header").alias("n_columns"),
            # At most as many as a sheet has columns.
            F.collect_list(
                F.when(F.col("_header").isNotNull(), F.struct("_header", "_n", "_numbers"))
            ).alias("_columns"),
        )
    )
    return counted.select(*by, "n_rows", "n_columns", F.explode("_columns").alias("_c")).select(
        *by,
        "n_rows",
        "n_columns",
        F.col("_c._header").alias("column"),
        F.when(F.col("_c._numbers"), "double").otherwise("string").alias("dtype"),
        (F.col("n_rows") - F.col("_c._n")).alias("null_count"),
    )


def pivot_shape(sums: DataFrame) -> DataFrame:
    """Numbers of categories and of statuses (usage not counted)."""
    return sums.agg(
        F.count_distinct("category").alias("n_categories"),
        F.count_distinct(F.when(F.col("status") != USAGE_STATUS, F.col("status"))).alias(
            "n_statuses"
        ),
    )


def delivered_kilos_position(header: Column) -> Column:
    """0-based position of the first header holding DELIVER and KILO."""
    names = F.transform(header, lambda h: F.upper(h))
    hit = F.transform(
        names,
        lambda h: F.coalesce(h.contains("DELIVER") & h.contains("KILO"), F.lit(False)),
    )
    return F.nullif(F.array_position(hit, True), F.lit(0)) - 1


def product_search(
    table: DataFrame,
    text: str,
    product: str,
    keys: Sequence[str] = SHEET_KEYS,
    scan_rows: int | None = None,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Rows of a promoted table whose product holds ``text``, ignoring case.

    Gives row, supplier (second column), quantity, and the first and last row of
    the merged range the product lies in (null when it is not merged). Products in a
    merged range (of ``ranges``, by the rows' ``sheet_row`` if they have one) are found on
    each of its rows. ``scan_rows`` limits the search to the rows right below the header.
    """
    position = F.nullif(F.array_position(F.col("header"), product), F.lit(0)) - 1
    looked_at = table if scan_rows is None else table.filter(F.col("row_idx") < scan_rows)
    place = position.cast("int")
    if ranges is None:
        placed = looked_at.withColumn("span", no_span())
    else:
        row = "sheet_row" if "sheet_row" in table.columns else "row_idx"
        placed = with_span(looked_at, ranges, place, keys, row=row)
    found = placed.withColumn(
        "product", merged_fill(F.col("cells"), F.col("span"), place)
    ).filter(F.upper("product").contains(text.upper()))
    return found.select(
        *keys,
        "row_idx",
        strip(F.col("product")).alias("product"),
        F.get("cells", F.lit(1)).alias("supplier"),
        F.get("cells", delivered_kilos_position(F.col("header"))).alias("quantity"),
        F.col("span.top").alias("merged_from_row"),
        F.col("span.last_row").alias("merged_to_row"),
    )


def search_counts(found: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """Hits per sheet, and how many lie in merged ranges."""
    return found.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.count_if(F.col("merged_from_row").isNotNull()).alias("n_merged"),
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first rows under a total order (a top-k report)."""
    return df.orderBy(*order).limit(n)


def sheet_audit(
    routed: DataFrame,
    parts: DataFrame,
    located: DataFrame,
    aside: Sequence[str],
    further: DataFrame | None = None,
    keys: Sequence[str] = SHEET_KEYS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Where the rows of every sheet went; the parts add up to ``n_read``.

    ``routed``: all rows with their ``table``; ``parts``: the rows that belong to tables,
    with the table's name; ``located``: the tables' headers and reasons; ``aside``: tables that
    are not delivered; ``further``: row ranges left out of split sheets. Rows of a
    split sheet outside its tables are titles and markers.
    """
    blank = is_blank_row(F.col("cells"))
    whole = routed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(blank).alias("n_blank"),
        F.bool_or(F.coalesce(F.col("table").isin(*aside), F.lit(True))).alias("_aside"),
    )
    by = [*keys, "table"]
    facts = located.select(*by, "last_row", "header_row", F.col("reason").isNotNull().alias("_bad"))
    below = F.col("row_idx") > F.coalesce("header_row", F.lit(-2))
    told = attach_facts(parts.filter(~blank), facts, by, block_rows).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_parts"),
        F.count_if(F.col("_bad")).alias("_rejected"),
        F.count_if(~F.col("_bad") & below).alias("_table"),
    )
    counted = whole.join(told, list(keys), "left")
    if further is None:
        counted = counted.withColumn("_further", F.lit(0).cast("bigint"))
    else:
        sheets = routed.groupBy(*keys).agg(F.max("row_idx").alias("last_row"))
        spans = further.join(sheets, list(keys))
        here = F.col("row_idx").between(F.col("start_row"), F.col("end_row"))
        left = attach_facts(routed.filter(~blank), spans, keys, block_rows).filter(here)
        counted = counted.join(
            left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_further")), list(keys), "left"
        )
    zero = F.lit(0).cast("bigint")
    n = {c: F.coalesce(F.col(c), zero) for c in ("_parts", "_rejected", "_table", "_further")}
    outside = F.col("n_read") - F.col("n_blank") - n["_parts"]
    aside_rows = F.when(F.col("_aside"), outside).otherwise(zero)
    # A stacked sheet without any part was not split.
    lost = F.when(F.col("_aside"), zero).when(F.col("_parts").isNull(), outside).otherwise(n["_further"])
    rejected = n["_rejected"] + lost
    return counted.select(
        *keys, "n_read", n["_table"].alias("n_table"),
        (F.col("n_read") - F.col("n_blank") - n["_table"] - rejected - aside_rows).alias("n_header"),
        "n_blank", rejected.alias("n_rejected"), aside_rows.alias("n_aside"),
    )
