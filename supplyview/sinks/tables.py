"""Writers for the fact, the pivots, whole tables, the dimension and a run (K1-K6).

Large outputs are rebalanced before the write: Spark sizes the files itself and
splits a date or status that holds most of the rows. Every writer replaces only the
dates it is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from supplyview.operators.dimension import dimension_sorted
from supplyview.schemas import SHEET_KEYS


def write_fact(fact: DataFrame, path: str, by: Sequence[str] = ("ingest_date", "status")) -> None:
    """K1 + K6: Parquet by date and status; only the dates present are replaced."""
    (
        fact.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_combined_csv(fact: DataFrame, path: str) -> None:
    """K2: the combined fact as CSV, one folder per date."""
    upper = fact.select(
        "ingest_date",
        F.col("product").alias("PRODUCT"),
        F.col("quantity").alias("QUANTITY"),
        F.col("status").alias("STATUS"),
        F.col("category").alias("CATEGORY"),
    )
    (
        upper.hint("rebalance", "ingest_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("ingest_date")
        .csv(path)
    )


def write_pivot_csv(pivot: DataFrame, path: str) -> None:
    """K3 + K6: a pivot as CSV, one folder per date when it has dates.

    The pivot is in order already, and so are the files of a date by name.
    """
    named = pivot.withColumnRenamed("category", "CATEGORY")
    writer = named.write.mode("overwrite").option("header", True)
    if "ingest_date" in named.columns:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date")
    writer.csv(path)


def csv_line(values: Column) -> Column:
    """An array of texts as a line of CSV; null is empty text."""
    quoted = F.transform(
        F.transform(values, lambda v: F.coalesce(v, F.lit(""))),
        lambda v: F.when(
            v.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
        ).otherwise(v),
    )
    return F.array_join(quoted, ",")


def table_lines(tables: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """``(keys, table, row_idx, line)``: a header line (row -2) and the rows below.

    Each row is written by its own header, so tables of any number and width need no
    common list of columns.
    """
    by = [*keys, "table"]
    # A row may be shorter than its header.
    full = F.transform(F.col("header"), lambda h, i: F.get("cells", i))
    rows = tables.select(*by, "row_idx", csv_line(full).alias("line"))
    heads = (
        tables.groupBy(*by).agg(F.first("header").alias("header"))
        .select(*by, F.lit(-2).cast("bigint").alias("row_idx"), csv_line(F.col("header")).alias("line"))
    )
    return rows.unionByName(heads)


# A table is cut between tasks only after so many rows.
PART_ROWS = 262_144


def write_tables_csv(
    tables: DataFrame, root: str, keys: Sequence[str] = SHEET_KEYS, part_rows: int = PART_ROWS
) -> None:
    """K1 + K6: every table of every sheet as CSV with its own columns, in
    ``table=/ingest_date=/workbook=/sheet=`` folders.

    Rows are dealt to tasks by ranges of (table, sheet, ``part_rows`` rows), so a table of
    any size is written by as many tasks as it takes; its files are in the order of their names,
    and each begins with the header. ``_manifest`` in ``root`` lists them (``table_files``).
    """
    by = ["table", *keys]
    spark = tables.sparkSession
    full = F.transform(F.col("header"), lambda h, i: F.get("cells", i))
    rows = tables.select(*by, "row_idx", "header", csv_line(full).alias("line"))
    heads = (
        tables.groupBy(*by).agg(F.first("header").alias("header"))
        .select(*by, F.lit(-2).cast("bigint").alias("row_idx"), "header", csv_line(F.col("header")).alias("line"))
    )
    dealt = (
        rows.unionByName(heads)
        .withColumn("_part", F.greatest(F.floor(F.col("row_idx") / part_rows), F.lit(0)))
        .repartitionByRange(*by, "_part")
        .sortWithinPartitions(*by, "row_idx")
    )
    # The first row of a task goes on with a table whose header another task has.
    goes_on = (F.shiftleft(F.monotonically_increasing_id(), 31) == 0) & (F.col("row_idx") != -2)
    headed = F.when(goes_on, F.concat(csv_line(F.col("header")), F.lit("\n"), F.col("line")))
    (
        dealt.select(*by, headed.otherwise(F.col("line")).alias("line"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .text(root)
    )
    days = [k for k in keys if k == "ingest_date"]
    found = _written(spark, root, by)
    if days:
        found = found.join(tables.select(*days).distinct(), days, "left_semi")
    (
        found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*days).json(f"{root.rstrip('/')}/_manifest")
    )


def _written(spark: SparkSession, root: str, by: Sequence[str]) -> DataFrame:
    """(by, part, n_parts, file, bytes) of the files there are; contents are not read."""
    types = ", ".join(f"{c} {'date' if c == 'ingest_date' else 'string'}" for c in by)
    files = (
        spark.read.schema(f"value string, {types}").text(root)
        .select(*by, F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .distinct()
    )
    # As many rows as a table has files.
    own = Window.partitionBy(*by)
    return files.select(
        *by,
        (F.row_number().over(own.orderBy("file")) - 1).alias("part"),
        F.count(F.lit(1)).over(own).alias("n_parts"),
        "file",
        "bytes",
    )


def table_files(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of ``write_tables_csv``: a table's files by ``part``; ``n_parts`` of them make it."""
    return spark.read.json(f"{root.rstrip('/')}/_manifest")


def write_dimension(dim: DataFrame, root: str, version: str, again: bool = False) -> str:
    """K4: categorised entries A-Z, then the open ones, under a new version folder.

    The version being read is never overwritten; ``again`` replaces one that a
    repeated batch has written before.
    """
    path = f"{root.rstrip('/')}/version={version}"
    ordered = dimension_sorted(dim).select(
        F.col("product").alias("Product"), F.col("category").alias("Category")
    )
    # Empty text is written as empty text, not as a quoted pair.
    ordered.write.mode("overwrite" if again else "errorifexists").option("header", True).option("emptyValue", "").csv(path)
    return path


def write_aliases(aliases: DataFrame, path: str) -> None:
    """K5: the alias store as JSON lines, one per (table, expected)."""
    (
        aliases.groupBy("table", "expected")
        .agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
        .orderBy("table", "expected")
        .coalesce(1)
        .write.mode("overwrite")
        .json(path)
    )


def write_results(
    results, root: str, version: str, again: bool = False, fact_by: Sequence[str] = ("ingest_date", "status")
) -> None:
    """K1-K6: everything a run gives, below ``root``; only its dates are replaced.

    ``results`` is what ``run`` returns. The dimension goes to ``version=<version>``.
    """
    root = root.rstrip("/")
    write_fact(results.fact, f"{root}/fact", fact_by)
    write_combined_csv(results.fact, f"{root}/combined")
    write_pivot_csv(results.pivot, f"{root}/pivot")
    write_pivot_csv(results.enhanced_pivot, f"{root}/enhanced_pivot")
    if results.tables is not None:
        write_tables_csv(results.tables, f"{root}/tables")
    write_dimension(results.dimension, f"{root}/dimension", version, again)
    reports = {
        "status_counts": results.status_counts, "category_counts": results.category_counts,
        "na_products": results.na_products, "new_products": results.new_products,
        "blank_category_products": results.blank_category_products,
    }
    if results.rejects is not None:
        reports["rejects"] = results.rejects
    for name, report in reports.items():
        path = f"{root}/reports/version={version}/{name}"
        report.write.mode("overwrite").option("header", True).csv(path)
    if results.aliases is not None:
        write_aliases(results.aliases, f"{root}/aliases")
