"""Date folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Files a date folder must hold, by layout.
REQUIRED_FILES = {
    "combined": ("deliveries.xlsx", "inventory.xlsx"),
    "split": ("imports.xlsx", "local.xlsx", "inventory.xlsx"),
    "usage": ("deliveries.xlsx", "inventory.xlsx", "global_usage.csv"),
}


def directory_of(path: Column) -> Column:
    """The path without the file name."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def date_text(path: Column) -> Column:
    """The first eight digits in the directory part; '' without any."""
    return F.regexp_extract(directory_of(path), r"([0-9]{8})", 1)


def is_date_text(text: Column) -> Column:
    """Exactly eight digits."""
    return F.coalesce(text.rlike("^[0-9]{8}$"), F.lit(False))


def ingest_date_of(path: Column, default: Column | None = None) -> Column:
    """That date, or ``default`` (today) when it is absent or impossible."""
    found = F.try_to_date(date_text(path), "yyyyMMdd")
    return F.coalesce(found, F.current_date() if default is None else default)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(folder, file) below ``root``; contents are not read, empty files not listed."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    )
    return files.select(
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("folder"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
    )


def partition_status(
    files: DataFrame, required: Sequence[str] = REQUIRED_FILES["split"]
) -> DataFrame:
    """S9 + S10 + O6: every all-digit folder, Ready or Missing files, sorted.

    One flag per required file, so a folder with any number of files stays small.
    """
    dated = files.filter(F.col("folder").rlike("^[0-9]+$"))
    has = [F.max((F.col("file") == f).cast("int")).alias(f"_{i}") for i, f in enumerate(required)]
    flagged = dated.groupBy("folder").agg(*has)
    missing = F.array_compact(
        F.array(*[F.when(F.col(f"_{i}") == 0, F.lit(f)) for i, f in enumerate(required)])
    )
    return (
        flagged.select(
            "folder",
            F.when(F.size(missing) == 0, "Ready").otherwise("Missing files").alias("status"),
            F.array_join(missing, ", ").alias("missing"),
        )
        .orderBy("folder")
    )


def date_spine(spark: SparkSession, start: Column, n_days: int = 7) -> DataFrame:
    """``n_days`` consecutive dates from ``start``."""
    return spark.range(n_days).select(
        F.date_add(start, F.col("id").cast("int")).alias("ingest_date")
    )


def missing_dates(dates: DataFrame, column: str = "ingest_date") -> DataFrame:
    """Days between the first and last date present that have no data."""
    present = dates.select(F.col(column).alias("ingest_date")).distinct()
    span = dates.agg(F.min(column).alias("_from"), F.max(column).alias("_to"))
    spine = span.filter(F.col("_from").isNotNull()).select(
        F.explode(F.sequence("_from", "_to")).alias("ingest_date")
    )
    return spine.join(present, "ingest_date", "left_anti")
