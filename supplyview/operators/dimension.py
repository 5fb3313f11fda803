"""Upkeep of the category dimension and the alias store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyview.functions import is_blank, strip
from supplyview.operators.facts import is_acknowledged


def clean_dimension(raw: DataFrame) -> DataFrame:
    """Trimmed entries; the last duplicate's category at the first one's position.

    ``raw``: ``(product, category, file_pos)``. ``N/A`` stays text, null becomes ''.
    """
    trimmed = raw.select(
        F.coalesce(strip(F.col("product")), F.lit("")).alias("product"),
        F.coalesce(strip(F.col("category")), F.lit("")).alias("category"),
        "file_pos",
    )
    return (
        trimmed.filter(F.col("product") != "")
        .groupBy("product")
        .agg(
            F.max_by("category", "file_pos").alias("category"),
            F.min("file_pos").alias("file_pos"),
        )
    )


def dimension_sorted(dim: DataFrame) -> DataFrame:
    """K4 / O1: categorised products A-Z, then the blank and N/A block A-Z."""
    open_entry = is_blank(F.col("category")) | is_acknowledged(F.col("category"))
    return dim.withColumn("is_uncategorized", open_entry).orderBy("is_uncategorized", "product")


def distinct_products(fact: DataFrame) -> DataFrame:
    """Stripped product names, once each; partial distinct keeps hot products cheap."""
    return fact.select(strip(F.col("product")).alias("product")).distinct()


def new_products(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Products of the fact that the dimension lacks."""
    return distinct_products(fact).join(dim, "product", "left_anti")


def append_products(dim: DataFrame, products: DataFrame, category: str = "") -> DataFrame:
    """The dimension with new products under a fixed category, at the end."""
    added = products.select(
        "product", F.lit(category).alias("category"), F.lit(None).cast("bigint").alias("file_pos")
    )
    return dim.select("product", "category", "file_pos").unionByName(added)


def blank_category_products(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Known products of the fact whose category is blank."""
    blank = dim.filter(is_blank(F.col("category"))).select("product")
    return distinct_products(fact).join(blank, "product", "left_semi")


def upsert_aliases(store: DataFrame, captured: DataFrame) -> DataFrame:
    """K5: store and new hits as one set of (table, expected, alias) rows."""
    columns = ["table", "expected", "alias"]
    return store.select(*columns).unionByName(captured.select(*columns)).distinct()
