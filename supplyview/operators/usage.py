"""Ingredient usage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyview.functions import is_blank, lenient_double, strip
from supplyview.operators.facts import KILOS_PER_TON
from supplyview.operators.joins import lookup_join
from supplyview.schemas import USAGE_AMOUNT, USAGE_NAME, USAGE_STATUS, USAGE_STOCK

MONTHS_PER_YEAR = 12.0

# How a usage amount becomes monthly usage.
USAGE_RULES = {
    "monthly_kilos": lambda amount: amount / KILOS_PER_TON,  # X3, the default
    "annual_kilos": lambda amount: amount / MONTHS_PER_YEAR / KILOS_PER_TON,  # X1
    "annual": lambda amount: amount / MONTHS_PER_YEAR,  # X2
}


def clean_headers(df: DataFrame) -> DataFrame:
    """P10: line breaks in header names become blanks."""
    return df.toDF(*[c.replace("\n", " ").strip() for c in df.columns])


def amount(text: Column) -> Column:
    """Drop thousands commas, parse, 0 when it is no number."""
    return F.coalesce(lenient_double(F.replace(text, F.lit(","), F.lit(""))), F.lit(0.0))


def clean_usage(raw: DataFrame) -> DataFrame:
    """P8 + P9: named ingredients with amount and stock in kilos."""
    return raw.select(
        strip(F.col(f"`{USAGE_NAME}`")).alias("ingredient_name"),
        amount(F.col(f"`{USAGE_AMOUNT}`")).alias("ingredient_amount"),
        amount(F.col(f"`{USAGE_STOCK}`")).alias("ingredient_stock"),
        *[c for c in raw.columns if c in ("file_pos", "ingest_date")],
    ).filter(~is_blank(F.col("ingredient_name")))


def _known(dim: DataFrame, name: str) -> DataFrame:
    return dim.select(F.col("product").alias(name), "category", F.lit(True).alias("_known"))


def usage_fact(usage: DataFrame, dim: DataFrame) -> DataFrame:
    """P16 + J4 + X3: usage rows of the fact.

    An ingredient unknown to the dimension is its own category; a known one with
    a blank category stays blank.
    """
    named = usage.filter(F.col("ingredient_amount").isNotNull())
    joined = lookup_join(named, _known(dim, "ingredient_name"), ["ingredient_name"])
    return joined.select(
        *[c for c in usage.columns if c == "ingest_date"],
        F.col("ingredient_name").alias("product"),
        USAGE_RULES["monthly_kilos"](F.col("ingredient_amount")).alias("quantity"),
        F.lit(USAGE_STATUS).alias("status"),
        F.when(F.col("_known"), F.col("category"))
        .otherwise(F.col("ingredient_name"))
        .alias("category"),
    )


def monthly_usage(
    usage: DataFrame, rule: str = "monthly_kilos", keys: Sequence[str] = ()
) -> DataFrame:
    """J10 + X1/X2/X3: monthly usage per ingredient, from its first row in the file.

    ``keys`` (the date) tell several usage files apart.
    """
    first = usage.groupBy(*keys, "ingredient_name").agg(
        F.min_by("ingredient_amount", "file_pos").alias("_amount"),
        F.min("file_pos").alias("file_pos"),
    )
    return first.select(
        *keys,
        "ingredient_name",
        F.coalesce(USAGE_RULES[rule](F.col("_amount")), F.lit(0.0)).alias("monthly_usage"),
        "file_pos",
    )


def _ingredients(usage: DataFrame, keys: Sequence[str]) -> DataFrame:
    return usage.groupBy(*keys, "ingredient_name").agg(F.min("file_pos").alias("file_pos"))


def ingredient_map_exact(
    usage: DataFrame, dim: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Every ingredient maps to itself; unmatched ones are flagged new."""
    names = _ingredients(usage, keys)
    known = dim.select(F.col("product").alias("ingredient_name"), F.lit(True).alias("_known"))
    return names.join(known, "ingredient_name", "left").select(
        *keys,
        "ingredient_name",
        F.col("ingredient_name").alias("mapped_product"),
        F.col("_known").isNull().alias("is_new"),
        "file_pos",
    )


# Texts of at least this length are indexed by one of their parts of this length.
GRAM = 6


def _cuts(texts: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """(text, part): the distinct parts of the given lengths. For each length they are
    fewer than the text has characters."""
    sized = texts.select("text", F.explode(F.lit(list(lengths))).alias("_n"))
    at = F.sequence(F.lit(1), F.length("text") - F.col("_n") + 1)
    return (
        sized.filter(F.length("text") >= F.col("_n"))
        .select("text", "_n", F.explode(at).alias("_at"))
        .select("text", F.substring(F.col("text"), F.col("_at"), F.col("_n")).alias("part"))
        .distinct()
    )


def containing(whole: DataFrame, inner: DataFrame) -> DataFrame:
    """(text, inner): every text of ``whole`` with every text of ``inner`` it contains.

    Both have one column ``text`` of distinct texts. A long inner text is indexed by its
    rarest part of ``GRAM`` characters, so a whole text of n characters is cut into
    fewer than n parts, which are looked up and then checked by ``contains``. Inner texts
    shorter than that (fewer than ``GRAM`` lengths) are looked up as they are.
    """
    long = _cuts(inner, [GRAM])
    rarity = long.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))
    index = (
        long.join(rarity, "part").groupBy("text")
        .agg(F.min_by("part", F.struct("_n", "part")).alias("part"))
        .withColumnRenamed("text", "inner")
    )
    by_gram = (
        _cuts(whole, [GRAM]).join(index, "part")
        .filter(F.col("text").contains(F.col("inner")))
        .select("text", "inner")
    )
    short = inner.filter(F.length("text") < GRAM).select(F.col("text").alias("inner"))
    as_is = (
        _cuts(whole, range(1, GRAM))
        .join(short, F.col("part") == F.col("inner")).select("text", "inner")
    )
    return by_gram.unionByName(as_is)


def ingredient_map_fuzzy(
    usage: DataFrame, dim: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Exact product, else the first product in file order where either name
    contains the other ignoring case, else the ingredient itself, flagged new.

    Both sides are reduced to one row per text before ``containing`` finds candidates,
    whose number grows with the length of the names, not with its square.
    """
    names = _ingredients(usage, keys).withColumn("_name", F.lower("ingredient_name"))
    products = (
        dim.filter(~is_blank(F.col("product")))
        .withColumn("_text", F.lower("product"))
        .groupBy("_text")
        .agg(
            F.min_by("product", "file_pos").alias("product"),
            F.min("file_pos").alias("product_pos"),
        )
    )
    wanted = names.select(F.col("_name").alias("text")).distinct()
    known = products.select(F.col("_text").alias("text"))
    inside = containing(wanted, known).select(F.col("text").alias("_name"), F.col("inner").alias("_text"))
    around = containing(known, wanted).select(F.col("inner").alias("_name"), F.col("text").alias("_text"))
    matched = inside.unionByName(around).join(products, "_text")
    partial = (
        matched.groupBy("_name")
        .agg(F.min_by("product", "product_pos").alias("_partial"))
    )
    exact = dim.select(F.col("product").alias("ingredient_name"), F.lit(True).alias("_exact"))
    return (
        names.join(partial, "_name", "left")
        .join(exact, "ingredient_name", "left")
        .select(
            *keys,
            "ingredient_name",
            F.when(F.col("_exact"), F.col("ingredient_name"))
            .otherwise(F.coalesce("_partial", "ingredient_name"))
            .alias("mapped_product"),
            (F.col("_exact").isNull() & F.col("_partial").isNull()).alias("is_new"),
            "file_pos",
        )
    )


def new_ingredients(mapping: DataFrame, dim: DataFrame) -> DataFrame:
    """Ingredients flagged new that the dimension lacks (appended as N/A)."""
    flagged = mapping.filter("is_new").select(F.col("ingredient_name").alias("product"))
    return flagged.distinct().join(dim, "product", "left_anti")


def usage_by_category_fuzzy(
    fact: DataFrame,
    usage: DataFrame,
    mapping: DataFrame,
    rule: str = "annual",
    keys: Sequence[str] = (),
) -> DataFrame:
    """J9 + X2: usage per category through its distinct products.

    A product takes the usage of the first ingredient mapped to it, else of the
    ingredient with its own name. ``fact`` holds product and category.
    """
    products = fact.select(*keys, "category", "product").distinct()
    monthly = monthly_usage(usage, rule, keys).drop("file_pos")
    mapped = (
        mapping.join(monthly, [*keys, "ingredient_name"])
        .groupBy(*keys, F.col("mapped_product").alias("product"))
        .agg(F.min_by("monthly_usage", "file_pos").alias("_mapped"))
    )
    direct = monthly.withColumnsRenamed({"ingredient_name": "product", "monthly_usage": "_direct"})
    return (
        products.join(mapped, [*keys, "product"], "left")
        .join(direct, [*keys, "product"], "left")
        .groupBy(*keys, "category")
        .agg(F.sum(F.coalesce("_mapped", "_direct", F.lit(0.0))).alias("monthly_usage"))
    )
