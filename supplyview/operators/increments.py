"""Category sums kept by deltas instead of anew.

Two tables are kept: partial sums of the fact by (keys, product, status), and from them sums by
(keys, category, status). A changed dimension moves the partial sums of its changed products
from one category to the other; a new date replaces its own rows. Pivots and projections
are then computed from the refreshed sums, which are small.

Amounts are decimals of nine digits after the point, so what is taken away is exactly what was
added, and a category left without rows goes. A null quantity counts as a row without an amount. Null products and
statuses are values like others.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyview.functions import strip
from supplyview.operators.joins import lookup_join
from supplyview.schemas import USAGE_STATUS

AMOUNT = "decimal(28,9)"
# Products are stored by buckets of a hash, so that the changed ones are found without reading all.
BUCKETS = 64


def _total(column: str = "quantity") -> Column:
    return F.coalesce(F.sum(F.col(column)), F.lit(0)).cast("decimal(38,9)").alias("quantity")


def partial_sums(fact: DataFrame, keys: Sequence[str] = ("ingest_date",)) -> DataFrame:
    """The fact by keys, product and status, whatever the products' categories are."""
    rows = F.col("n_rows") if "n_rows" in fact.columns else F.lit(1)
    return (
        fact.select(*keys, "product", "status", F.col("quantity").cast(AMOUNT), rows.cast("bigint").alias("n_rows"))
        .groupBy(*keys, "product", "status")
        .agg(_total(), F.sum("n_rows").alias("n_rows"))
    )


def _category(known: Column) -> Column:
    """An unknown product has no category, an unknown ingredient its own name."""
    own = F.when(F.col("status") == USAGE_STATUS, F.col("product")).otherwise("")
    return F.coalesce(known, own)


def category_sums(partials: DataFrame, dim: DataFrame, keys: Sequence[str] = ("ingest_date",)) -> DataFrame:
    """(keys, category, status, quantity, n_rows) of all partial sums."""
    known = dim.select(F.col("product").alias("_product"), F.coalesce("category", F.lit("")).alias("_category"))
    found = lookup_join(partials.withColumn("_product", strip(F.col("product"))), known, ["_product"])
    return _summed(found.withColumn("category", _category(F.col("_category"))), keys)


def _summed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "category", "status").agg(_total(), F.sum("n_rows").alias("n_rows"))


def changed_categories(before: DataFrame, after: DataFrame) -> DataFrame:
    """(product, old, new) of the products whose category differs; null where a dimension lacks it."""
    def side(dim: DataFrame, name: str) -> DataFrame:
        return dim.select("product", F.coalesce("category", F.lit("")).alias(name))

    both = side(before, "old").join(side(after, "new"), "product", "full")
    return both.filter(~F.col("old").eqNullSafe(F.col("new")))


def moved(partials: DataFrame, changes: DataFrame, keys: Sequence[str] = ("ingest_date",)) -> DataFrame:
    """What the changes add to, and take away from, the category sums."""
    own = partials.withColumn("_product", strip(F.col("product"))).join(
        changes.withColumnRenamed("product", "_product"), "_product"
    )
    ways = F.array(
        F.struct(_category(F.col("old")).alias("category"), F.lit(-1).alias("sign")),
        F.struct(_category(F.col("new")).alias("category"), F.lit(1).alias("sign")),
    )
    signed = own.select(*keys, "status", "quantity", "n_rows", F.inline(ways))
    return _summed(
        signed.select(
            *keys, "category", "status",
            F.when(F.col("sign") < 0, -F.col("quantity")).otherwise(F.col("quantity")).alias("quantity"),
            (F.col("n_rows") * F.col("sign")).alias("n_rows"),
        ),
        keys,
    )


def refreshed(sums: DataFrame, *deltas: DataFrame, keys: Sequence[str] = ("ingest_date",)) -> DataFrame:
    """The sums with the deltas applied; categories without rows are gone."""
    return _summed(reduce(DataFrame.unionByName, deltas, sums), keys).filter("n_rows <> 0")


def replaced_dates(old: DataFrame, new: DataFrame, date: str = "ingest_date") -> DataFrame:
    """``old`` with the dates of ``new`` replaced by it. One short row per day is broadcast."""
    days = F.broadcast(new.select(date).distinct())
    return old.join(days, date, "left_anti").unionByName(new)


# --- storage -------------------------------------------------------------------


def bucket(product: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(strip(product)), F.lit(buckets)).cast("int")


def write_partials(partials: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store partial sums by date, in place of the dates they hold, and within a date in order of
    buckets. What was read from here must be written elsewhere before."""
    by = ("ingest_date", "bucket", "product")
    (
        partials.withColumn("bucket", bucket(F.col("product"), buckets))
        .repartitionByRange("ingest_date", "bucket").sortWithinPartitions(*by)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date").parquet(path)
    )


def read_partials(
    spark: SparkSession, path: str, changes: DataFrame | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Stored partial sums, or those in the buckets of the changed products alone.

    At most a number per bucket is collected; the filter reaches the scan, which skips the
    row groups of other buckets.
    """
    stored = spark.read.parquet(path)
    if changes is not None:
        some = changes.select(bucket(F.col("product"), buckets).alias("b")).distinct().collect()
        stored = stored.filter(F.col("bucket").isin([r["b"] for r in some]))
    return stored.drop("bucket")
