"""Status pivot, usage, projections and risk flags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyview.functions import format_quantity, is_blank
from supplyview.operators.facts import is_acknowledged, usage_rows
from supplyview.schemas import (
    ALL_STATUSES,
    INVENTORY_STATUS,
    PROJECTION_MONTHS,
    TOTAL,
    UNCATEGORIZED,
    USAGE_STATUS,
)

MONTHLY_USAGE = "Monthly Usage"


def projection_name(month: int) -> str:
    return f"{month} Month Projection"


def category_label(category: Column) -> Column:
    """Blank categories are Uncategorized."""
    return F.when(is_blank(category), F.lit(UNCATEGORIZED)).otherwise(category)


def category_status_sums(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum per (category, status) without the acknowledged products.

    Everything below works on this small table, so the fact is read once.
    """
    return (
        fact.filter(~is_acknowledged(F.col("category")))
        .groupBy(*keys, category_label(F.col("category")).alias("category"), "status")
        .agg(F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("quantity"))
    )


def product_sums(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The fact by product, status and category: its quantity and number of rows.

    A product owning most rows is a few rows here; the reports read this table.
    """
    return fact.groupBy(*keys, "product", "status", "category").agg(
        F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n_rows")
    )


def statuses_of(sums: DataFrame) -> list[str]:
    """Statuses present, A-Z. One per mapped table, so the list is short."""
    return [r["status"] for r in sums.select("status").distinct().orderBy("status").collect()]


def status_pivot(
    sums: DataFrame, statuses: Sequence[str] = ALL_STATUSES, keys: Sequence[str] = ()
) -> DataFrame:
    """A1: one column per status, 0 where a category has none of it.

    With the statuses known, one aggregate of conditional sums is one shuffle; a
    ``pivot`` would take two.
    """

    def total(status: str) -> Column:
        return F.sum(F.when(F.col("status") == status, F.col("quantity")))

    return sums.groupBy(*keys, "category").agg(
        *[F.coalesce(total(s), F.lit(0.0)).alias(s) for s in statuses]
    )


def row_total(statuses: Sequence[str]) -> Column:
    """A2: sum of the status columns without usage."""
    counted = [F.col(f"`{s}`") for s in statuses if s != USAGE_STATUS]
    return reduce(add, counted, F.lit(0.0))


def _with_total_rows(sums: DataFrame) -> DataFrame:
    """Every row a second time under the TOTAL label (cheap: ``sums`` is aggregated)."""
    labels = F.array(
        F.struct(F.lit(False).alias("is_total"), F.col("category").alias("category")),
        F.struct(F.lit(True).alias("is_total"), F.lit(TOTAL).alias("category")),
    )
    rest = [c for c in sums.columns if c != "category"]
    return sums.select(*rest, F.explode(labels).alias("_l")).select(
        *rest, F.col("_l.is_total").alias("is_total"), F.col("_l.category").alias("category")
    )


def ordered_statuses(statuses: Sequence[str]) -> list[str]:
    """Statuses A-Z without usage; usage stands right of TOTAL."""
    return sorted(s for s in statuses if s != USAGE_STATUS)


def pivot_with_totals(
    sums: DataFrame, statuses: Sequence[str] = ALL_STATUSES, keys: Sequence[str] = ()
) -> DataFrame:
    """A1-A4: the pivot, a TOTAL column without usage and a TOTAL row, in order."""
    wide = status_pivot(_with_total_rows(sums), statuses, [*keys, "is_total"])
    usage = [USAGE_STATUS] if USAGE_STATUS in statuses else []
    return (
        wide.withColumn(TOTAL, row_total(statuses))
        .orderBy(*keys, "is_total", "category")
        .select(*keys, "category", *ordered_statuses(statuses), TOTAL, *usage)
    )


def usage_by_category(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A5: usage per category, acknowledged products left out."""
    return (
        usage_rows(fact)
        .filter(~is_acknowledged(F.col("category")))
        .groupBy(*keys, category_label(F.col("category")).alias("category"))
        .agg(F.sum("quantity").alias("monthly_usage"))
    )


def projected(total: Column, usage: Column, month: Column | int) -> Column:
    """A missing total or usage counts as 0."""
    return F.coalesce(total, F.lit(0.0)) - F.coalesce(usage, F.lit(0.0)) * month


def category_plan(
    sums: DataFrame,
    usage: DataFrame | None = None,
    legacy_zero_total: bool = False,
    keys: Sequence[str] = (),
) -> DataFrame:
    """(category, total, inventory, monthly_usage): what projections start from.

    ``usage``: monthly usage per category, else the sums' own usage status (J8);
    a category known only from usage still gets a row.
    """
    counted = F.col("status") != USAGE_STATUS
    base = sums.groupBy(*keys, "category").agg(
        F.coalesce(F.sum(F.when(counted, F.col("quantity"))), F.lit(0.0)).alias("total"),
        F.coalesce(
            F.sum(F.when(F.col("status") == INVENTORY_STATUS, F.col("quantity"))), F.lit(0.0)
        ).alias("inventory"),
        F.coalesce(F.sum(F.when(~counted, F.col("quantity"))), F.lit(0.0)).alias("monthly_usage"),
    )
    if usage is not None:
        base = (
            base.drop("monthly_usage")
            .join(usage.select(*keys, "category", "monthly_usage"), [*keys, "category"], "full")
            .na.fill(0.0, ["total", "inventory", "monthly_usage"])
        )
    return base.withColumn("total", F.lit(0.0)) if legacy_zero_total else base


def projection_long(
    plan: DataFrame, months: Sequence[int] = PROJECTION_MONTHS, keys: Sequence[str] = ()
) -> DataFrame:
    """One row per category and month."""
    return plan.withColumn("month", F.explode(F.lit(list(months)))).select(
        *keys,
        "category",
        "month",
        "total",
        "monthly_usage",
        projected(F.col("total"), F.col("monthly_usage"), F.col("month")).alias("projection"),
    )


def enhanced_pivot(
    sums: DataFrame,
    usage: DataFrame | None = None,
    statuses: Sequence[str] = ALL_STATUSES,
    legacy_zero_total: bool = False,
    months: Sequence[int] = PROJECTION_MONTHS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Pivot with totals, monthly usage and projections, TOTAL row last.

    Without ``usage`` the monthly usage is the sums' usage status.
    """
    totalled = _with_total_rows(sums)
    by = [*keys, "is_total", "category"]
    wide = status_pivot(totalled, statuses, [*keys, "is_total"])
    if usage is None:
        wide = wide.withColumn(MONTHLY_USAGE, F.col(f"`{USAGE_STATUS}`"))
    else:
        per_label = (
            _with_total_rows(usage.select(*keys, "category", "monthly_usage"))
            .groupBy(*by)
            .agg(F.sum("monthly_usage").alias(MONTHLY_USAGE))
        )
        wide = wide.join(per_label, by, "full").na.fill(0.0, [*statuses, MONTHLY_USAGE])
    wide = wide.withColumn(TOTAL, row_total(statuses))
    start = F.lit(0.0) if legacy_zero_total else F.col(TOTAL)
    shown_usage = [USAGE_STATUS] if USAGE_STATUS in statuses else []
    return (
        wide.select(
            "*",
            *[
                projected(start, F.col(f"`{MONTHLY_USAGE}`"), m).alias(projection_name(m))
                for m in months
            ],
        )
        .orderBy(*by)
        .select(
            *keys,
            "category",
            *ordered_statuses(statuses),
            TOTAL,
            *shown_usage,
            MONTHLY_USAGE,
            *[projection_name(m) for m in months],
        )
    )


def inventory_flag(inventory: Column, usage: Column) -> Column:
    """Critical (empty stock), red (under one month), yellow (under two)."""
    stock, need = F.coalesce(inventory, F.lit(0.0)), F.coalesce(usage, F.lit(0.0))
    return (
        F.when(stock <= 0, "critical")
        .when((need > 0) & (stock < need), "red")
        .when((need > 0) & (stock < 2 * need), "yellow")
        .otherwise("none")
    )


def projection_flag(total: Column, usage: Column, month: Column | int) -> Column:
    """no_stock when there never was any, stockout when it runs out by the month."""
    held, need = F.coalesce(total, F.lit(0.0)), F.coalesce(usage, F.lit(0.0))
    return (
        F.when((held == 0) & (need > 0), "no_stock")
        .when((held != 0) & (need > 0) & (held - need * month < 0), "stockout")
        .otherwise("none")
    )


def is_negative_projection(projection: Column) -> Column:
    """X10."""
    return projection < 0


def pivot_display(
    pivot: DataFrame, statuses: Sequence[str] = ALL_STATUSES, months: Sequence[int] = PROJECTION_MONTHS
) -> DataFrame:
    """X11: the enhanced pivot as display text."""
    two_decimals = {USAGE_STATUS, MONTHLY_USAGE, *[projection_name(m) for m in months]}

    def shown(name: str) -> Column:
        if name in two_decimals:
            return format_quantity(F.col(f"`{name}`"), 2).alias(name)
        if name in statuses or name == TOTAL:
            return format_quantity(F.col(f"`{name}`"), 0, plain_negatives=True).alias(name)
        return F.col(f"`{name}`")

    return pivot.select(*[shown(c) for c in pivot.columns])
