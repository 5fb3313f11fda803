"""Lookup joins that hold up when one key owns a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyview.session import stage

# A dimension up to this size is broadcast; beyond it the keys are shuffled.
BROADCAST_BYTES = 64 * 1024 * 1024

# A key is hot when it owns more than 1/HOT_SHARE of the rows, so there are
# fewer than HOT_SHARE hot keys however large the data is.
HOT_SHARE = 1000


def measured_bytes(df: DataFrame) -> int:
    """Rough in-memory size: text widths plus 16 bytes per field (one small aggregate)."""
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16
        for c in df.columns
    ]
    row = df.agg(F.sum(sum(widths[1:], widths[0])).alias("n")).first()
    return int(row["n"] or 0)


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join of ``facts`` to ``dim`` (unique on ``on``).

    A small dimension is broadcast after its size was measured. A large one is
    shuffled; the few hot keys are then looked up through a broadcast of their
    dimension rows (fewer than ``HOT_SHARE`` rows) and never meet in one task.
    """
    on = list(on)
    if measured_bytes(dim) <= broadcast_bytes:
        return facts.join(F.broadcast(dim), on, "left")
    return split_hot_join(facts, dim, on)


def hot_keys(facts: DataFrame, on: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys owning more than ``1/share`` of the rows; fewer than ``share`` of them."""
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    return counts.filter(F.col("_n") * share > total.scalar()).select(*on)


def split_hot_join(
    facts: DataFrame, dim: DataFrame, on: Sequence[str], share: int = HOT_SHARE
) -> DataFrame:
    """The join for a dimension too large to broadcast.

    The facts are staged first: counting, marking and both joins read them.
    """
    on = list(on)
    facts = stage(facts, "facts")
    hot = hot_keys(facts, on, share).withColumn("_hot", F.lit(True))
    hot_dim = F.broadcast(dim.join(F.broadcast(hot), on, "inner"))
    # Null keys match nothing; they stay with the hot rows, which are not shuffled.
    has_null = F.lit(False)
    for c in on:
        has_null = has_null | F.col(c).isNull()
    marked = facts.join(F.broadcast(hot), on, "left").withColumn(
        "_hot", F.coalesce(F.col("_hot"), has_null)
    )
    warm = marked.filter("_hot").drop("_hot").join(hot_dim.drop("_hot"), on, "left")
    cold = marked.filter("not _hot").drop("_hot").join(dim, on, "left")
    return warm.unionByName(cold)
