"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in an order shuffled by a hash, form blocks of ``block`` documents:
by default a ``BLOCKS``-th of all documents, so a mix is equally fine at every size and the plan
is bounded. Sources of fewer documents than a block are pooled: they mix as one source with the sum
of their weights. As their documents and their share both stay below a block, so does what
they are off.
A source of weight w releases its block i at slot floor(i / w) and must have it placed by
slot ceil((i + 1) / w); the earliest deadline goes first, ties to the source first in
order. So at any slot a source has had less than one block more or less than its share.

Weights in the ratio of whole numbers that add up to ``period`` or less give a schedule that repeats, of which one period is
worked out. Others are rounded so finely that over all blocks and sources the
error stays below ``SLACK`` blocks, and the schedule is worked out slot by slot: the driver
takes a step, and broadcasts a number, per block. Both are bounded by ``BLOCKS`` and one
partly filled block per source that is not pooled, of which there are at most ``BLOCKS``. When a source
runs out, a new phase begins with the weights of the rest. All documents are placed once, none is repeated.

Weights default to shares of documents to the power ``temper``. Sources without a weight, or
with one that is not positive, follow when the others have run out, by their sizes.
Null is a source of its own. Repeated rows are documents of their own. An empty table gives no
rows. All columns are kept; the added ones are ``slot`` (of the block) and ``position``
(increasing; a source's last block may leave numbers out), in the place of columns of
these names, which go.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyview.session import stage
from supplyview.llm.common import parts

# Blocks of a mix, and so the most the driver plans.
BLOCKS = 1 << 18
PERIOD = 10_000
# Named apart from all sources, whose names begin with "=" or are empty.
POOL, REST = "pool", "rest"
# The most that rounded weights may be off over a whole phase, in blocks.
SLACK = 1e-6


def whole(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the ratio of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * scale) for s, w in exact.items()}


def rounded(weights: dict[str, float], period: int) -> dict[str, int]:
    """Weights as whole numbers that add up to the period, each at least one."""
    weights = whole(weights)
    total = sum(weights.values())
    period = max(period, len(weights))
    out = {s: max(1, w * period // total) for s, w in weights.items()}
    over = sum(out.values()) - period
    if over < 0:
        for s in sorted(weights, key=lambda s: (out[s] * total - weights[s] * period, s))[:-over]:
            out[s] += 1
    largest = [(-n, s) for s, n in out.items()]
    heapq.heapify(largest)
    for _ in range(over):
        n, s = largest[0]
        out[s] -= 1
        heapq.heapreplace(largest, (n + 1, s))
    return out


def shares_of(weights: dict[str, int], n_blocks: int, period: int) -> dict[str, int]:
    """Whole weights as numbers that add up to a period, less than ``SLACK`` blocks off in so many blocks."""
    common = math.gcd(*weights.values())
    weights = {s: n // common for s, n in weights.items()}
    total = sum(weights.values())
    if total <= period:
        return weights
    shares = rounded(weights, period)
    length = sum(shares.values())
    off = max(abs(n * total - weights[s] * length) for s, n in shares.items())
    if off * n_blocks / (length * total) < SLACK:
        return shares
    # A share is off by less than one, the largest by one more per source that has less than one.
    # Columns hold 64 bits; beyond them the error grows, to a fifth of a block for 10^12 blocks of 10^6 sources.
    return rounded(weights, min(int(n_blocks * (len(weights) + 1) / SLACK) + 1, 2**62))


def in_turn(shares: dict[str, int], left: dict[str, int]) -> tuple[dict[str, list[int]], int]:
    """The slots of each source's blocks until one has none left, and their number:
    earliest deadline first among released."""
    period = sum(shares.values())
    slots: dict[str, list[int]] = {s: [] for s in shares}
    waiting = [(0, s, 0) for s in sorted(shares)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * period // shares[s]), s, i))
        _, s, i = heapq.heappop(ready)
        if i == left[s]:
            return slots, slot
        slots[s].append(slot)
        if i + 1 < shares[s]:
            heapq.heappush(waiting, ((i + 1) * period // shares[s], s, i + 1))
    return slots, period


def phases(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> list[tuple]:
    """(source, first block, end block, first slot, period, blocks per period, slots) by phase."""
    weights = whole({s: w for s, w in weights.items() if w > 0})
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    out, slot = [], 0
    while left:
        given = {s: weights[s] for s in left if s in weights}
        given = given or left
        shares = shares_of(given, sum(left[s] for s in given), period)
        length = sum(shares.values())
        slots, end = in_turn(shares, left)
        if end == length:
            # Where each source would need a block it does not have.
            end = min(left[s] // n * length + slots[s][left[s] % n] for s, n in shares.items())
        for s, n in shares.items():
            used = end // length * n + bisect_left(slots[s], end % length)
            if used:
                out.append((s, done[s], done[s] + used, slot, length, n, slots[s]))
            done[s] += used
            left[s] -= used
        left = {s: n for s, n in left.items() if n > 0}
        slot += end
    return out


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    source: str = "source",
    key: str = "doc_id",
    block: int | None = None,
    period: int = PERIOD,
    temper: float = 0.7,
    seed: int = 1,
    names: tuple[str, str] = ("slot", "position"),
) -> DataFrame:
    """``docs`` with slot and position; order by position to get the mix."""
    spark = docs.sparkSession
    named = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    # The row's columns stay together, so their names meet none of those added here.
    every = docs.select(
        F.struct(*docs.columns).alias("_row"), named.alias("_source"),
        F.xxhash64(F.lit(seed), F.col(key)).alias("_order"), F.col(key).alias("_key"),
    )
    counted = stage(every.groupBy("_source").agg(F.count(F.lit(1)).alias("_n")), "mix-sizes")
    total = counted.agg(F.sum("_n")).first()[0] or 0
    block = block or parts(total, BLOCKS)
    if weights is None:
        weighed = counted.withColumn("_w", F.pow(F.col("_n") / float(max(total, 1)), F.lit(temper)))
    else:
        given = [("" if x is None else f"={x}", float(w)) for x, w in weights.items() if w > 0]
        listed = F.broadcast(spark.createDataFrame(given, "_source string, _w double"))
        weighed = counted.join(listed, "_source", "left")
    # At most as many sources as blocks have a block of their own; the others are pooled,
    # those with a weight apart from those without.
    large = weighed.filter(F.col("_n") >= block)
    # Shares of the largest weight add up in any order; one that is too small still counts.
    most = weighed.agg(F.max("_w")).first()[0] or 1.0
    share = F.greatest((F.col("_w") / most).cast("decimal(38,18)"), F.lit("1e-18").cast("decimal(38,18)"))
    pooled = (
        weighed.filter(F.col("_n") < block).groupBy(F.col("_w").isNotNull().alias("_weighed"))
        .agg(F.sum("_n").alias("_n"), (F.sum(share).cast("double") * most).alias("_w"))
        .select(
            F.when(F.col("_weighed"), F.lit(POOL)).otherwise(F.lit(REST)).alias("_source"), "_n",
            F.when(F.col("_weighed"), F.col("_w")).alias("_w"),
        )
    )
    planned = large.select("_source", "_n", "_w").union(pooled).collect()
    sizes = {r["_source"]: r["_n"] for r in planned}
    goal = {r["_source"]: r["_w"] for r in planned if r["_w"] is not None}
    own = F.broadcast(large.select("_source", F.lit(True).alias("_large")))
    keyed = every.join(own, "_source", "left")
    pool = F.lit(POOL)
    if weights is not None:
        keyed = keyed.join(listed, "_source", "left")
        pool = F.when(F.col("_w").isNotNull(), pool).otherwise(F.lit(REST))
    keyed = keyed.withColumn("_source", F.when(F.col("_large"), F.col("_source")).otherwise(pool)).select(
        "_row", "_source", "_order", "_key"
    )
    # Sorted rows are numbered within their partition. A source's rows may span partitions:
    # its first number in each, and the rows in earlier ones, give the place in the source.
    spread = keyed.repartitionByRange("_source", "_order").sortWithinPartitions("_source", "_order", "_key")
    numbered = stage(
        spread.select("_row", "_source", F.monotonically_increasing_id().alias("_number")), "mix-numbered"
    ).withColumn("_part", F.shiftright("_number", 33))
    earlier = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        numbered.groupBy("_source", "_part")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_number").alias("_first"))
        .select("_source", "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    )
    plan = phases({s: parts(n, block) for s, n in sizes.items()}, goal, period)
    # Every row of the plan has a block, and every block a number.
    table = spark.createDataFrame(
        plan, "_source string, _b0 long, _b1 long, _slot0 long, _length long, _share long, _slots array<int>"
    )
    local = F.col("_block") - F.col("_b0")
    placed = (
        numbered.join(shifts, ["_source", "_part"])
        .withColumn("_index", F.col("_number") + F.col("_shift"))
        .withColumn("_block", F.floor(F.col("_index") / block))
        .join(F.broadcast(table), ["_source"])
        .filter((F.col("_block") >= F.col("_b0")) & (F.col("_block") < F.col("_b1")))
    )
    slot = (
        F.col("_slot0")
        + F.floor(local / F.col("_share")) * F.col("_length")
        + F.element_at("_slots", (local % F.col("_share") + 1).cast("int"))
    )
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    return placed.withColumn("_slot", slot.cast("long")).select(
        *kept, F.col("_slot").alias(names[0]),
        (F.col("_slot") * block + F.col("_index") % block).alias(names[1]),
    )


def in_order(mixed: DataFrame, names: tuple[str, str] = ("slot", "position")) -> DataFrame:
    """Rows by position over the files they are written to, without the added columns."""
    return mixed.repartitionByRange(F.col(names[1])).sortWithinPartitions(names[1]).drop(*names)
