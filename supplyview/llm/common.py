"""Helpers the operators share: tables, splits, sizes, hot groups, components."""

from __future__ import annotations

import math
import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyview.session import stage

# Bytes without which ASCII words are split, as bytes.split() does.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


# Rows of an Arrow batch. Texts are wide, and a worker holds a batch several times over.
BATCH_ROWS = 1000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


WORKER_MEMORY = {
    "MALLOC_MMAP_THRESHOLD_": "2000000", "MALLOC_TRIM_THRESHOLD_": "8000000",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def prepared(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, give memory
    back, and get small Arrow batches unless the session says otherwise.

    A cluster has the package installed or shipped; then the path adds nothing.
    """
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    environment = spark.sparkContext.environment
    # Large arrays go back to the system when freed, not into a worker's heap.
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    known = environment.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, PACKAGE_ROOT) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the key as text, modulo ``folds``; -1 where the key is null."""
    crc = F.crc32(key.cast("string").cast("binary"))
    return F.coalesce((crc % folds).cast("int"), F.lit(-1))


def held_out(key: Column, remainder: int = 0) -> Column:
    return fold(key) == remainder


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts (one small aggregate); sizes of blocks follow from it."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)


def parts(total_bytes: int, each: int, least: int = 1) -> int:
    return max(least, math.ceil(total_bytes / each))


def group_chunks(
    rows: DataFrame, keys: Sequence[str], item: str, chunk: int = 1000
) -> DataFrame:
    """Groups of at least two rows as (keys, part_i, part_j, members), each bounded.

    ``members`` holds (side, *the other columns). A group of up to ``chunk`` rows is
    one list with i = j. A larger one is dealt into chunks by a hash of ``item``;
    each pair of chunks becomes a list of its own, so that every two members meet
    at least once and no list grows with the group. Members of the same chunk meet in the
    list with i = j only: with i < j, pairs are those of side 0 with side 1.
    """
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    n = F.ceil(F.col("_n") / chunk).cast("int")
    own = F.pmod(F.xxhash64(F.col(item), F.lit("chunk")), F.col("_chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    met = (
        rows.join(sizes, keys)
        .withColumn("_chunks", n)
        .withColumn("_own", own)
        .select(*keys, *rest, "_own", other.alias("_other"))
    )
    first = F.col("_own") <= F.col("_other")
    member = F.struct((~first).cast("int").alias("side"), *[F.col(c) for c in rest])
    dealt = met.select(
        *keys,
        F.least("_own", "_other").alias("part_i"),
        F.greatest("_own", "_other").alias("part_j"),
        member.alias("_member"),
    )
    # Dealt anew by chunk, or the chunks of a large group would stay in one task.
    return (
        dealt.repartition(*keys, "part_i", "part_j")
        .groupBy(*keys, "part_i", "part_j")
        .agg(F.collect_list("_member").alias("members"))
        .filter(F.size("members") > 1)
    )


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows with an id and a vector without null or non-finite components, not all zero."""
    v = F.col(vector)
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    nonzero = F.exists(v, lambda x: x != 0)
    return rows.filter(F.col(key).isNotNull() & v.isNotNull() & finite & nonzero)


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return int(row["n"]), int(row["h"] or 0)


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(node, component) of all linked nodes; component is the smallest node reachable.

    ``edges`` has long columns (a, b) in any direction. Alternating large-star and
    small-star rounds: each round hooks neighbours onto the smallest one by
    aggregates and joins, so no task holds a component; the number of rounds grows
    with the logarithm of the size. Every round is a table in the shared folder.
    """
    def oriented(df: DataFrame) -> DataFrame:
        return (
            df.filter("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct()
        )

    edges = stage(oriented(edges), name)
    before = _signature(edges)
    for _ in range(most_rounds):
        if before[0] == 0:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = oriented(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
        )
        edges = stage(oriented(small), name)
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def schema_of(df: DataFrame) -> str:
    """The columns of ``df`` as a schema string."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
