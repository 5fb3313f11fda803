"""Documents through five stages, each written and read again: language, quality, near
duplicates, mixing, packing.

Each stage takes the documents its predecessor kept, with all their columns, whatever
their names, and works on all of them. The first four return the same columns; rows are
never changed. An empty table passes through all stages.

* ``language`` drops documents without a language: null texts, texts without letters, and texts
  of which no language has half the letters.
* ``quality`` drops documents scored below 0.3 by the labelled documents' votes; without
  labels nothing is dropped.
* ``near_duplicates`` keeps the row with the smallest doc_id of each group linked by SimHash
  (three words, three bits); of equal ids the one whose text has the smaller hash, then the one
  read first. Rows of one doc_id whose texts are not linked all stay. Rows without a doc_id
  belong to no group and stay.
* ``mix`` writes the documents in the order of the mix, by their sources' tempered shares.
* ``pack`` returns the pieces of sequences of 1024 tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyview.llm import langid, mixing, packing, quality, simhash
from supplyview.llm.common import free_name, held_out, prepared, table
from supplyview.llm.queries import GOOD_QUALITY
from supplyview.session import current_folder, run_folder, stage

LEAST_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    names = tuple(free_name(docs, n) for n in ("lang_pred", "lang_score", "spans"))
    labelled = langid.language_of(docs, ~held_out(F.col("doc_id")), docs.columns, names=names)
    good = (F.col(names[0]) != langid.UND) & (F.col(names[1]) >= LEAST_SHARE)
    return labelled.filter(good).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    name = free_name(docs, "quality_score")
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, "quality", ~held_out(F.col("doc_id")))
    return quality.score(docs, model, docs.columns, name).filter(F.col(name) >= GOOD_QUALITY).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    row, first = free_name(docs, "row_number"), free_name(docs, "first_row")
    # Rows get numbers of their own: a doc_id may have several texts, and they are not linked by it.
    # A scan gives every row the same place each time; what a shuffle gives is written first.
    if "Exchange" in docs._jdf.queryExecution().executedPlan().toString():
        docs = stage(docs, "pipeline-rows")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    named = rows.filter(F.col("doc_id").isNotNull())
    linked = simhash.near_duplicates(
        named.select(F.col(row).alias("doc_id"), "text"), shingle=3, radius=3
    ).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct("doc_id", F.xxhash64("text").alias("_hash"), row)
    kept = (
        named.select(row, order.alias(first)).join(linked, row)
        .groupBy("component_id").agg(F.min(first)[row].alias(row))
        .select(row)
    )
    unnamed = rows.filter(F.col("doc_id").isNull())
    return named.join(kept, row, "left_semi").unionByName(unnamed).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    names = (free_name(docs, "slot"), free_name(docs, "position"))
    return mixing.in_order(mixing.mix(docs, names=names), names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return packing.pack(docs)


STAGES = [
    ("language", language), ("quality", good_quality), ("near_duplicates", near_duplicates),
    ("mix", mix), ("pack", pack),
]

# Viterbi, singular vectors, XXH64 fingerprints and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What the stages staged on the way is removed; the rows
    themselves lie in the current folder, as a checkpoint would."""
    docs = table(spark, sf_dir, "documents")
    place = current_folder(spark)
    final = f"{place}/pipeline-{uuid.uuid4().hex}"
    with run_folder(spark, f"{place}/pipeline-run-{uuid.uuid4().hex}"):
        for name, step in STAGES[:-1]:
            docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        last = STAGES[-1][1](spark, docs, sf_dir)
        last.write.parquet(final)
    return spark.read.schema(last.schema).parquet(final)
