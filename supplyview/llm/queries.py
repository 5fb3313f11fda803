"""The operators over the given tables: one query each, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyview.llm import (
    ann, arrow_tokens, best_fit, centroids, ctw, embedding_dedup, langid, licences, mixing, packing,
    phrases, quality, simhash,
)
from supplyview.llm.common import held_out, table

GOOD_QUALITY = 0.3


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    test = held_out(F.col("doc_id"))
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", ~test)
    return quality.score(docs, model, ["doc_id"]).select(
        "doc_id", test.alias("held_out"), "score",
        (F.col("score") >= GOOD_QUALITY).cast("int").alias("predicted"),
    )


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mix."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op6_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    test = held_out(F.col("doc_id"))
    return langid.language_of(docs, ~test, ["doc_id"]).select(
        "doc_id", test.alias("held_out"), "lang_pred", "score"
    )


def op9_arrow_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_tokens.round_trip(spark, table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_dedup, op2_quality_votes, op3_licence_scan, op4_harmonic_packing,
        op5_pfair_mixing, op6_one_bit_search, op7_context_tree_scores, op8_language_id,
        op9_arrow_tokens, op10_simhash, op11_best_fit_packing,
        op12_centroid_clusters, op13_phrase_collocations,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op3_licence_scan": licences.scan_sql(), "op12_centroid_clusters": centroids.cluster_sql(),
    "op13_phrase_collocations": phrases.mine_sql(),
}
