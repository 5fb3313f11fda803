"""CSV and JSON inputs (S3-S6). Each is optional: an absent file is an empty table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyview.functions import na_normalize
from supplyview.operators.dimension import clean_dimension
from supplyview.operators.usage import clean_headers, clean_usage
from supplyview.schemas import ALIASES, DIMENSION, MAPPING, USAGE
from supplyview.sources.folders import ingest_date_of


def _if_present(spark: SparkSession, load: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
    """What ``load`` gives, or an empty table when no file is there or it is empty."""
    try:
        return load()
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    except EmptyFile:
        pass
    return spark.createDataFrame([], schema)


class EmptyFile(Exception):
    """A CSV file without even a header."""


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """Text columns plus the record's position in its file.

    A multi-line CSV file is never split, so ids given right at the scan follow
    the file order.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    if not raw.columns:
        raise EmptyFile(path)
    return raw.withColumn("file_pos", F.monotonically_increasing_id())


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    """S3: the usage file(s), cleaned, with the date of their folder."""
    schema = T.StructType([*USAGE.fields, T.StructField("ingest_date", T.DateType())])
    return _if_present(spark, lambda: _read_usage(spark, path), schema)


def _read_usage(spark: SparkSession, path: str) -> DataFrame:
    raw = _csv(spark, path).withColumn("ingest_date", ingest_date_of(F.col("_metadata.file_path")))
    named = clean_headers(raw)
    texts = [c for c in named.columns if c not in ("file_pos", "ingest_date")]
    return clean_usage(
        named.select(
            *[na_normalize(F.col(f"`{c}`")).alias(c) for c in texts], "file_pos", "ingest_date"
        )
    )


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The category dimension; ``N/A`` is kept as text."""
    return _if_present(spark, lambda: _read_dimension(spark, path), DIMENSION)


def _read_dimension(spark: SparkSession, path: str) -> DataFrame:
    raw = _csv(spark, path)
    return clean_dimension(
        raw.select(
            F.col("Product").alias("product"), F.col("Category").alias("category"), "file_pos"
        )
    )


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """``(table, product_column, quantity_column)`` from the mapping JSON."""
    entry = T.StructType([MAPPING["product_column"], MAPPING["quantity_column"]])
    schema = T.StructType(
        [T.StructField("table_column_mapping", T.MapType(T.StringType(), entry))]
    )
    read = _if_present(
        spark, lambda: spark.read.schema(schema).option("multiLine", True).json(path), schema
    )
    return read.select(F.explode("table_column_mapping").alias("table", "c")).select(
        "table", "c.product_column", "c.quantity_column"
    )


def mapping_dict(mapping: DataFrame) -> dict[str, tuple[str, str]]:
    """The mapping for use as a literal. It is a configuration of a few entries."""
    return {
        r["table"]: (r["product_column"], r["quantity_column"])
        for r in mapping.collect()
        if r["table"] != "global_usage"
    }


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """``(table, expected, alias)`` from the alias JSON, or from the lines that
    ``sinks.write_aliases`` writes."""
    schema = T.StructType([T.StructField("value", T.StringType())])
    text = _if_present(spark, lambda: spark.read.text(path, wholetext=True), schema)
    nested = (
        text.select(
            F.from_json("value", "map<string, map<string, array<string>>>").alias("tables")
        )
        .select(F.explode("tables").alias("table", "labels"))
        .select("table", F.explode("labels").alias("expected", "aliases"))
    )
    line = F.from_json("line", "table string, expected string, aliases array<string>")
    lines = text.select(F.explode(F.split("value", "\n")).alias("line")).select(
        line.alias("l")
    ).filter("l.table IS NOT NULL AND l.expected IS NOT NULL")
    every = nested.unionByName(lines.select("l.table", "l.expected", "l.aliases"))
    return (
        every.select("table", "expected", F.explode("aliases").alias("alias"))
        .select(*ALIASES.fieldNames())
        .distinct()
    )


def alias_dict(aliases: DataFrame, table: str) -> dict[str, list[str]]:
    """Aliases of one table by expected label, for use as literals (configuration)."""
    found: dict[str, list[str]] = {}
    for r in aliases.filter(F.col("table") == table).orderBy("expected", "alias").collect():
        found.setdefault(r["expected"], []).append(r["alias"])
    return found
