"""Graph data as a table of triples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRIPLE_COLUMNS = ("subject", "predicate", "object", "lang")


def scan_triples(spark: SparkSession, path) -> DataFrame:
    """(subject, predicate, object, lang); lay it out partitioned by predicate to read only what is asked."""
    return spark.read.parquet(path).select(*TRIPLE_COLUMNS)


def write_triples(df: DataFrame, path: str) -> None:
    df.select(*TRIPLE_COLUMNS).write.mode("overwrite").partitionBy("predicate").parquet(path)
