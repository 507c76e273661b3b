"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idtrail.llm import lines, packing, quality, secrets, simhash
from idtrail.session import work_folder


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the language references come from the stage's own input."""
    return quality.drop_rejected(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that an earlier place has are deleted; every document stays, if with an empty text."""
    return counted(lines.dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id: SimHash of 3-word shingles, links of at most 3 bits."""
    return simhash.keep_one(docs, max_bits=3, shingle=3)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every document stays."""
    return counted(secrets.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, as :func:`idtrail.llm.packing.pack` returns them."""
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES = [
    ("quality", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are a table on shared storage that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark)
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{k}_{name}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
