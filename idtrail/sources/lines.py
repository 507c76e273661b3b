"""Line-oriented sources, read in splits; nothing here needs a whole file in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from idtrail.functions import clean as C
from idtrail.operators.rows import trim_rows

# Lines before and rows after the data in the accession lists.
SECONDARY_PREAMBLE = 31
DELETED_PREAMBLE = 27
DELETED_FOOTER = 4


def scan_lines(spark: SparkSession, path) -> DataFrame:
    """Lines with their file and an order within the file: (file, block, place, value).

    ``block`` is the start of the split and ``place`` grows with the lines of a split.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def trim_lines(lines: DataFrame, head: int = 0, tail: int = 0) -> DataFrame:
    """Lines without the first ``head`` lines of each file, then without blank lines, then without
    the last ``tail`` lines of each file."""
    return trim_rows(lines, "file", ["block", "place"], head, tail, F.trim("value") != "")


def scan_fasta_ids(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).select(C.fasta_accession("value").alias("primaryID")).where("primaryID IS NOT NULL")


def scan_secondary_accessions(spark: SparkSession, path, skip: int = SECONDARY_PREAMBLE) -> DataFrame:
    """(secondaryID, primaryID) of a two-column list after its preamble."""
    return secondary_accessions(trim_lines(scan_lines(spark, path), skip))


def secondary_accessions(lines: DataFrame) -> DataFrame:
    parts = F.split(F.trim("value"), r"\s+")
    return lines.select(F.get(parts, 0).alias("secondaryID"), F.get(parts, 1).alias("primaryID"))


def scan_deleted_accessions(
    spark: SparkSession, path, skip: int = DELETED_PREAMBLE, footer: int = DELETED_FOOTER
) -> DataFrame:
    """(secondaryID) of a one-column list between its preamble and its footer."""
    lines = trim_lines(scan_lines(spark, path), skip, footer)
    return lines.select(C.without_blanks(F.get(F.split(F.trim("value"), r"\s+"), 0)).alias("secondaryID"))
