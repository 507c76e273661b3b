"""Source manifests: one ``key=value`` file per source, in a folder named after the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from idtrail.operators.joins import grouped, lookup
from idtrail.sources import files as W


def scan_manifest(spark: SparkSession, path) -> DataFrame:
    """(datasource, key, value); an empty value is NULL. The files may be many: tasks find and read them."""
    folder = F.regexp_extract("path", "([^/]+)/[^/]+$", 1)
    if place := W.task_path(spark, path):
        text = F.regexp_replace(F.col("content").cast("string"), "^\ufeff", "")
        lines = W.read_files(spark, place).select("path", F.explode(F.split(text, "\r\n|\r|\n")).alias("value"))
    else:
        # file_path is URI-encoded
        name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        lines = spark.read.text(path).select(name.alias("path"), "value")
    return manifest_entries(lines.select(folder.alias("datasource"), "value"))


def manifest_entries(lines: DataFrame) -> DataFrame:
    parts = F.split("value", "=", 2)
    rows = lines.where(F.col("value").contains("="))
    value = F.nullif(F.trim(F.get(parts, 1)), F.lit(""))
    return rows.select("datasource", F.trim(F.get(parts, 0)).alias("key"), value.alias("value"))


def manifest_list(manifest: DataFrame, key: str, out: str = "item") -> DataFrame:
    """One row per element of a comma list."""
    rows = manifest.where(F.col("key") == key)
    return rows.select("datasource", F.explode(F.split("value", ",")).alias(out))


def with_metadata(df: DataFrame, manifest: DataFrame, key: str, out: str, datasource: str = "datasource") -> DataFrame:
    """Attaches one manifest value to each row by its source."""
    values = grouped(manifest.where(F.col("key") == key), ["datasource"]).agg(F.min("value").alias(out)).drop("__apart")
    return lookup(df, values.withColumnRenamed("datasource", datasource), [datasource])


def manifest_inputs(manifest: DataFrame, key: str = "inputs") -> DataFrame:
    """(datasource, name, value) per element ``name:value`` of the list of inputs; an element without a colon has no value."""
    parts = F.split("item", ":", 2)
    rows = manifest_list(manifest, key)
    value = F.nullif(F.trim(F.get(parts, 1)), F.lit(""))
    return rows.select("datasource", F.trim(F.get(parts, 0)).alias("name"), value.alias("value")).where("name <> ''")


def absent(manifest: DataFrame, files: DataFrame, keys=("date", "url", "inputs"), plain=()) -> DataFrame:
    """(datasource, kind, item): what a build from the manifests would lack.

    ``kind`` is ``key`` (one of ``keys`` without a value), ``value`` (an input named without one) or ``file`` (an input whose file is
    not among ``files (datasource, file)``). Inputs named in ``plain`` are no files. A datasource is one that has any entry.
    """
    wanted = manifest.select("datasource").distinct().select("datasource", F.explode(F.array(*map(F.lit, keys))).alias("item"))
    given = manifest.where("value is not null").select("datasource", F.col("key").alias("item"))
    inputs = manifest_inputs(manifest)
    named = inputs.where(F.col("value").isNotNull() & ~F.col("name").isin(*plain)).select("datasource", F.col("value").alias("item"))
    there = files.select("datasource", F.col("file").alias("item"))
    parts = {
        "key": wanted.join(given, ["datasource", "item"], "left_anti"),
        "value": inputs.where("value is null").select("datasource", F.col("name").alias("item")),
        "file": named.join(there, ["datasource", "item"], "left_anti"),
    }
    told = [df.distinct().select("datasource", F.lit(kind).alias("kind"), "item") for kind, df in parts.items()]
    return told[0].unionByName(told[1]).unionByName(told[2])


def manifest_files(spark: SparkSession, root: str) -> DataFrame:
    """(datasource, file): what lies in the folder ``data`` of each source; a folder in it counts by its name. Nothing is opened."""
    if place := W.task_path(spark, f"{root.rstrip('/')}/*/data/*"):
        listed, path, end = W.non_empty(W.matches(spark, place)), F.col("path"), "$"
    else:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
        path, end = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), ""
    inside = F.regexp_extract(path, f"/([^/]+)/data/([^/]+){end}", 0)
    parts = F.split(inside, "/")
    return listed.where(inside != "").select(F.get(parts, 1).alias("datasource"), F.get(parts, 3).alias("file")).distinct()
