"""Sources with one nested record per entity: tagged text blocks and XML."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from contextlib import ExitStack

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from idtrail.functions import clean as C
from idtrail.sources.files import read_files, task_path

RECORD_COLUMNS = ("primaryID", "name", "secondary", "synonyms")

# Tags of the block format and of the XML format.
BLOCK_END = "$$$$"
ID_TAG, NAME_TAG = "ChEBI ID", "ChEBI Name"
SECONDARY_TAG, SYNONYM_TAG = "Secondary ChEBI ID", "Synonyms"
XML_ROW = "metabolite"
XML_CONTAINER = "hmdb_metabolites.xml"
XML_SCHEMA = (
    "accession string, name string, secondary_accessions struct<accession: array<string>>,"
    " synonyms struct<synonym: array<string>>"
)


def scan_sdf(spark: SparkSession, path) -> DataFrame:
    """Block records: (primaryID, name, secondary[], synonyms[]). The file is split between records.

    The end mark is one at the start of a line, so both kinds of line ends are read, also in one file,
    and a mark within a line is text.
    """
    return sdf_records(spark.read.option("lineSep", "\n" + BLOCK_END).text(path))


def sdf_records(blocks: DataFrame, text: str = "value") -> DataFrame:
    """Records of a table with one block per row; blocks without an id are dropped."""
    block = F.replace(F.col(text), F.lit("\r"), F.lit(""))
    records = blocks.select(
        F.get(_tag_values(block, ID_TAG), 0).alias("primaryID"),
        F.get(_tag_values(block, NAME_TAG), 0).alias("name"),
        _tag_values(block, SECONDARY_TAG).alias("secondary"),
        _tag_values(block, SYNONYM_TAG).alias("synonyms"),
    )
    return records.where(F.col("primaryID") != "")


def _tag_values(block: Column, tag: str) -> Column:
    """Lines between a tag line and the next blank line (or the end of the block)."""
    body = F.regexp_extract(block, rf"(?s)(?:^|\n)> <{tag}>[^\n]*\n(.*?)(?:\n\s*\n|\n?$)", 1)
    values = F.transform(F.split(body, "\n"), lambda x: F.trim(x))
    return F.filter(values, lambda x: (x != "") & (x != BLOCK_END) & ~x.startswith("> <"))


def scan_xml(spark: SparkSession, path, row_tag: str = XML_ROW, strict: bool = True) -> DataFrame:
    """Records of XML files of any size. ``strict``: see :func:`xml_documents`.

    The text is cut at the end tags of the records, which Spark does in parallel splits; a reader
    of whole XML documents would give one file to one task.
    """
    end = f"</{row_tag}>"
    chunks = spark.read.option("lineSep", end).text(path)
    record = F.regexp_extract("value", rf"(?s)(<{row_tag}[\s>].*)", 1)
    records = chunks.select(record.alias("value")).where("value != ''")
    return xml_documents(records.select(F.concat("value", F.lit(end)).alias("value")), strict=strict)


def xml_records(parsed: DataFrame) -> DataFrame:
    """A record needs an id and a secondary container, which may be empty."""
    whole = parsed.where(F.col("accession").isNotNull() & F.col("secondary_accessions").isNotNull())
    return whole.select(
        F.trim("accession").alias("primaryID"),
        C.blank_to_null("name").alias("name"),
        _present(F.col("secondary_accessions.accession")).alias("secondary"),
        _present(F.col("synonyms.synonym")).alias("synonyms"),
    )


def _present(values: Column) -> Column:
    trimmed = F.transform(values, lambda x: F.trim(x))
    return F.coalesce(F.filter(trimmed, lambda x: x != ""), F.array().cast("array<string>"))


def parsed_documents(documents: DataFrame, schema: str, text: str = "value", strict: bool = True, **options: str) -> DataFrame:
    """``documents`` and ``__parsed``, a struct of ``schema``; malformed ones end the job or, without ``strict``, are left out."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"} | options
    parsed = documents.withColumn("__parsed", F.from_xml(F.col(text), f"{schema}, malformed string", options))
    malformed = F.col("__parsed.malformed")
    good = malformed.isNull()
    if strict:
        start = F.concat(F.lit("malformed document: "), F.left(malformed, F.lit(200)))
        good = F.when(malformed.isNotNull(), F.raise_error(start).cast("boolean")).otherwise(True)
    return parsed.where(good)


def xml_documents(documents: DataFrame, text: str = "value", strict: bool = True) -> DataFrame:
    """Records of a table with one XML document per row.

    A malformed document ends the job, as half of it would look like a record. Without ``strict`` it is
    left out; :func:`xml_rejects` tells which those are.
    """
    return xml_records(parsed_documents(documents, XML_SCHEMA, text, strict).select("__parsed.*"))


def xml_rejects(documents: DataFrame, text: str = "value") -> DataFrame:
    """(malformed): the documents that can't be parsed, whole."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    parsed = documents.select(F.from_xml(F.col(text), f"{XML_SCHEMA}, malformed string", options).alias("x"))
    return parsed.select("x.malformed").where("malformed is not null")


def scan_xml_directory(spark: SparkSession, path, container: str = XML_CONTAINER, strict: bool = True) -> DataFrame:
    """Records of a directory of one-record documents; the unsplit container file is skipped.

    The documents may be many and small: tasks list the directory and read them, each a share of the files.
    """
    if place := task_path(spark, path):
        files = read_files(spark, place, skip=container)
        return xml_documents(files.select(F.col("content").cast("string").alias("value")), strict=strict)
    files = spark.read.text(path, wholetext=True)
    return xml_documents(files.where(F.col("_metadata.file_name") != container).select("value"), strict=strict)


def scan_xml_archives(spark: SparkSession, path, container: str = XML_CONTAINER, strict: bool = True) -> DataFrame:
    """Records of zip archives with one document per entry.

    First the entries of each archive are listed (names and sizes only; the container is left out here,
    so nobody reads it), then they are spread over all tasks in chunks of bytes and each task reads just
    its own entries, so one large archive keeps many tasks busy.
    """
    files = spark.read.format("binaryFile").load(path).select("path")
    return xml_documents(zip_documents(files, container), strict=strict)


def zip_documents(files: DataFrame, container: str = XML_CONTAINER, chunk_bytes: int = 8 << 20) -> DataFrame:
    """(value) per document of the archives at ``files.path``."""
    listing = files.mapInPandas(_list_entries(container, chunk_bytes), "path string, chunk long, names array<string>")
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = listing.repartition(parts, "path", "chunk").sortWithinPartitions("path")
    return entries.mapInPandas(_read_entries, "value string")


def _open(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = path[len("file:"):]
        path = "/" + path.lstrip("/")
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _list_entries(container: str, chunk_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with _open(path) as f, zipfile.ZipFile(f) as archive:
                    entries = [i for i in archive.infolist() if not i.is_dir() and i.filename.rsplit("/", 1)[-1] != container]
                chunks, size = [], chunk_bytes
                for entry in entries:
                    if size >= chunk_bytes:
                        chunks.append([])
                        size = 0
                    chunks[-1].append(entry.filename)
                    size += entry.file_size
                yield pd.DataFrame({"path": path, "chunk": range(len(chunks)), "names": chunks})

    return run


def _read_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    # Chunks of one archive follow each other, so its directory is read once per task.
    with ExitStack() as stack:
        current, archive = None, None
        for batch in batches:
            for path, names in zip(batch["path"], batch["names"]):
                if path != current:
                    stack.close()
                    current, archive = path, stack.enter_context(zipfile.ZipFile(stack.enter_context(_open(path))))
                yield pd.DataFrame({"value": [archive.read(name).decode("utf-8") for name in names]})
