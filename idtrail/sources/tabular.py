"""Tab-separated sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from idtrail.functions import clean as C
from idtrail.operators.joins import anti_join

# Column names in the sources.
GENE_HISTORY = ("#tax_id", "GeneID", "Discontinued_GeneID", "Discontinued_Symbol", "Discontinue_Date")
GENE_INFO = ("#tax_id", "GeneID", "Symbol", "Symbol_from_nomenclature_authority", "Synonyms")
HGNC_TARGETS = "MERGED_INTO_REPORT(S) (i.e HGNC_ID|SYMBOL|STATUS)"
HGNC_WITHDRAWN = ("HGNC_ID", "STATUS", "WITHDRAWN_SYMBOL", HGNC_TARGETS)
HGNC_COMPLETE = ("hgnc_id", "symbol", "alias_symbol", "prev_symbol")


LINE = "__line"  # the text of a row whose cells are not as many as the header's


def _ragged(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    """All columns as text, and in ``LINE`` the whole line of each row with more or fewer cells than the header."""
    reader = spark.read.options(sep="\t", header=True, quote="", mode="PERMISSIVE", enforceSchema=bool(schema))
    schema = schema or ", ".join(f"`{f.name.replace('`', '``')}` string" for f in reader.csv(path).schema)
    # cells must all be cut to be counted
    return reader.options(columnNameOfCorruptRecord=LINE, columnPruning=False).schema(f"{schema}, {LINE} string").csv(path)


def _reads(df: DataFrame):
    """Always true, but reads a cell: Spark reads no file for ``LINE`` alone."""
    return F.length(F.coalesce(f"`{df.columns[0]}`", F.lit(""))) >= 0


def n_cells(line: str):
    return F.length(line) - F.length(F.replace(F.col(line), F.lit("\t"), F.lit(""))) + 1


def scan_tsv(
    spark: SparkSession, path, columns: Sequence[str] | None = None, schema: str | None = None, long_rows: str = "fail",
) -> DataFrame:
    """Tab-separated text with a header; quotes are plain text, short rows are filled with NULL.

    ``columns`` are picked by header name; several files must agree on the header, else the read fails.
    With ``schema`` the header is skipped and columns go by position. A row with more cells than the header has no place for all
    of them: the job fails and names it, or with ``long_rows="reject"`` the row is left out and told by :func:`tsv_rejects`.
    """
    df = _ragged(spark, path, schema)
    names = [c for c in df.columns if c != LINE]
    wide = F.coalesce(n_cells(LINE) > len(names), F.lit(False))
    if long_rows == "fail":
        wide = F.when(wide, F.raise_error(F.concat(F.lit(f"more than {len(names)} cells: "), F.substring(LINE, 1, 200)))).otherwise(False)
    elif long_rows != "reject":
        raise ValueError(f"long_rows is 'fail' or 'reject', not {long_rows!r}")
    return df.where(_reads(df) & ~wide).select(*[F.col(f"`{c}`") for c in columns or names])


def tsv_rejects(spark: SparkSession, path, schema: str | None = None, short_rows: bool = False) -> DataFrame:
    """``file, line, n_cells, n_columns`` of the rows that ``long_rows="reject"`` leaves out; with ``short_rows`` also of those
    that are filled with NULL."""
    df = _ragged(spark, path, schema)
    n = len(df.columns) - 1
    told = df.where(F.col(LINE).isNotNull() & _reads(df)).select(
        F.col("_metadata.file_path").alias("file"), F.col(LINE).alias("line"), n_cells(LINE).alias("n_cells"), F.lit(n).alias("n_columns"),
    )
    return told if short_rows else told.where("n_cells > n_columns")


def scan_gene_history(spark: SparkSession, path) -> DataFrame:
    return scan_tsv(spark, path, GENE_HISTORY)


def scan_gene_info(spark: SparkSession, path) -> DataFrame:
    return scan_tsv(spark, path, GENE_INFO)


def scan_withdrawn_symbols(spark: SparkSession, path, targets: str = HGNC_TARGETS) -> DataFrame:
    """Columns HGNC_ID, STATUS, WITHDRAWN_SYMBOL and the target list as ``targets``."""
    df = scan_tsv(spark, path, (*HGNC_WITHDRAWN[:3], targets))
    return df.withColumnRenamed(targets, "targets")


def scan_complete_symbols(spark: SparkSession, path) -> DataFrame:
    return scan_tsv(spark, path, HGNC_COMPLETE)


def scan_query_result(spark: SparkSession, path, failed: DataFrame | None = None) -> DataFrame:
    """Result of a graph query: ``?name`` headers and RDF terms become plain names and values.

    Files named in ``failed.file`` are left out.
    """
    df = scan_tsv(spark, path)
    if failed is not None:
        df = anti_join(df.select("*", F.col("_metadata.file_path").alias("file")), failed, ["file"]).drop("file")
    return df.select(*[F.nullif(C.rdf_term(F.col(f"`{c}`")), F.lit("")).alias(c.lstrip("?")) for c in df.columns])


def scan_processed(spark: SparkSession, path, columns: Sequence[str]) -> DataFrame:
    """A table written earlier as tab-separated text: given columns, all text."""
    return scan_tsv(spark, path, schema=", ".join(f"`{c}` string" for c in columns))


def scan_export(spark: SparkSession, path, columns: Sequence[str]) -> DataFrame:
    """A folder written by :mod:`idtrail.sinks.tables`: the header block, comments included, is the first part file, rows are in
    the others, whatever they look like."""
    lines = spark.read.text(path).where(~F.col("_metadata.file_name").startswith("part-00000"))
    cells = F.split("value", "\t")
    return lines.select(*[F.nullif(F.get(cells, i), F.lit("")).alias(c) for i, c in enumerate(columns)])


def scan_sssom(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """One file that holds a whole mapping set: its metadata, and its rows as text columns with the names in the file.

    The header block is what stands before the line of column names: comment lines (``# key: "value"``, with ``curie_map`` as a
    mapping of its own) and blank lines. It is known by its place at the begin of the file, so rows that look like comments or like the
    column names stay rows. The file is split as any text; only the header is looked at first. Empty cells and short rows
    are NULL; a longer row fails the job.
    """
    lines = spark.read.text(path)
    if len(lines.inputFiles()) != 1:
        raise ValueError(f"one file is expected in {path}; a folder of part files is read by scan_export")
    start = F.col("_metadata.file_block_start") == 0
    first, n = [], 64
    while True:  # longer heads are read as far as they go
        first = [r.value for r in lines.where(start).take(n)]
        head = next((k for k, line in enumerate(first) if line.strip() and not line.startswith("#")), None)
        if head is not None or len(first) < n:
            break
        n *= 8
    if head is None:
        raise ValueError(f"no line of column names in {path}")
    names = first[head].split("\t")
    # the partition of a file's first block begins with that block
    place = F.when(start, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).otherwise(F.lit(head + 1))
    numbered = lines.select("value", place.alias("place"))
    cells = F.split("value", "\t")
    wide = F.when(F.size("cells") > len(names), F.raise_error(F.concat(F.lit(f"more than {len(names)} cells: "), F.substring("value", 1, 200))))
    body = numbered.where(F.col("place") > head).where("value <> ''").select("value", cells.alias("cells")).where(wide.otherwise(False) == F.lit(False))
    return _metadata(first[:head]), body.select(*[F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(names)])


def _metadata(comments: Sequence[str]) -> dict:
    """``# key: "value"`` lines as a dictionary; indented ``key "value"`` lines belong to the key before them."""
    out, group = {}, None
    for line in comments:
        text = line.removeprefix("#")
        key, _, value = text.strip().partition(" ")
        value = value.strip().strip('"')
        if not key:
            continue
        if text.startswith("   ") and group is not None:
            out[group][key] = value
        elif value:
            out[key.removesuffix(":")] = value
        else:
            group = key.removesuffix(":")
            out[group] = {}
    return out
