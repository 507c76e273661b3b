"""From raw files to published tables."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from idtrail.functions import vocab as V
from idtrail.operators import redirects as G, xref as X
from idtrail.operators import quality as Q
from idtrail.plans import profiles as P
from idtrail.session import remove_folder, staged, work_folder
from idtrail.sinks import tables as W
from idtrail.sinks.versions import building
from idtrail.sources import lines, manifest as M, records, tabular, triples


def balanced(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly: a compressed text file comes as one partition."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def source_tables(spark: SparkSession, source: str, inputs: Mapping[str, str], release: str = "", stage=staged) -> P.Tables:
    """Stage-1 tables of ``source``; ``stage`` stores parsed inputs. ``inputs`` names the files:

    NCBI ``history``, ``info`` (and optionally ``taxon``); HGNC ``withdrawn``, ``complete``; UniProt ``fasta``, ``secondary``,
    ``deleted``; ChEBI ``sdf``; HMDB ``xml``, ``directory`` or ``archive``; Wikidata ``result`` or
    ``triples`` (with ``kind`` chemical, gene or protein).
    """
    match source:
        case "NCBI":
            history = stage(balanced(tabular.scan_gene_history(spark, inputs["history"])))
            info = stage(balanced(tabular.scan_gene_info(spark, inputs["info"])))
            return P.ncbi(history, info, release, inputs.get("taxon", V.HUMAN), stage)
        case "HGNC":
            withdrawn, complete = inputs["withdrawn"], inputs["complete"]
            return P.hgnc(
                stage(balanced(tabular.scan_withdrawn_symbols(spark, withdrawn))),
                stage(balanced(tabular.scan_complete_symbols(spark, complete))),
                withdrawn.rsplit("/", 1)[-1],
                complete.rsplit("/", 1)[-1],
            )
        case "UniProt":
            return P.uniprot(
                lines.scan_fasta_ids(spark, inputs["fasta"]),
                stage(lines.scan_secondary_accessions(spark, inputs["secondary"])),
                lines.scan_deleted_accessions(spark, inputs["deleted"]),
                release,
            )
        case "ChEBI":
            return P.chebi(stage(records.scan_sdf(spark, inputs["sdf"])))
        case "HMDB":
            scans = {
                "xml": records.scan_xml,
                "directory": records.scan_xml_directory,
                "archive": records.scan_xml_archives,
            }
            if len(inputs) != 1 or not inputs.keys() <= scans.keys():
                raise ValueError(f"HMDB takes one of {', '.join(scans)}, not {', '.join(inputs) or 'nothing'}")
            (kind, path), = inputs.items()
            return P.hmdb(stage(scans[kind](spark, path)))
        case "Wikidata":
            return P.wikidata(stage(_redirects(spark, inputs)), *label_columns(inputs.get("kind")))
    raise ValueError(f"unknown source {source!r}")


def label_columns(kind: str | None) -> tuple[str, str]:
    return ("primarySymbol", "secondarySymbol") if kind == "gene" else ("name", "synonym")


def _redirects(spark: SparkSession, inputs: Mapping[str, str]) -> DataFrame:
    kind = inputs.get("kind")
    if "result" in inputs:
        # a file that holds the mark of a failed extract is left out as a whole
        text = spark.read.text(inputs["result"]).select(F.col("_metadata.file_path").alias("file"), "value")
        failed = Q.failed_extracts(text)
        found = tabular.scan_query_result(spark, inputs["result"], failed)
        if not failed.isEmpty() and found.isEmpty():
            raise ValueError(f"failed extract: {inputs['result']}")
        return found
    classes = {"chemical": V.CHEMICAL_CLASSES, "gene": V.GENE_CLASSES, "protein": V.PROTEIN_CLASSES}[kind]
    taxon = None if kind == "chemical" else V.HUMAN_TAXON
    graph = triples.scan_triples(spark, inputs["triples"])
    return G.redirects_by_class(graph, classes, taxon, *label_columns(kind))


def publish(
    spark: SparkSession,
    source: str,
    inputs: Mapping[str, str],
    folder: str,
    release: str = "",
    build_date: str = "",
    manifest: str | None = None,
    keep: int = 0,
    **metadata: str,
) -> P.Tables:
    """Writes all tables of a source below ``folder`` and returns them as written.

    With ``keep`` the build is a version (:mod:`idtrail.sinks.versions`): readers see all its tables or the build before, a build that
    fails leaves nothing, and the ``keep`` newest ones stay. Without it tables are written over those in ``folder``.

    Stage 1 is written as Parquet; the mapping set and the link graph are built from that.
    ``metadata`` fills the header of the mapping set (provider, set_id, description, date); a
    provider that is not given comes from ``manifest``, the path of the source manifests. Where
    there are mappings and labels with symbols, the quality report is written next to them.
    Intermediate tables go to shared storage and are removed at the end.
    """
    folder = folder.rstrip("/")
    if manifest and not metadata.get("provider"):
        metadata["provider"] = provider_of(spark, manifest, source)
    work = work_folder(spark)
    places = iter(range(1_000))

    def stage(df: DataFrame) -> DataFrame:
        return staged(df, f"{work}/{next(places)}")

    try:
        with building(spark, folder, keep) if keep else nullcontext(folder) as place:
            return _published(spark, source, inputs, place, release, build_date, metadata, stage)
    finally:
        remove_folder(spark, work)


def provider_of(spark: SparkSession, manifest: str, source: str, key: str = "url") -> str:
    """Value of ``key`` in the manifest of ``source`` (folders may be in any case), empty if there is none."""
    entries = M.scan_manifest(spark, manifest).withColumn("datasource", F.lower("datasource"))
    row = M.with_metadata(spark.range(1).select(F.lit(source.lower()).alias("datasource")), entries, key, "value").first()
    return row["value"] or ""


def _published(spark, source, inputs, folder, release, build_date, metadata, stage) -> P.Tables:
    tables = source_tables(spark, source, inputs, release, stage)
    written, counted = {}, {}
    for name, df in tables.items():
        counted |= W.write_observed(df, f"{folder}/{name}", **observed(name, df))
        written[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    published = P.mapping_set(source, written, *label_columns(inputs.get("kind")), stage)
    W.write_table(published, f"{folder}/sssom")
    written["sssom"] = spark.read.schema(published.schema).parquet(f"{folder}/sssom")
    W.write_sssom(written["sssom"], f"{folder}/sssom_tsv", P.set_metadata(source, **metadata))
    if "primarySymbol" in written["mappings"].columns and "labels" in written:
        report = Q.quality_report(written["mappings"], written["labels"], counted)
        W.write_table(report, f"{folder}/quality")
        written["quality"] = spark.read.schema(report.schema).parquet(f"{folder}/quality")
    if "edges" in written:
        pri, edges = written["pri_ids"], written["edges"]
        none = spark.createDataFrame([], "id string, attr_name string, attr_value string")
        W.write_xref_graph(
            f"{folder}/graph",
            X.xref_nodes(edges, pri, V.SYSTEM_CODES[source]),
            X.xref_links(edges, pri),
            written.get("attributes", none),
            X.build_info(spark.range(1).drop("id"), source, release, build_date),
        )
    return written


def observed(name: str, df: DataFrame) -> dict[str, Column]:
    """What is counted while a stage-1 table is written."""
    rows = F.count(F.lit(1))
    if name == "mappings" and "mapping_cardinality" in df.columns:
        return {"mapping_rows": rows, "unclassed": Q.unclassed()}
    return {"mapping_rows" if name == "mappings" else "label_rows" if name == "labels" else f"{name}_rows": rows}


def export(tables: P.Tables, folder: str, names: Mapping[str, str] | None = None) -> None:
    """Tab-separated copies of the stage-1 tables; ``names`` renames columns in the export."""
    for name in ("pri_ids", "mappings", "labels"):
        if name in tables:
            W.write_tsv(tables[name], f"{folder.rstrip('/')}/{name}_tsv", names)
