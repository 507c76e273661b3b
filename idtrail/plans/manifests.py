"""Builds of all sources that a folder of manifests describes, from that folder alone.

``root/<source>/config`` has a line each for ``release``, ``date``, ``url`` and ``inputs``, a list of ``name:file`` as
:func:`~idtrail.plans.build.source_tables` takes them; the files lie in ``root/<source>/data``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from idtrail.plans.build import publish
from idtrail.plans.profiles import Tables
from idtrail.session import staged
from idtrail.sinks.tables import write_table
from idtrail.sources import manifest as M

SOURCES = {name.lower(): name for name in ("NCBI", "HGNC", "UniProt", "ChEBI", "HMDB", "Wikidata")}
PLAIN = ("kind", "taxon")  # inputs that are values, not files

# inputs a source can't do without; of several names one is enough
NEEDED = {
    "ncbi": ("history", "info"), "hgnc": ("withdrawn", "complete"), "uniprot": ("fasta", "secondary", "deleted"), "chebi": ("sdf",),
    "hmdb": ("xml|directory|archive",), "wikidata": ("result|triples", "kind"),
}


def lacking(spark: SparkSession, root: str) -> DataFrame:
    """(datasource, kind, item): what the builds of ``root`` lack (see :func:`~idtrail.sources.manifest.absent`); kind ``source`` is a
    folder of no known source, ``input`` an input that the source needs and the manifest doesn't name."""
    entries = staged(M.scan_manifest(spark, f"{root.rstrip('/')}/*/config"))  # many branches read it
    unknown = entries.where(~F.lower("datasource").isin(*SOURCES)).select("datasource").distinct()
    told = unknown.select("datasource", F.lit("source").alias("kind"), F.col("datasource").alias("item"))
    needed = spark.createDataFrame([(of, item) for of, items in NEEDED.items() for item in items], "of string, item string")
    sources = entries.select("datasource").distinct()
    needed = sources.join(needed, F.lower("datasource") == F.col("of")).select("datasource", "item")
    names = needed.select("datasource", "item", F.explode(F.split("item", "[|]")).alias("name"))
    met = names.join(M.manifest_inputs(entries).select("datasource", "name"), ["datasource", "name"], "left_semi")
    unnamed = needed.join(met, ["datasource", "item"], "left_anti").select("datasource", F.lit("input").alias("kind"), "item")
    return M.absent(entries, M.manifest_files(spark, root), plain=PLAIN).unionByName(told).unionByName(unnamed)


def publish_all(spark: SparkSession, root: str, folder: str, keep: int = 0) -> dict[str, Tables]:
    """Publishes each source of ``root`` that lacks nothing below ``folder`` and returns the tables by source.

    ``folder/absent`` tells what the others lack; a source that is told there is not built, the others are. Release, date and
    provider come from the manifest; a missing release is empty. Manifests are a few lines for each source and are read by the driver.
    """
    root, folder = root.rstrip("/"), folder.rstrip("/")
    report = lacking(spark, root)
    write_table(report, f"{folder}/absent")
    report = spark.read.schema(report.schema).parquet(f"{folder}/absent")
    entries = M.scan_manifest(spark, f"{root}/*/config").join(report, "datasource", "left_anti")
    values, inputs = {}, {}
    for r in entries.collect():
        values.setdefault(r["datasource"], {})[r["key"]] = r["value"] or ""
    for r in M.manifest_inputs(entries).collect():
        place = r["value"] if r["name"] in PLAIN else f"{root}/{r['datasource']}/data/{r['value']}"
        inputs.setdefault(r["datasource"], {})[r["name"]] = place
    tables = {}
    for name, of in sorted(values.items()):
        source = SOURCES[name.lower()]
        tables[source] = publish(
            spark, source, inputs[name], f"{folder}/{name.lower()}", of.get("release", ""), of["date"].replace("-", ""),
            keep=keep, provider=of["url"], date=of["date"],
        )
    return tables
