"""Command line: ``python -m idtrail``, or this file with ``spark-submit``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from idtrail.plans.build import export, publish
from idtrail.plans.manifests import publish_all


def pairs(values: list[str]) -> dict[str, str]:
    return dict(v.split("=", 1) for v in values)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="idtrail", description="Build the tables and the mapping set of one source.")
    p.add_argument("source", choices=["NCBI", "HGNC", "UniProt", "ChEBI", "HMDB", "Wikidata", "all"])
    p.add_argument("inputs", nargs="+", metavar="name=path", help="input files, e.g. history=gene_history.gz; of all: manifests=folder")
    p.add_argument("--out", default="out", help="tables go to OUT/<source in lower case>")
    p.add_argument("--release", default="")
    p.add_argument("--manifest", help="path of the source manifests, for the provider")
    p.add_argument("--date", default=date.today().isoformat(), help="build and mapping date")
    p.add_argument("--meta", nargs="*", default=[], metavar="key=value", help="provider, set_id, description")
    p.add_argument("--keep", type=int, default=0, metavar="N", help="write the build as a version and keep the N newest; 0 writes over the last one")
    p.add_argument("--tsv", action="store_true", help="also write the tables as tab-separated text")
    p.add_argument("--rename", nargs="*", default=[], metavar="column=header", help="headers of the text tables")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("idtrail").getOrCreate()
    folder = f"{a.out.rstrip('/')}/{a.source.lower()}"
    if a.source == "all":
        told = publish_all(spark, pairs(a.inputs)["manifests"], a.out, a.keep)
        if a.tsv:
            for source, tables in told.items():
                export(tables, f"{a.out.rstrip('/')}/{source.lower()}", pairs(a.rename))
        return
    stamp = a.date.replace("-", "")
    tables = publish(spark, a.source, pairs(a.inputs), folder, a.release, stamp, a.manifest, a.keep, date=a.date, **pairs(a.meta))
    if a.tsv:
        export(tables, folder, pairs(a.rename))


if __name__ == "__main__":
    main()
