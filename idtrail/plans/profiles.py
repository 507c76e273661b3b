"""The six sources, each as a thin arrangement of the operators.

A profile function takes scanned tables and returns named, lazy tables: ``pri_ids``, ``mappings``,
``labels`` and, for sources that publish a link graph, ``edges`` and ``attributes``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from idtrail.functions import clean as C, vocab as V
from idtrail.operators import cardinality as K, labels as L, rows as R, sssom as S, xref as X

Tables = dict[str, DataFrame]

GENE_MAPPING = ("primaryID", "primarySymbol", "secondaryID", "secondarySymbol", K.PREDICATE, K.CLASS, "comment", "source")
PLAIN_MAPPING = ("primaryID", "secondaryID", K.PREDICATE, K.CLASS, "comment", "source")
NCBI_MISSING = ("-", "")
GENE_LABEL = ("primaryID", "primarySymbol", "secondarySymbol", K.PREDICATE, K.CLASS, "comment", "source")


def ncbi(history: DataFrame, info: DataFrame, release: str, taxon: str = V.HUMAN, stage=S.as_it_is) -> Tables:
    """``stage`` stores the nomenclature symbols. Where their size is known to be small, no alias is shuffled to look them up."""
    history = R.normalise(R.keep_taxon(history, taxon), spellings=NCBI_MISSING)
    missing = NCBI_MISSING
    edges = history.select(
        C.target_or_withdrawn("GeneID").alias("primaryID"),
        F.col("Discontinued_GeneID").alias("secondaryID"),
        F.col("Discontinued_Symbol").alias("secondarySymbol"),
        F.col("Discontinue_Date").alias("date"),
    )
    info = R.normalise(R.keep_taxon(info, taxon), spellings=NCBI_MISSING).withColumnsRenamed({"GeneID": "primaryID", "Synonyms": "aliases"})
    naming = ("Symbol", "Symbol_from_nomenclature_authority")
    genes = L.with_primary_symbol(info, *naming, missing=missing)
    symbols = L.current_symbols(edges, genes.select("primaryID", "primarySymbol"), chosen=False)
    mappings = K.describe_mappings(edges, date="date", release=release, facts=symbols)
    own = F.when(F.col("primaryID") == V.WITHDRAWN, V.WITHDRAWN).otherwise(F.col("primarySymbol"))
    mappings = mappings.withColumns({"primarySymbol": own, "source": F.lit(V.NCBI_HISTORY_URL)})

    official = stage(L.nomenclature_symbols(info, *naming, missing=missing))
    aliases = genes.select("primaryID", "primarySymbol", "aliases")
    aliases = L.explode_typed_aliases(aliases, "aliases", official, release, unique=True, missing=missing)
    labels = _unclassified(aliases).withColumn("source", F.lit(V.NCBI_INFO_URL))
    names = L.explode_list(genes.select("primaryID", "Symbol", "aliases"), "aliases", "alias", keep_empty=True, missing=missing)
    links = X.xref_edges(edges, names, {"Symbol": False, "alias": False}, "secondarySymbol")
    return {
        "pri_ids": L.primary_ids(genes, ("primaryID", "primarySymbol")),
        "mappings": mappings.select(*GENE_MAPPING),
        "labels": labels.select(*GENE_LABEL),
        "edges": links,
    }


def hgnc(withdrawn: DataFrame, complete: DataFrame, withdrawn_file: str, complete_file: str) -> Tables:
    rows = withdrawn.select(
        F.col("HGNC_ID").alias("secondaryID"),
        F.col("WITHDRAWN_SYMBOL").alias("secondarySymbol"),
        C.targets_or_status("targets", "STATUS").alias("targets"),
    )
    rows = K.with_comment(K.with_predicate(K.with_list_cardinality(rows, "targets")))
    mappings = L.with_target_status_note(L.explode_targets(rows, "targets"))
    mappings = mappings.withColumn("source", F.lit(V.HGNC_URL + withdrawn_file))

    genes = R.normalise(complete, ["alias_symbol", "prev_symbol"], ("",))
    genes = genes.withColumnsRenamed({"hgnc_id": "primaryID", "symbol": "primarySymbol"})
    keys = ("primaryID", "primarySymbol")
    previous = L.explode_commented_list(genes.select(*keys, "prev_symbol"), "prev_symbol", V.PREVIOUS_COMMENT)
    alias = L.explode_commented_list(genes.select(*keys, "alias_symbol"), "alias_symbol", V.ALIAS_COMMENT)
    labels = _unclassified(L.merge_label_tables(previous, alias))
    labels = labels.withColumn("source", F.lit(V.HGNC_URL + complete_file))
    return {
        "pri_ids": L.primary_ids(labels, keys),
        "mappings": mappings.select(*GENE_MAPPING),
        "labels": labels.select(*GENE_LABEL),
    }


def uniprot(fasta_ids: DataFrame, secondary: DataFrame, deleted: DataFrame, release: str) -> Tables:
    live = K.describe_mappings(secondary, release=release, note_retired=False)
    live = live.withColumn("source", F.lit(V.UNIPROT_SECONDARY_URL)).select(*PLAIN_MAPPING)
    mappings = K.append_withdrawn(live, deleted, release=release, source=V.UNIPROT_DELETED_URL)
    return {"pri_ids": fasta_ids.select("primaryID"), "mappings": mappings}


def chebi(records: DataFrame) -> Tables:
    mappings = L.explode_secondaries(records)
    names = L.explode_synonyms(records, keep_empty=True)
    return {
        "pri_ids": records.select("primaryID"),
        "mappings": mappings,
        "labels": names.where(F.col("synonym").isNotNull()),
        "edges": X.xref_edges(mappings),
        "attributes": X.xref_attributes(names),
    }


def hmdb(records: DataFrame) -> Tables:
    mappings = L.explode_secondaries(records)
    names = L.explode_synonyms(records, keep_empty=True)
    return {
        "pri_ids": records.select("primaryID"),
        "mappings": mappings,
        "labels": names,
        "edges": X.xref_edges(mappings, names, {"name": True, "synonym": False}),
    }


def wikidata(redirects: DataFrame, label: str = "name", alias: str = "synonym") -> Tables:
    """Tables of a redirect extract, from a result file or from triples."""
    return {
        "pri_ids": L.primary_ids(redirects),
        "mappings": S.drop_empty(redirects).select("primaryID", "secondaryID").distinct(),
        "labels": redirects.select("primaryID", label, alias).distinct(),
        "redirects": redirects,
    }


def _unclassified(labels: DataFrame) -> DataFrame:
    """Classes do not apply to label rows."""
    return labels.withColumns({c: F.lit(None).cast("string") for c in (K.PREDICATE, K.CLASS)})


def mapping_set(source: str, tables: Tables, label: str = "name", alias: str = "synonym", stage=S.as_it_is) -> DataFrame:
    """The published mapping set of a source. ``stage`` stores a table that several parts of the plan read."""
    match source:
        case "NCBI":
            return S.sssom_of_two_key_labels(tables["mappings"], tables["labels"])
        case "HGNC":
            return S.merge_mappings_labels(tables["mappings"], tables["labels"], stage=stage)
        case "UniProt":
            return S.sssom_of_plain(tables["mappings"])
        case "ChEBI" | "HMDB":
            return S.sssom_of_names(tables["mappings"], tables["labels"], drop_self=source == "HMDB")
        case "Wikidata":
            return S.sssom_of_redirects(tables["redirects"], label, alias, stage)
    raise ValueError(f"unknown source {source!r}")


_NOTES = {
    "ChEBI": V.SYNONYM_NOTE,
    "HMDB": V.SYNONYM_NOTE,
    "HGNC": V.ALT_SYMBOL_NOTE,
    "NCBI": V.ALT_SYMBOL_NOTE,
    "UniProt": "",
    "Wikidata": V.ALT_NAME_NOTE,
}


def set_metadata(source: str, **values: str) -> S.SetMetadata:
    """Header of a source's mapping set; ``values`` give provider, set_id, description and date."""
    prefixes = {**V.SOURCE_PREFIXES[source], **V.COMMON_PREFIXES}
    return replace(S.SetMetadata(prefixes=prefixes, comment=_NOTES[source]), **values)
