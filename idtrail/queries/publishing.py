"""Whole sources: stage-1 tables, mapping sets, headers and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from idtrail.functions import clean as C, vocab as V
from idtrail.operators import cardinality as K, labels as L, quality as Q, redirects as G, sssom as S
from idtrail.plans import profiles as P
from idtrail.queries import base as B
from idtrail.queries.base import query
from idtrail.queries.classify import WITHDRAWALS, symbol_withdrawals
from idtrail.queries.joining import HELD, LABEL_PAIRS, MERGED, label_pairs
from idtrail.queries.linking import GENE_LABELS, redirects_sql, triples
from idtrail.queries.scanning import PART_RECORDS, part_records
from idtrail.session import staged, work_folder
from idtrail.sinks.tables import write_sssom
from idtrail.sources.tabular import scan_export


def _stored(tables):
    """Stage 2 starts from stored tables, as in a published build."""
    return {name: staged(tables[name]) for name in ("mappings", "labels")}


# NCBI: lines as retired genes of two taxa, their (part, supplier) pairs as current genes.


def _ncbi(spark, folder, stage=S.as_it_is):
    lines, part = B.table(spark, folder, "lineitem"), B.table(spark, folder, "part")
    taxon = F.when(F.col("l_linestatus") == "F", "9606").otherwise("10090")
    history = lines.select(
        taxon.alias("#tax_id"),
        F.when(F.col("l_returnflag") == "A", "-").otherwise(B.current_id()).alias("GeneID"),
        B.old_id().alias("Discontinued_GeneID"),
        F.concat(F.lit("S"), "l_orderkey").alias("Discontinued_Symbol"),
        F.when(F.col("l_tax") > 0, F.date_format("l_shipdate", "yyyyMMdd")).otherwise("-").alias("Discontinue_Date"),
    )
    # Current genes of the other taxon are unknown to the symbol lookup, so its fallbacks occur too.
    other = F.when(F.col("l_returnflag") == "N", "9606").otherwise("10090")
    pairs = lines.select("l_partkey", "l_suppkey", other.alias("#tax_id")).distinct()
    size, symbol = F.col("p_size"), F.concat(F.lit("G"), "p_partkey")
    names = part.select(  # made once per part, not for each of its pairs
        "p_partkey",
        symbol.alias("Symbol"),
        F.when(size >= 48, F.col("p_brand")).when(size < 5, symbol).otherwise("-").alias("Symbol_from_nomenclature_authority"),
        F.when(F.col("p_type") == "SMALL", "-").otherwise(F.concat_ws("|", F.replace("p_name", F.lit(" "), F.lit("|")), "p_brand")).alias("Synonyms"),
    )
    info = pairs.join(names, F.col("l_partkey") == F.col("p_partkey")).select(
        "`#tax_id`", B.current_id().alias("GeneID"), "Symbol", "Symbol_from_nomenclature_authority", "Synonyms"
    )
    return P.ncbi(staged(history), staged(info), "v1", stage=stage)


NCBI = f"""edges AS (
  SELECT CASE WHEN l_returnflag = 'A' THEN 'Entry Withdrawn' ELSE l_partkey || '-' || l_suppkey END AS "primaryID",
    l_orderkey || '-' || l_suppkey AS "secondaryID", 'S' || l_orderkey AS "secondarySymbol",
    CASE WHEN l_tax > 0 THEN strftime(l_shipdate, '%Y%m%d') END AS "date" FROM lineitem WHERE l_linestatus = 'F'),
{B.CLASSED},
genes AS (
  SELECT DISTINCT l_partkey || '-' || l_suppkey AS "primaryID", 'G' || p_partkey AS symbol,
    CASE WHEN p_size >= 48 THEN p_brand END AS authority,
    CASE WHEN p_type = 'SMALL' THEN NULL ELSE string_split(p_name, ' ') || [p_brand] END AS aliases
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N'),
named AS (SELECT *, CASE WHEN authority IS NULL THEN symbol ELSE symbol || '|' || authority END AS "primarySymbol" FROM genes),
own AS (SELECT "secondaryID", min("secondarySymbol") AS symbol FROM edges GROUP BY 1),
ncbi_mappings AS (
  SELECT c."primaryID", CASE WHEN c."primaryID" = 'Entry Withdrawn' THEN 'Entry Withdrawn' ELSE coalesce(n."primarySymbol", o.symbol) END AS "primarySymbol",
    c."secondaryID", c."secondarySymbol", {B.PREDICATE_CASE} AS "predicateID", mapping_cardinality,
    {B.DATE_CASE} || {B.COMMENT_CASE}
      || CASE WHEN o."secondaryID" IS NOT NULL THEN ' Object is also withdrawn.' ELSE '' END || ' Release: v1.' AS "comment",
    'https://ftp.ncbi.nih.gov/gene/DATA/gene_history.gz' AS "source"
  FROM classed c LEFT JOIN named n ON c."primaryID" = n."primaryID" LEFT JOIN own o ON c."primaryID" = o."secondaryID"),
ncbi_labels AS (
  SELECT DISTINCT "primaryID", "primarySymbol", alias AS "secondarySymbol", CAST(NULL AS VARCHAR) AS "predicateID", CAST(NULL AS VARCHAR) AS mapping_cardinality,
    CASE WHEN alias IN (SELECT authority FROM genes WHERE authority IS NOT NULL) THEN 'The secondary symbol is the nomenclature symbol'
      ELSE 'Unofficial symbol for the gene' END || ' Release: v1.' AS "comment",
    'https://ftp.ncbi.nih.gov/gene/DATA/gene_info.gz' AS "source"
  FROM (SELECT *, unnest(aliases) AS alias FROM named))"""


@query(f"""WITH {NCBI} SELECT * FROM ncbi_mappings""")
def ncbi_mappings(spark, folder):
    return _ncbi(spark, folder)["mappings"]


@query(f"""WITH {NCBI} SELECT * FROM ncbi_labels""")
def ncbi_labels(spark, folder):
    return _ncbi(spark, folder, staged)["labels"]


@query(f"""WITH {NCBI} SELECT DISTINCT "primaryID", "primarySymbol" FROM named""")
def ncbi_primary_ids(spark, folder):
    return _ncbi(spark, folder)["pri_ids"]


@query(f"""WITH {NCBI},
m AS (SELECT *, regexp_replace("comment", ' Release.*', '') AS short FROM ncbi_mappings),
l AS (SELECT DISTINCT "primaryID", "primarySymbol", "secondarySymbol", "source" FROM ncbi_labels)
SELECT coalesce(m."primaryID", l."primaryID") AS subject_id, coalesce(l."primarySymbol", m."primarySymbol") AS subject_label,
  m."predicateID" AS predicate_id, m."secondaryID" AS object_id, coalesce(m."secondarySymbol", l."secondarySymbol") AS object_label,
  m.mapping_cardinality, m.short AS "comment", nullif(concat_ws(' ', m."source", l."source"), '') AS "source"
FROM m FULL JOIN l ON m."primaryID" = l."primaryID" AND m."secondarySymbol" IS NOT DISTINCT FROM l."secondarySymbol" """)
def ncbi_sssom(spark, folder):
    return P.mapping_set("NCBI", _stored(_ncbi(spark, folder, staged)))


# HGNC: orders as withdrawn symbols, customers as the complete set.


def _hgnc(spark, folder):
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    old = [F.concat(F.lit("W"), "c_custkey", F.lit(p)) for p in (".1-URGENT", ".2-HIGH")]
    complete = B.table(spark, folder, "customer").select(
        F.concat(F.lit("H:"), "c_custkey").alias("hgnc_id"),
        F.concat(F.lit("C"), "c_custkey").alias("symbol"),
        F.when(nation > 8, F.concat_ws("|", segment, F.concat(F.lit("N"), nation))).otherwise("").alias("alias_symbol"),
        F.when(nation > 4, F.concat_ws("|", *old)).otherwise("").alias("prev_symbol"),
    )
    return P.hgnc(symbol_withdrawals(spark, folder), complete, "w.txt", "c.txt")


HGNC = f"""{WITHDRAWALS},
targets_ AS (SELECT *, unnest(string_split(targets, ', ')) AS target FROM withdrawals_classed),
m AS (
  SELECT string_split(target, '|')[1] AS "primaryID", CASE WHEN contains(target, '|') THEN string_split(target, '|')[2] ELSE target END AS "primarySymbol",
    "secondaryID", "secondarySymbol", {B.PREDICATE_CASE} AS "predicateID", mapping_cardinality,
    {B.COMMENT_CASE} || CASE WHEN contains(target, '|Entry Withdrawn') THEN ' Object is also withdrawn.' ELSE '' END AS "comment",
    '{V.HGNC_URL}w.txt' AS "source" FROM targets_),
complete AS (SELECT 'H:' || c_custkey AS "primaryID", 'C' || c_custkey AS "primarySymbol",
    CASE WHEN c_nationkey > 8 THEN [c_mktsegment, 'N' || c_nationkey] ELSE [NULL] END AS alias,
    CASE WHEN c_nationkey > 4 THEN ['W' || c_custkey || '.1-URGENT', 'W' || c_custkey || '.2-HIGH'] ELSE [NULL] END AS prev FROM customer),
both_ AS (
  SELECT "primaryID", "primarySymbol", s AS "secondarySymbol", CASE WHEN s IS NOT NULL THEN '{V.PREVIOUS_COMMENT}' END AS "comment"
    FROM (SELECT *, unnest(prev) AS s FROM complete)
  UNION SELECT "primaryID", "primarySymbol", s, CASE WHEN s IS NOT NULL THEN '{V.ALIAS_COMMENT}' END FROM (SELECT *, unnest(alias) AS s FROM complete)),
l AS (SELECT "primaryID", "primarySymbol", "secondarySymbol", CAST(NULL AS VARCHAR) AS "predicateID", CAST(NULL AS VARCHAR) AS mapping_cardinality,
    "comment", '{V.HGNC_URL}c.txt' AS "source" FROM both_ WHERE "secondarySymbol" IS NOT NULL
      OR "primaryID" NOT IN (SELECT "primaryID" FROM both_ WHERE "secondarySymbol" IS NOT NULL))"""


@query(f"""WITH {HGNC} SELECT * FROM m""")
def hgnc_mappings(spark, folder):
    return _hgnc(spark, folder)["mappings"]


@query(f"""WITH {HGNC} SELECT * FROM l""")
def hgnc_labels(spark, folder):
    return _hgnc(spark, folder)["labels"]


@query(f"""WITH {HGNC}, {MERGED}{HELD}""")
def hgnc_sssom(spark, folder):
    return P.mapping_set("HGNC", _stored(_hgnc(spark, folder)), stage=staged)


# UniProt: lines as secondary accessions, orders as deleted ones.


def _uniprot(spark, folder):
    ids = B.table(spark, folder, "customer").select(F.col("c_name").alias("primaryID"))
    orders = B.table(spark, folder, "orders")
    deleted = orders.select(F.concat(F.lit("D"), "o_orderkey").alias("secondaryID"))
    return P.uniprot(ids, B.live_edges(spark, folder), deleted, "v2")


UNIPROT = f"""{B.LIVE_EDGES}, {B.CLASSED}, uniprot AS (
  SELECT "primaryID", "secondaryID", {B.PREDICATE_CASE} AS "predicateID", mapping_cardinality,
    {B.COMMENT_CASE} || ' Release: v2.' AS "comment", '{V.UNIPROT_SECONDARY_URL}' AS "source" FROM classed
  UNION ALL SELECT 'Entry Withdrawn', 'D' || o_orderkey, 'oboInOwl:consider', '1:0',
    'ID (subject) withdrawn/deprecated. Release: v2.', '{V.UNIPROT_DELETED_URL}' FROM orders)"""


@query(f"""WITH {UNIPROT} SELECT * FROM uniprot""")
def uniprot_mappings(spark, folder):
    return _uniprot(spark, folder)["mappings"]


@query(f"""WITH {UNIPROT} SELECT "primaryID" AS subject_id, "predicateID" AS predicate_id, "secondaryID" AS object_id,
  mapping_cardinality, "comment", "source" FROM uniprot""")
def uniprot_sssom(spark, folder):
    return P.mapping_set("UniProt", _uniprot(spark, folder))


# ChEBI and HMDB: parts as nested records.

NAMES_SET = """SELECT coalesce(c."primaryID", n."primaryID") AS subject_id, n.name AS subject_label, {predicate} AS predicate_id,
  c."secondaryID" AS object_id, n.synonym AS object_label, c.mapping_cardinality
FROM classed c FULL JOIN names n ON c."primaryID" = n."primaryID" """.replace("{predicate}", B.PREDICATE_CASE)


@query(f"""WITH {PART_RECORDS},
edges AS (SELECT "primaryID", unnest(secondary) AS "secondaryID" FROM records), {B.CLASSED},
names AS (SELECT "primaryID", name, unnest(synonyms) AS synonym FROM records)
{NAMES_SET}""")
def chebi_sssom(spark, folder):
    return P.mapping_set("ChEBI", P.chebi(part_records(spark, folder)))


@query(f"""WITH {PART_RECORDS},
edges AS (SELECT * FROM (SELECT "primaryID", unnest(secondary) AS "secondaryID" FROM records) WHERE "primaryID" <> "secondaryID"), {B.CLASSED},
names AS (SELECT "primaryID", name, unnest(CASE WHEN len(synonyms) = 0 THEN [NULL] ELSE synonyms END) AS synonym FROM records)
{NAMES_SET}""")
def hmdb_sssom(spark, folder):
    return P.mapping_set("HMDB", P.hmdb(part_records(spark, folder)))


# Wikidata: three mapping sets from redirects.


def _redirect_set(classes, taxon, label="name", alias="synonym"):
    sql = f"""WITH {redirects_sql(classes, taxon, label, alias)},
edges AS (SELECT DISTINCT "primaryID", "secondaryID" FROM redirects WHERE "secondaryID" <> ''), {B.CLASSED},
names AS (SELECT DISTINCT "primaryID", "{label}" AS name, "{alias}" AS synonym FROM redirects)
{NAMES_SET}"""

    def run(spark, folder):
        rows = G.redirects_by_class(triples(spark, folder), classes, V.HUMAN_TAXON if taxon else None, label, alias)
        return P.mapping_set("Wikidata", P.wikidata(staged(rows), label, alias), label, alias)

    return sql, run


for _name, _args in {
    "wikidata_metabolites_sssom": (V.CHEMICAL_CLASSES, False),
    "wikidata_genes_sssom": (V.GENE_CLASSES, True, *GENE_LABELS),
    "wikidata_proteins_sssom": (V.PROTEIN_CLASSES, True),
}.items():
    _sql, _run = _redirect_set(*_args)
    query(_sql, _name)(_run)


# Header, export and report.


@query("""SELECT * FROM (VALUES
  (0, '# curie_map:'), (1, '#   UniProt: "http://identifiers.org/uniprot/"'),
  (2, '#   IAO: "http://purl.obolibrary.org/obo/IAO_"'), (3, '#   oboInOwl: "http://www.geneontology.org/formats/oboInOwl#"'),
  (4, '# mapping_provider: "orders"'), (6, '#'), (7, '# mapping_set_id: "set_1"'), (8, '# mapping_set_description: "All orders."'),
  (9, '# license: "https://creativecommons.org/publicdomain/zero/1.0/"'), (10, '# mapping_date: "2024-01-01"')) AS t(seq, line)
UNION ALL SELECT 5, '# source: "' || min(kind) || '"' FROM (SELECT CASE WHEN o_orderkey < 0 THEN 'other' ELSE 'orders' END AS kind FROM orders)""")
def sssom_header(spark, folder):
    rows = B.table(spark, folder, "orders")
    rows = rows.select("o_orderkey", F.when(F.col("o_orderkey") < 0, "other").otherwise("orders").alias("source"))
    meta = P.set_metadata("UniProt", provider="orders", set_id="set_1", description="All orders.", date="2024-01-01")
    return S.header_rows(rows, meta)


@query(f"""WITH {B.LIVE_EDGES}, {B.CLASSED}
SELECT "primaryID" AS subject_id, {B.PREDICATE_CASE} AS predicate_id, "secondaryID" AS object_id, mapping_cardinality,
  {B.COMMENT_CASE} AS "comment" FROM classed""")
def sssom_rows(spark, folder):
    """A mapping set written with its header and read back; its single source is in the header."""
    rows = K.describe_mappings(B.live_edges(spark, folder), note_retired=False).withColumn("source", F.lit("lineitem"))
    path = work_folder(spark)
    write_sssom(staged(S.sssom_of_plain(rows)), path, P.set_metadata("UniProt", provider="lineitem"))
    return scan_export(spark, path, S.PLAIN_COLUMNS[:-1])


@query("""SELECT 'UniProt:' || l_partkey AS subject_id, CASE WHEN l_returnflag = 'A' THEN 'Entry Withdrawn' ELSE 'UniProt:' || l_suppkey END AS object_id FROM lineitem""")
def sssom_curies(spark, folder):
    ids = B.table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("subject_id"),
        F.when(F.col("l_returnflag") == "A", V.WITHDRAWN).otherwise(F.col("l_suppkey").cast("string")).alias("object_id"),
    )
    return S.with_curies(ids, "UniProt:")


@query(f"""WITH {LABEL_PAIRS}, gone AS (SELECT * FROM m WHERE "primaryID" = 'Entry Withdrawn')
SELECT 'withdrawn id is a target' AS "check", CASE WHEN "secondaryID" IN (SELECT "primaryID" FROM m) THEN 'true' ELSE 'false' END AS outcome, count(*) AS n FROM gone GROUP BY 2
UNION ALL SELECT 'withdrawn id has labels', CASE WHEN "secondaryID" IN (SELECT "primaryID" FROM l) THEN 'true' ELSE 'false' END, count(*) FROM gone GROUP BY 2
UNION ALL SELECT 'every mapping has a class', CASE WHEN bool_and(regexp_full_match(coalesce(mapping_cardinality, ''), '1:1|n:1|1:n|n:n|1:0')) THEN 'true' ELSE 'false' END, count(*) FROM m
UNION ALL SELECT 'mapping rows', NULL, count(*) FROM m
UNION ALL SELECT 'label rows', NULL, count(*) FROM l
UNION ALL SELECT 'orphan target symbols', NULL, count(*) FROM m WHERE "primarySymbol" <> 'Entry Withdrawn'
  AND NOT EXISTS (SELECT 1 FROM l WHERE l."primarySymbol" = m."primarySymbol" OR l."secondarySymbol" = m."primarySymbol")""")
def quality_report(spark, folder):
    return Q.quality_report(*label_pairs(spark, folder))


@query(f"""WITH {LABEL_PAIRS}
SELECT * FROM m WHERE "primarySymbol" <> 'Entry Withdrawn'
  AND NOT EXISTS (SELECT 1 FROM l WHERE l."primarySymbol" = m."primarySymbol" OR l."secondarySymbol" = m."primarySymbol")""")
def orphan_labels(spark, folder):
    return Q.orphan_labels(*label_pairs(spark, folder))


@query(f"""WITH {WITHDRAWALS}, targets_ AS (SELECT unnest(string_split(targets, ', ')) AS target FROM withdrawals)
SELECT 'every target is approved or withdrawn' AS "check",
  CASE WHEN bool_and(regexp_matches(target, 'Approved|Entry Withdrawn')) THEN 'true' ELSE 'false' END AS outcome, count(*) AS n FROM targets_""")
def target_status_check(spark, folder):
    rows = symbol_withdrawals(spark, folder).select(C.targets_or_status("targets", "STATUS").alias("targets"))
    targets = L.explode_targets(rows, "targets")
    return Q.all_match(targets, "status", "Approved|Entry Withdrawn", "every target is approved or withdrawn")
