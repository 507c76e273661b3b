"""Cross-reference graph and redirects from triples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from idtrail.functions import clean as C, vocab as V
from idtrail.operators import labels as L, redirects as G, xref as X
from idtrail.queries import base as B
from idtrail.queries.base import query
from idtrail.queries.labelling import GENES, genes
from idtrail.session import staged, work_folder
from idtrail.sinks.tables import write_xref_graph
from idtrail.sources.triples import scan_triples, write_triples

GRAPH = f"""{GENES},
mappings AS (
  SELECT CASE WHEN l_returnflag = 'A' THEN 'Entry Withdrawn' ELSE CAST(l_partkey AS VARCHAR) END AS "primaryID",
    CAST(l_suppkey AS VARCHAR) AS "secondaryID", CASE WHEN l_linestatus = 'F' THEN 'S' || l_suppkey ELSE '-' END AS "secondarySymbol" FROM lineitem),
all_edges AS (
  SELECT "primaryID", "secondaryID" AS target, 'id' AS kind, false AS is_primary FROM mappings WHERE "primaryID" <> 'Entry Withdrawn'
  UNION ALL SELECT "primaryID", "secondarySymbol", 'label', false FROM mappings WHERE "primaryID" <> 'Entry Withdrawn' AND "secondarySymbol" <> '-'
  UNION ALL SELECT "primaryID", "Symbol", 'label', true FROM genes
  UNION ALL SELECT "primaryID", alias, 'label', false FROM (SELECT "primaryID", unnest(string_split(aliases, '|')) AS alias FROM genes WHERE aliases <> '-') WHERE alias <> ''),
edges AS (SELECT "primaryID", target, kind, bool_or(is_primary) AS is_primary FROM all_edges GROUP BY 1, 2, 3)"""


def graph_edges(spark, folder) -> DataFrame:
    lines = B.table(spark, folder, "lineitem")
    mappings = lines.select(
        F.when(F.col("l_returnflag") == "A", V.WITHDRAWN).otherwise(F.col("l_partkey").cast("string")).alias("primaryID"),
        F.col("l_suppkey").cast("string").alias("secondaryID"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("S"), "l_suppkey")).otherwise("-").alias("secondarySymbol"),
    )
    names = L.explode_list(genes(spark, folder), "aliases", "alias", keep_empty=True)
    return X.xref_edges(mappings, names, {"Symbol": True, "alias": False}, "secondarySymbol")


@query(f"""WITH {GRAPH} SELECT * FROM edges""")
def xref_edges(spark, folder):
    return graph_edges(spark, folder)


@query(f"""WITH {GRAPH}, nodes AS (
  SELECT "primaryID" AS id, 'id' AS kind, true AS is_primary FROM edges UNION ALL SELECT target, kind, is_primary FROM edges)
SELECT id, kind, bool_or(is_primary) AS is_primary, CASE kind WHEN 'id' THEN 'L' ELSE 'O' END AS system_code FROM nodes GROUP BY id, kind""")
def xref_nodes(spark, folder):
    return X.xref_nodes(graph_edges(spark, folder), codes=V.SYSTEM_CODES["NCBI"])


@query(f"""WITH {GRAPH}
SELECT "primaryID" AS source_id, "primaryID" AS target_id, 'id' AS target_kind FROM edges
UNION SELECT "primaryID", target, kind FROM edges""")
def xref_links(spark, folder):
    return X.xref_links(graph_edges(spark, folder))


@query(f"""WITH {GRAPH}, nodes AS (
  SELECT "primaryID" AS id, 'id' AS kind, true AS is_primary FROM edges UNION ALL SELECT target, kind, is_primary FROM edges)
SELECT 'node' AS what, id AS a, kind AS b, CAST(bool_or(is_primary) AS VARCHAR) AS c FROM nodes GROUP BY id, kind
UNION ALL SELECT 'link', "primaryID", "primaryID", 'id' FROM (SELECT DISTINCT "primaryID" FROM edges)
UNION ALL SELECT 'link', "primaryID", target, kind FROM edges WHERE "primaryID" <> target OR kind <> 'id'
UNION ALL SELECT DISTINCT 'attribute', CAST(p_partkey AS VARCHAR), 'Synonym', p_brand FROM part
UNION ALL SELECT 'info', unnest(['DATASOURCENAME', 'DATASOURCEVERSION', 'DATATYPE', 'BUILDDATE']), unnest(['parts', '1', 'Identifiers', '20240101']), NULL""")
def xref_graph_round_trip(spark, folder):
    """The four tables of a graph, written together and read back."""
    edges = staged(graph_edges(spark, folder))
    names = B.table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("primaryID"), F.col("p_brand").alias("name"))
    path = work_folder(spark)
    info = X.build_info(spark.range(1).drop("id"), "parts", "1", "20240101")
    write_xref_graph(path, X.xref_nodes(edges), X.xref_links(edges), X.xref_attributes(names, ("name",)), info)
    columns = {"node": ("nodes", "id", "kind", "is_primary"), "link": ("links", "source_id", "target_id", "target_kind"),
               "attribute": ("attributes", "id", "attr_name", "attr_value"), "info": ("info", "key", "value", None)}
    parts = []
    for what, (name, *own) in columns.items():
        chosen = [(F.lit(None) if c is None else F.col(c)).cast("string").alias(k) for k, c in zip("abc", own)]
        parts.append(spark.read.parquet(f"{path}/{name}").select(F.lit(what).alias("what"), *chosen))
    return reduce(DataFrame.unionByName, parts)


@query("""SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS id, 'Synonym' AS attr_name, unnest([p_name, p_brand]) AS attr_value FROM part""")
def xref_attributes(spark, folder):
    part = B.table(spark, folder, "part")
    labels = part.select(F.col("p_partkey").cast("string").alias("primaryID"), F.col("p_name").alias("name"), F.col("p_brand").alias("synonym"))
    return X.xref_attributes(labels)


@query(f"""WITH {GRAPH}
SELECT "primaryID", 0 AS page, string_agg(kind || ':' || target, '|' ORDER BY kind || ':' || target) AS targets FROM edges GROUP BY 1""")
def xref_sets(spark, folder):
    sets = X.xref_sets(graph_edges(spark, folder))
    named = F.transform("targets", lambda t: F.concat(t["kind"], F.lit(":"), t["id"]))
    return sets.select("primaryID", "page", F.array_join(F.sort_array(named), "|").alias("targets"))


@query(f"""WITH {GRAPH}
SELECT "primaryID", string_agg(kind || ':' || target, '|' ORDER BY kind || ':' || target) AS targets FROM edges GROUP BY 1""")
def xref_sets_paged(spark, folder):
    """Sets on seven pages, put together again."""
    sets = X.xref_sets(graph_edges(spark, folder), pages=7)
    named = F.transform("targets", lambda t: F.concat(t["kind"], F.lit(":"), t["id"]))
    whole = sets.groupBy("primaryID").agg(F.flatten(F.collect_list(named)).alias("named"))
    return whole.select("primaryID", F.array_join(F.sort_array("named"), "|").alias("targets"))


@query("""SELECT 'BUILDDATE' AS key, strftime(max(o_orderdate), '%Y%m%d') AS value FROM orders
UNION ALL SELECT 'ROWS', CAST(count(*) AS VARCHAR) FROM orders UNION ALL SELECT 'DATASOURCENAME', 'orders'
UNION ALL SELECT 'DATASOURCEVERSION', '1' UNION ALL SELECT 'DATATYPE', 'Identifiers'""")
def build_info(spark, folder):
    """Build facts, the date and row count among them taken from the data."""
    facts = B.table(spark, folder, "orders").agg(
        C.date_stamp(F.max("o_orderdate")).alias("BUILDDATE"), F.count("*").alias("ROWS")
    )
    return X.build_info(facts, "orders", "1")


def triples(spark, folder) -> DataFrame:
    """Suppliers as entities of a class (directly or through a statement), customers as redirects."""
    supplier, customer = B.table(spark, folder, "supplier"), B.table(spark, folder, "customer")
    entity, nation = F.concat(F.lit("Q"), "s_suppkey"), F.col("s_nationkey")
    statement = F.concat(F.lit("st"), "s_suppkey")
    kind = F.when(nation < 8, "Q7187").when(nation < 14, "Q8054").when(nation < 18, "Q11173").otherwise("Q79529")
    none = F.lit(None).cast("string")

    def rows(df, subject, predicate, object_, lang=none):
        return df.select(subject.alias("subject"), predicate.alias("predicate"), object_.alias("object"), lang.alias("lang"))

    direct = F.col("s_acctbal") > 4000
    step = F.when(direct, "wdt:P31").when(nation > 10, "p:P31").otherwise("p:P279")
    end = F.when(nation > 10, "ps:P31").otherwise("ps:P279")
    redirect = F.concat(F.lit("Q"), F.col("c_custkey") + 1_000_000)
    parts = [
        rows(supplier, entity, step, F.when(direct, kind).otherwise(statement)),
        rows(supplier, statement, end, kind),
        rows(supplier, entity, F.lit("wdt:P703"), F.when(nation != 5, V.HUMAN_TAXON).otherwise("Q83310")),
        rows(customer, redirect, F.lit("owl:sameAs"), F.concat(F.lit("Q"), F.floor(F.col("c_custkey") / 12))),
        rows(supplier, entity, F.lit("rdfs:label"), F.col("s_name"), F.when(nation > 2, "en").otherwise("fr")),
        rows(supplier, entity, F.lit("skos:altLabel"), F.concat(F.lit("N"), nation), F.when(nation != 3, "en").otherwise("de")),
        rows(supplier, entity, F.lit("skos:altLabel"), F.concat(F.lit("alias "), "s_name"), F.lit("en")),
    ]
    path = work_folder(spark)
    write_triples(reduce(DataFrame.union, parts), path)
    return scan_triples(spark, path)


TRIPLES = """kinds AS (
  SELECT *, CASE WHEN s_nationkey < 8 THEN 'Q7187' WHEN s_nationkey < 14 THEN 'Q8054' WHEN s_nationkey < 18 THEN 'Q11173' ELSE 'Q79529' END AS kind FROM supplier),
triples AS (
  SELECT 'Q' || s_suppkey AS subject, CASE WHEN s_acctbal > 4000 THEN 'wdt:P31' WHEN s_nationkey > 10 THEN 'p:P31' ELSE 'p:P279' END AS predicate,
    CASE WHEN s_acctbal > 4000 THEN kind ELSE 'st' || s_suppkey END AS object, NULL AS lang FROM kinds
  UNION ALL SELECT 'st' || s_suppkey, CASE WHEN s_nationkey > 10 THEN 'ps:P31' ELSE 'ps:P279' END, kind, NULL FROM kinds
  UNION ALL SELECT 'Q' || s_suppkey, 'wdt:P703', CASE WHEN s_nationkey <> 5 THEN 'Q15978631' ELSE 'Q83310' END, NULL FROM kinds
  UNION ALL SELECT 'Q' || (c_custkey + 1000000), 'owl:sameAs', 'Q' || (c_custkey // 12), NULL FROM customer
  UNION ALL SELECT 'Q' || s_suppkey, 'rdfs:label', s_name, CASE WHEN s_nationkey > 2 THEN 'en' ELSE 'fr' END FROM kinds
  UNION ALL SELECT 'Q' || s_suppkey, 'skos:altLabel', 'N' || s_nationkey, CASE WHEN s_nationkey <> 3 THEN 'en' ELSE 'de' END FROM kinds
  UNION ALL SELECT 'Q' || s_suppkey, 'skos:altLabel', 'alias ' || s_name, 'en' FROM kinds)"""


def redirects_sql(classes, taxon, label="name", alias="synonym") -> str:
    """CTEs up to ``redirects``."""
    listed = ", ".join(f"'{c}'" for c in classes)
    in_taxon = f"""WHERE subject IN (SELECT subject FROM triples WHERE predicate = 'wdt:P703' AND object = '{V.HUMAN_TAXON}')""" if taxon else ""
    return f"""{TRIPLES},
members AS (
  SELECT subject FROM triples WHERE predicate = 'wdt:P31' AND object IN ({listed})
  UNION SELECT a.subject FROM triples a JOIN triples b ON a.object = b.subject
    WHERE b.object IN ({listed}) AND ((a.predicate = 'p:P31' AND b.predicate = 'ps:P31') OR (a.predicate = 'p:P279' AND b.predicate = 'ps:P279'))),
redirects AS (
  SELECT DISTINCT m.subject AS "primaryID", r.subject AS "secondaryID", n.object AS "{label}", s.object AS "{alias}"
  FROM (SELECT * FROM members {in_taxon}) m
  LEFT JOIN triples r ON r.predicate = 'owl:sameAs' AND r.object = m.subject
  LEFT JOIN triples n ON n.predicate = 'rdfs:label' AND n.subject = m.subject AND n.lang = 'en'
  LEFT JOIN triples s ON s.predicate = 'skos:altLabel' AND s.subject = m.subject AND s.lang = 'en')"""


GENE_LABELS = ("primarySymbol", "secondarySymbol")


@query(f"WITH {redirects_sql(V.CHEMICAL_CLASSES, False)} SELECT * FROM redirects")
def redirects_by_class(spark, folder):
    return G.redirects_by_class(triples(spark, folder), V.CHEMICAL_CLASSES)


@query(f"WITH {redirects_sql(V.GENE_CLASSES, True, *GENE_LABELS)} SELECT * FROM redirects")
def gene_redirects(spark, folder):
    return G.redirects_by_class(triples(spark, folder), V.GENE_CLASSES, V.HUMAN_TAXON, *GENE_LABELS)


@query(f"WITH {redirects_sql(V.PROTEIN_CLASSES, True)} SELECT * FROM redirects")
def protein_redirects(spark, folder):
    return G.redirects_by_class(triples(spark, folder), V.PROTEIN_CLASSES, V.HUMAN_TAXON)
