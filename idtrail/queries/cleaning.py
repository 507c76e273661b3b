"""Row filters and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from idtrail.functions import clean as C, vocab as V
from idtrail.operators import quality as Q, rows as R
from idtrail.queries import base as B
from idtrail.queries.base import query


@query("""WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS "GeneID",
  CASE WHEN c_nationkey < 10 THEN '9606' WHEN c_nationkey < 15 THEN '10090' ELSE CAST(c_nationkey AS VARCHAR) END AS "#tax_id" FROM customer)
SELECT 'human' AS kept, * FROM c WHERE "#tax_id" = '9606'
UNION ALL SELECT 'human and mouse', * FROM c WHERE "#tax_id" IN ('9606', '10090')""")
def taxon_filter(spark, folder):
    nation = F.col("c_nationkey")
    taxon = F.when(nation < 10, "9606").when(nation < 15, "10090").otherwise(nation.cast("string"))
    rows = B.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("GeneID"), taxon.alias("#tax_id"))
    human = R.keep_taxon(rows).withColumn("kept", F.lit("human"))
    return human.unionByName(R.keep_taxon(rows, V.HUMAN_AND_MOUSE).withColumn("kept", F.lit("human and mouse")))


@query("""SELECT doc_id, CASE WHEN lang IN ('en') THEN NULL ELSE lang END AS lang,
  CASE WHEN source IN ('src1', 'src3') THEN NULL ELSE source END AS source,
  CASE WHEN lang <> 'fr' THEN source ELSE 'Entry Withdrawn' END AS target,
  CASE WHEN source <> 'src2' THEN source ELSE lang END AS targets,
  coalesce(trim(text) <> '' AND text <> '-', false) AS usable FROM documents""")
def sentinel_normalise(spark, folder):
    docs = B.table(spark, folder, "documents")
    coded = docs.select(
        "doc_id",
        F.when(F.col("lang") == "en", "-").otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("source") == "src1", "").when(F.col("source") == "src3", "NA").otherwise(F.col("source")).alias("source"),
        C.target_or_withdrawn(F.when(F.col("lang") == "fr", "-").otherwise(F.col("source"))).alias("target"),
        C.targets_or_status(F.when(F.col("source") == "src2", "").otherwise(F.col("source")), F.col("lang")).alias("targets"),
        C.is_label("text").alias("usable"),
    )
    return R.normalise(coded, ["lang", "source"])


@query("""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, line FROM lines WHERE trim(line) <> '' AND NOT starts_with(line, 'T')""")
def comment_lines(spark, folder):
    docs = B.table(spark, folder, "documents")
    return R.drop_comment_lines(docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line")), "line", "T")


@query("""SELECT page_id, CAST(page_id AS VARCHAR) AS entity, regexp_replace(url, '^https?://', '') AS literal, url AS iri FROM pages""")
def rdf_term_clean(spark, folder):
    rows = B.table(spark, folder, "pages").select(
        "page_id",
        F.concat(F.lit(f"<{V.ENTITY_IRI}"), "page_id", F.lit(">")).alias("entity"),
        F.concat(F.lit('"'), F.regexp_replace("url", "^https?://", ""), F.lit('"@en')).alias("literal"),
        F.concat(F.lit("<"), "url", F.lit(">")).alias("iri"),
    )
    return rows.select("page_id", *[C.rdf_term(c).alias(c) for c in ("entity", "literal", "iri")])


@query("""SELECT doc_id, lower(source) || '/' || lang AS path, replace(text, ' ', '') AS squeezed, contains(text, 'the') AS has_the,
  regexp_matches(text, '[0-9]') AS has_digit, lang IN ('en', 'fr') AS listed, text IS NULL AS missing,
  regexp_replace(text, ' Release.*', '', 's') AS cut FROM documents""")
def text_scalars(spark, folder):
    return B.table(spark, folder, "documents").select(
        "doc_id",
        F.concat(F.lower("source"), F.lit("/"), "lang").alias("path"),
        C.without_blanks("text").alias("squeezed"),
        F.col("text").contains("the").alias("has_the"),
        F.col("text").rlike("[0-9]").alias("has_digit"),
        F.col("lang").isin("en", "fr").alias("listed"),
        F.col("text").isNull().alias("missing"),
        C.without_release("text").alias("cut"),
    )


@query("""SELECT p_partkey || '|' || p_brand || '|' || p_type AS triple, CAST(p_partkey AS VARCHAR) AS id, p_brand AS symbol, p_type AS status,
  string_split(p_name, ' ')[1] AS first_word, p_partkey || '-' || p_size AS pair FROM part WHERE p_name <> ''""")
def triple_fields(spark, folder):
    rows = R.drop_empty(B.table(spark, folder, "part"), "p_name")
    rows = R.ids_as_text(rows, "p_partkey").withColumn("triple", F.concat_ws("|", "p_partkey", "p_brand", "p_type"))
    return rows.select(
        "triple",
        C.triple_id("triple").alias("id"),
        C.triple_symbol("triple").alias("symbol"),
        C.triple_status("triple").alias("status"),
        F.get(C.split_list("p_name", " "), 0).alias("first_word"),
        F.concat("p_partkey", F.lit("-"), "p_size").alias("pair"),
    )


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS stamp, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def date_stamp(spark, folder):
    rows = B.table(spark, folder, "orders")
    return rows.select("o_orderkey", C.date_stamp("o_orderdate").alias("stamp"), C.date_stamp("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("""SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand = 'Brand#7'""")
def point_lookup(spark, folder):
    return R.look_up(B.table(spark, folder, "part"), "p_brand", "Brand#7").select("p_partkey", "p_name", "p_brand")


@query("""SELECT p_partkey, p_name, p_brand FROM part ORDER BY p_name, p_partkey LIMIT 20""")
def preview_limit(spark, folder):
    rows = B.table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    return R.preview(rows, ["p_name", "p_partkey"], 20)


MARK = '<html lang="fr"'


@query(f"""WITH lines AS (SELECT page_id AS file, unnest(string_split(html, chr(10))) AS value FROM pages)
SELECT * FROM lines WHERE file NOT IN (SELECT file FROM lines WHERE contains(value, '{MARK}'))""")
def failed_extract_gate(spark, folder):
    """Lines of the pages that hold no failure mark on any line."""
    return Q.reject_failed_extracts(_page_lines(spark, folder), mark=MARK)


def _page_lines(spark, folder):
    pages = B.table(spark, folder, "pages")
    return pages.select(F.col("page_id").alias("file"), F.explode(F.split("html", "\n")).alias("value"))


@query(f"""WITH lines AS (SELECT page_id AS file, unnest(string_split(html, chr(10))) AS value FROM pages)
SELECT file, count(*) AS n_marks FROM lines WHERE contains(value, '{MARK}') GROUP BY file""")
def failed_extracts(spark, folder):
    return Q.failed_extracts(_page_lines(spark, folder), mark=MARK)
