"""Symbols, aliases, synonyms and their label tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from idtrail.operators import labels as L
from idtrail.queries import base as B
from idtrail.queries.base import query

# A gene-info table made of parts: some parts have a naming authority, some have no aliases.
GENES = """genes AS (
  SELECT CAST(p_partkey AS VARCHAR) AS "primaryID", 'G' || p_partkey AS "Symbol",
    CASE WHEN p_size >= 48 THEN p_brand WHEN p_size < 5 THEN 'G' || p_partkey ELSE '-' END AS authority,
    CASE WHEN p_type = 'SMALL' THEN '-' ELSE replace(p_name, ' ', '|') || '||' || p_brand END AS aliases FROM part),
named AS (SELECT *, CASE WHEN authority NOT IN ('-', "Symbol") THEN "Symbol" || '|' || authority ELSE "Symbol" END AS "primarySymbol" FROM genes),
official AS (SELECT DISTINCT authority FROM genes WHERE authority NOT IN ('-', "Symbol"))"""


def genes(spark, folder):
    symbol = F.concat(F.lit("G"), "p_partkey")
    size = F.col("p_size")
    return B.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("primaryID"),
        symbol.alias("Symbol"),
        F.when(size >= 48, F.col("p_brand")).when(size < 5, symbol).otherwise("-").alias("authority"),
        F.when(F.col("p_type") == "SMALL", "-")
        .otherwise(F.concat(F.replace("p_name", F.lit(" "), F.lit("|")), F.lit("||"), "p_brand"))
        .alias("aliases"),
    )


@query(f"""WITH {GENES} SELECT "primaryID", "primarySymbol" FROM named""")
def primary_symbols(spark, folder):
    rows = L.with_primary_symbol(genes(spark, folder), "Symbol", "authority")
    return L.primary_ids(rows, ("primaryID", "primarySymbol"))


@query(f"""WITH {GENES} SELECT authority AS symbol FROM official""")
def nomenclature_symbols(spark, folder):
    return L.nomenclature_symbols(genes(spark, folder), "Symbol", "authority")


@query(f"""WITH {GENES}, parts AS (SELECT "primaryID", unnest(string_split(aliases, '|')) AS "secondarySymbol" FROM genes WHERE aliases <> '-')
SELECT * FROM parts WHERE "secondarySymbol" <> '' UNION ALL SELECT "primaryID", NULL FROM genes WHERE aliases = '-'""")
def alias_explode(spark, folder):
    rows = genes(spark, folder).select("primaryID", "aliases")
    return L.explode_list(rows, "aliases", "secondarySymbol", keep_empty=True)


@query(f"""WITH {GENES}, parts AS (
  SELECT "primaryID", "primarySymbol", unnest(string_split(aliases, '|')) AS "secondarySymbol" FROM named WHERE aliases <> '-')
SELECT *, CASE WHEN "secondarySymbol" IN (SELECT authority FROM official) THEN 'The secondary symbol is the nomenclature symbol'
  ELSE 'Unofficial symbol for the gene' END || ' Release: v1.' AS "comment" FROM parts WHERE "secondarySymbol" <> '' """)
def alias_typed(spark, folder):
    rows = genes(spark, folder)
    named = L.with_primary_symbol(rows, "Symbol", "authority").select("primaryID", "primarySymbol", "aliases")
    return L.explode_typed_aliases(named, "aliases", L.nomenclature_symbols(rows, "Symbol", "authority"), "v1")


@query("""WITH parts AS (
  SELECT CAST(p_partkey AS VARCHAR) AS "primaryID", p_name AS "primarySymbol",
    CASE WHEN p_type = 'PROMO' THEN [NULL] ELSE string_split(p_name, ' ') END AS alias,
    CASE WHEN p_size > 25 THEN [NULL] ELSE [p_brand, p_type] END AS prev FROM part),
both_ AS (
  SELECT DISTINCT "primaryID", "primarySymbol", s AS "secondarySymbol", CASE WHEN s IS NOT NULL THEN 'alias' END AS "comment"
    FROM (SELECT *, unnest(alias) AS s FROM parts)
  UNION SELECT DISTINCT "primaryID", "primarySymbol", s, CASE WHEN s IS NOT NULL THEN 'previous' END FROM (SELECT *, unnest(prev) AS s FROM parts))
SELECT * FROM both_ b WHERE "secondarySymbol" IS NOT NULL
  OR "primaryID" NOT IN (SELECT "primaryID" FROM both_ WHERE "secondarySymbol" IS NOT NULL)""")
def label_suppression(spark, folder):
    rows = B.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("primaryID"),
        F.col("p_name").alias("primarySymbol"),
        F.when(F.col("p_type") != "PROMO", F.replace("p_name", F.lit(" "), F.lit("|"))).alias("alias"),
        F.when(F.col("p_size") <= 25, F.concat_ws("|", "p_brand", "p_type")).alias("prev"),
    )
    keys = ("primaryID", "primarySymbol")
    previous = L.explode_commented_list(rows.select(*keys, "prev"), "prev", "previous")
    alias = L.explode_commented_list(rows.select(*keys, "alias"), "alias", "alias")
    return L.merge_label_tables(previous, alias)


@query("""WITH parts AS (SELECT CAST(p_partkey AS VARCHAR) AS "primaryID", p_brand AS name,
  CASE WHEN p_size > 20 THEN string_split(p_name, ' ') ELSE [NULL] END AS s FROM part)
SELECT "primaryID", name, unnest(s) AS synonym FROM parts""")
def explode_synonyms(spark, folder):
    rows = B.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("primaryID"),
        F.col("p_brand").alias("name"),
        F.when(F.col("p_size") > 20, F.split("p_name", " ")).alias("synonyms"),
    )
    return L.explode_synonyms(rows, keep_empty=True)


@query(f"""WITH {GENES}, odd AS (SELECT "primaryID", "Symbol", CASE WHEN authority = '-' THEN 'NA' ELSE authority END AS authority,
  CASE WHEN aliases = '-' THEN 'NA|x' ELSE aliases END AS aliases FROM genes)
SELECT "primaryID", CASE WHEN authority <> "Symbol" THEN "Symbol" || '|' || authority ELSE "Symbol" END AS "primarySymbol", part AS alias
FROM (SELECT *, unnest(string_split(aliases, '|')) AS part FROM odd) WHERE part <> '' """)
def alias_na_text(spark, folder):
    """Where a source writes a dash for no value, NA is a symbol like any other."""
    def text(c):
        return F.when(F.col(c) == "-", "NA|x" if c == "aliases" else "NA").otherwise(F.col(c))

    odd = genes(spark, folder).withColumns({c: text(c) for c in ("authority", "aliases")})
    named = L.with_primary_symbol(odd, "Symbol", "authority", missing=("-", ""))
    return L.explode_list(named.select("primaryID", "primarySymbol", "aliases"), "aliases", "alias", missing=("-", ""))
