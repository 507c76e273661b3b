"""Join forms on keys with many rows on both sides, NULL keys and missing partners."""

from __future__ import annotations

from pyspark.sql import functions as F

from idtrail.functions import clean as C, vocab as V
from idtrail.operators import joins as J, labels as L, rows as R, sssom as S
from idtrail.queries import base as B
from idtrail.queries.base import query
from idtrail.session import staged
from idtrail.sources.manifest import manifest_entries, with_metadata


def _part_edges(spark, folder):
    rows = B.table(spark, folder, "lineitem")
    return rows.select((F.col("l_partkey") + 750).cast("string").alias("primaryID"), B.old_id().alias("secondaryID"))


def _customer_names(spark, folder):
    return B.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("primaryID"),
        F.col("c_name").alias("name"),
        F.explode(F.array("c_mktsegment", F.concat(F.lit("N"), "c_nationkey"))).alias("synonym"),
    )


@query("""WITH edges AS (
  SELECT DISTINCT CAST(l_partkey + 750 AS VARCHAR) AS "primaryID", l_orderkey || '-' || l_suppkey AS "secondaryID" FROM lineitem),
names AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "primaryID", c_name AS name, unnest([c_mktsegment, 'N' || c_nationkey]) AS synonym FROM customer)
SELECT coalesce(e."primaryID", n."primaryID") AS subject_id, n.name AS subject_label, e."secondaryID" AS object_id, n.synonym AS object_label
FROM edges e FULL JOIN names n ON e."primaryID" = n."primaryID" """)
def names_full_join(spark, folder):
    rows = R.drop_self_mappings(_part_edges(spark, folder)).distinct()
    rows = J.full_join(rows, _customer_names(spark, folder), ["primaryID"])
    names = {"primaryID": "subject_id", "name": "subject_label", "secondaryID": "object_id", "synonym": "object_label"}
    return R.rename(rows, names).select(*names.values())


@query("""WITH rows_ AS (
  SELECT CAST(l_partkey AS VARCHAR) AS "primaryID", l_orderkey || '-' || l_suppkey AS "secondaryID", p_name AS name, p_brand AS synonym
  FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL SELECT CAST(p_partkey + 10000000 AS VARCHAR), '', p_name, p_brand FROM part),
labels_ AS (SELECT DISTINCT "primaryID", name, synonym FROM rows_),
edges AS (SELECT DISTINCT "primaryID", "secondaryID" FROM rows_ WHERE "secondaryID" <> ''),
""" + B.CLASSED + f"""
SELECT l."primaryID" AS subject_id, l.name AS subject_label, {B.PREDICATE_CASE} AS predicate_id, c."secondaryID" AS object_id,
  l.synonym AS object_label, c.mapping_cardinality
FROM labels_ l LEFT JOIN classed c ON l."primaryID" = c."primaryID" """)
def dedup_back_join(spark, folder):
    """A denormalised extract split into classified mappings and labels, joined back once."""
    part = B.table(spark, folder, "part")
    moved = B.table(spark, folder, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    label = [F.col("p_name").alias("name"), F.col("p_brand").alias("synonym")]
    moved = moved.select(F.col("l_partkey").cast("string").alias("primaryID"), B.old_id().alias("secondaryID"), *label)
    unmoved = part.select((F.col("p_partkey") + 10_000_000).cast("string").alias("primaryID"), F.lit("").alias("secondaryID"), *label)
    return S.sssom_of_redirects(moved.unionByName(unmoved), stage=staged)


@query("""WITH o AS (SELECT 'H' || o_custkey AS "primaryID", nullif(o_orderpriority, '5-LOW') AS "secondarySymbol",
  'O' || o_orderkey AS "secondaryID" FROM orders),
c AS (SELECT CASE WHEN c_nationkey <> 3 THEN 'H' || c_custkey END AS "primaryID", unnest(['2-HIGH', NULL, '9-NONE']) AS "secondarySymbol",
  c_name AS "primarySymbol" FROM customer)
SELECT coalesce(o."primaryID", c."primaryID") AS "primaryID", coalesce(o."secondarySymbol", c."secondarySymbol") AS "secondarySymbol",
  "secondaryID", "primarySymbol"
FROM o FULL JOIN c ON o."primaryID" IS NOT DISTINCT FROM c."primaryID" AND o."secondarySymbol" IS NOT DISTINCT FROM c."secondarySymbol" """)
def nullsafe_two_key_join(spark, folder):
    orders, customer = B.table(spark, folder, "orders"), B.table(spark, folder, "customer")
    mappings = orders.select(
        F.concat(F.lit("H"), "o_custkey").alias("primaryID"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("secondarySymbol"),
        F.concat(F.lit("O"), "o_orderkey").alias("secondaryID"),
    )
    labels = customer.select(
        F.when(F.col("c_nationkey") != 3, F.concat(F.lit("H"), "c_custkey")).alias("primaryID"),
        F.explode(F.array(F.lit("2-HIGH"), F.lit(None).cast("string"), F.lit("9-NONE"))).alias("secondarySymbol"),
        F.col("c_name").alias("primarySymbol"),
    )
    return J.full_join(mappings, labels, ["primaryID", "secondarySymbol"])


@query(f"""WITH {B.EDGES},
current_ AS (SELECT s_suppkey || '-' || s_suppkey AS id, s_name AS symbol FROM supplier
  UNION ALL SELECT l_partkey || '-' || l_suppkey, CASE WHEN l_linenumber = 1 THEN 'P' || l_partkey END FROM lineitem),
own AS (SELECT "secondaryID", min("secondarySymbol") AS symbol FROM edges GROUP BY 1),
cur AS (SELECT id, min(symbol) AS symbol FROM current_ GROUP BY 1)
SELECT e."primaryID", e."secondaryID",
  CASE WHEN e."primaryID" = 'Entry Withdrawn' THEN 'Entry Withdrawn' ELSE coalesce(c.symbol, o.symbol) END AS "primarySymbol"
FROM edges e LEFT JOIN cur c ON e."primaryID" = c.id LEFT JOIN own o ON e."primaryID" = o."secondaryID" """)
def lookup_with_fallback(spark, folder):
    symbol = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("P"), "l_partkey"))
    lines = B.table(spark, folder, "lineitem").select(B.current_id().alias("id"), symbol.alias("symbol"))
    suppliers = B.table(spark, folder, "supplier")
    suppliers = suppliers.select(F.concat_ws("-", "s_suppkey", "s_suppkey").alias("id"), F.col("s_name").alias("symbol"))
    edges = B.edges(spark, folder)
    return L.with_current_symbol(edges, suppliers.union(lines)).select("primaryID", "secondaryID", "primarySymbol")


@query("""SELECT s_name AS "primaryID", n_name AS datasource, CASE WHEN n_regionkey > 0 THEN 'release ' || n_regionkey END AS metadata
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def metadata_lookup(spark, folder):
    nation = B.table(spark, folder, "nation")
    value = F.when(F.col("n_regionkey") > 0, F.concat(F.lit("metadata=release "), "n_regionkey")).otherwise("metadata=")
    manifest = manifest_entries(nation.select(F.col("n_name").alias("datasource"), value.alias("value")))
    rows = B.table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.col("s_name").alias("primaryID"), F.col("n_name").alias("datasource"))
    return with_metadata(rows, manifest, "metadata", "metadata").select("primaryID", "datasource", "metadata")


@query(f"""WITH {B.EDGES}, gone AS (SELECT * FROM edges WHERE "primaryID" = 'Entry Withdrawn')
SELECT * FROM gone UNION ALL
SELECT * FROM edges WHERE "primaryID" IN (SELECT "secondaryID" FROM gone)""")
def withdrawn_closure(spark, folder):
    return S.withdrawn_closure(B.edges(spark, folder))


@query(f"""WITH {B.EDGES}, gone AS (SELECT * FROM edges WHERE "primaryID" = 'Entry Withdrawn')
SELECT * FROM edges WHERE "primaryID" <> 'Entry Withdrawn' AND "primaryID" NOT IN (SELECT "secondaryID" FROM gone)""")
def outside_closure(spark, folder):
    return S.outside_closure(B.edges(spark, folder))


def label_pairs(spark, folder):
    """Mappings and label rows with NULL symbols on both sides."""
    orders, customer = B.table(spark, folder, "orders"), B.table(spark, folder, "customer")
    target = F.when(F.col("o_orderstatus") == "F", V.WITHDRAWN).otherwise(F.concat(F.lit("H"), "o_custkey"))
    prio = F.col("o_orderpriority")
    mappings = orders.select(
        target.alias("primaryID"),
        F.when(F.col("o_orderstatus") == "F", V.WITHDRAWN)
        .otherwise(F.concat(F.when(prio == "4-NOT SPECIFIED", "X").otherwise("C"), "o_custkey"))
        .alias("primarySymbol"),
        F.concat(F.lit("H"), F.col("o_orderkey") + 700).alias("secondaryID"),
        F.when(prio != "5-LOW", F.concat(F.lit("W"), "o_custkey", prio)).alias("secondarySymbol"),
        prio.alias("predicateID"),
        F.col("o_orderstatus").alias("mapping_cardinality"),
        F.when(prio != "1-URGENT", F.concat(F.lit("m "), prio)).alias("comment"),
        F.lit("orders").alias("source"),
    )
    labels = customer.select(
        F.concat(F.lit("H"), "c_custkey").alias("primaryID"),
        F.concat(F.lit("C"), "c_custkey").alias("primarySymbol"),
        F.explode(F.array(
            F.concat(F.lit("W"), "c_custkey", F.lit("2-HIGH")),
            F.concat(F.lit("W"), "c_nationkey", F.lit("1-URGENT")),
            F.lit(None).cast("string"),
        )).alias("secondarySymbol"),
        F.lit(None).cast("string").alias("predicateID"),
        F.lit(None).cast("string").alias("mapping_cardinality"),
        F.when(F.col("c_nationkey") > 4, F.col("c_mktsegment")).alias("comment"),
        F.lit("customer").alias("source"),
    )
    return mappings, labels


LABEL_PAIRS = """m AS (
  SELECT CASE WHEN o_orderstatus = 'F' THEN 'Entry Withdrawn' ELSE 'H' || o_custkey END AS "primaryID",
    CASE WHEN o_orderstatus = 'F' THEN 'Entry Withdrawn' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'X' || o_custkey
      ELSE 'C' || o_custkey END AS "primarySymbol",
    'H' || (o_orderkey + 700) AS "secondaryID",
    CASE WHEN o_orderpriority <> '5-LOW' THEN 'W' || o_custkey || o_orderpriority END AS "secondarySymbol",
    o_orderpriority AS "predicateID", o_orderstatus AS mapping_cardinality,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN 'm ' || o_orderpriority END AS "comment", 'orders' AS "source" FROM orders),
l AS (
  SELECT 'H' || c_custkey AS "primaryID", 'C' || c_custkey AS "primarySymbol",
    unnest(['W' || c_custkey || '2-HIGH', 'W' || c_nationkey || '1-URGENT', NULL]) AS "secondarySymbol",
    CASE WHEN c_nationkey > 4 THEN c_mktsegment END AS "comment", 'customer' AS "source" FROM customer)"""

MERGED = """gone AS (SELECT * FROM m WHERE "primaryID" = 'Entry Withdrawn'),
ewd AS (SELECT * FROM gone UNION ALL SELECT * FROM m WHERE "primaryID" IN (SELECT "secondaryID" FROM gone)),
rest AS (SELECT * FROM m WHERE "primaryID" NOT IN (SELECT "primaryID" FROM ewd)),
aside AS (SELECT * FROM ewd UNION ALL SELECT * FROM rest r
  WHERE NOT EXISTS (SELECT 1 FROM l WHERE l."secondarySymbol" IS NOT DISTINCT FROM r."secondarySymbol")),
uncovered AS (SELECT * FROM rest r
  WHERE EXISTS (SELECT 1 FROM l WHERE l."secondarySymbol" IS NOT DISTINCT FROM r."secondarySymbol")
    AND EXISTS (SELECT 1 FROM ewd a WHERE a."secondarySymbol" IS NOT DISTINCT FROM r."secondarySymbol")),
covered AS (SELECT * FROM rest r
  WHERE NOT EXISTS (SELECT 1 FROM aside a WHERE a."secondarySymbol" IS NOT DISTINCT FROM r."secondarySymbol"))
SELECT coalesce(c."primaryID", l."primaryID") AS subject_id, coalesce(c."primarySymbol", l."primarySymbol") AS subject_label,
  c."predicateID" AS predicate_id, c."secondaryID" AS object_id, coalesce(c."secondarySymbol", l."secondarySymbol") AS object_label,
  c.mapping_cardinality, nullif(concat_ws(' ', c."comment", l."comment"), '') AS "comment",
  nullif(concat_ws(' ', c."source", l."source"), '') AS "source"
FROM covered c FULL JOIN l ON c."primaryID" IS NOT DISTINCT FROM l."primaryID"
  AND c."primarySymbol" IS NOT DISTINCT FROM l."primarySymbol" AND c."secondarySymbol" IS NOT DISTINCT FROM l."secondarySymbol"
UNION ALL
SELECT "primaryID", "primarySymbol", "predicateID", "secondaryID", "secondarySymbol", mapping_cardinality, "comment", "source" FROM aside"""

HELD = """ UNION ALL
SELECT "primaryID", "primarySymbol", "predicateID", "secondaryID", "secondarySymbol", mapping_cardinality, "comment", "source" FROM uncovered"""


@query(f"WITH {LABEL_PAIRS}, {MERGED}")
def merge_mappings_labels(spark, folder):
    """As in the published sets, which lose the held-back mappings."""
    return S.merge_mappings_labels(*label_pairs(spark, folder), held_rows="drop", stage=staged)


@query(f"WITH {LABEL_PAIRS}, {MERGED}{HELD}")
def merge_keeps_held_rows(spark, folder):
    return S.merge_mappings_labels(*label_pairs(spark, folder), stage=staged)


@query(f"""WITH {LABEL_PAIRS}
SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM l WHERE l."secondarySymbol" IS NOT DISTINCT FROM m."secondarySymbol")""")
def nullsafe_anti_join(spark, folder):
    mappings, labels = label_pairs(spark, folder)
    return J.anti_join(mappings, labels, ["secondarySymbol"], null_safe=True)


@query("""SELECT coalesce(nullif(p_type, 'SMALL'), '-') AS kind, count(*) AS n FROM part
WHERE p_type <> 'SMALL' GROUP BY 1""")
def set_difference(spark, folder):
    """Kinds without the dash, with their row counts."""
    kinds = B.table(spark, folder, "part").select(F.coalesce(F.nullif("p_type", F.lit("SMALL")), F.lit("-")).alias("kind"))
    known = kinds.select("kind").distinct().where("kind != '-'")
    return J.semi_join(kinds, known, ["kind"]).groupBy("kind").agg(F.count("*").alias("n"))


@query("""SELECT p_name AS "primaryID", nullif(concat_ws(' ', CASE WHEN p_size > 25 THEN p_type END,
  CASE WHEN p_size < 40 THEN p_brand END), '') AS merged FROM part""")
def merged_text(spark, folder):
    size = F.col("p_size")
    merged = C.join_text(F.when(size > 25, F.col("p_type")), F.when(size < 40, F.col("p_brand")))
    return B.table(spark, folder, "part").select(F.col("p_name").alias("primaryID"), merged.alias("merged"))
