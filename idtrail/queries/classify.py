"""Mapping classes, predicates and comments."""

from __future__ import annotations

from pyspark.sql import functions as F

from idtrail.functions import clean as C, vocab as V
from idtrail.operators import cardinality as K, labels as L
from idtrail.queries import base as B
from idtrail.queries.base import query


@query(f"""WITH {B.LIVE_EDGES}, {B.CLASSED}
SELECT "primaryID", "secondaryID", mapping_cardinality, {B.PREDICATE_CASE} AS "predicateID" FROM classed""")
def cardinality_edges(spark, folder):
    return K.with_predicate(K.with_cardinality(B.live_edges(spark, folder)))


@query(f"""WITH {B.EDGES}, {B.CLASSED}
SELECT "primaryID", "secondaryID", mapping_cardinality, {B.PREDICATE_CASE} AS "predicateID",
  {B.DATE_CASE} || {B.COMMENT_CASE} || ' Release: v1.' AS "comment" FROM classed""")
def cardinality_withdrawn(spark, folder):
    rows = K.with_predicate(K.with_cardinality(B.edges(spark, folder)))
    rows = K.with_comment(rows, date="date", release="v1")
    return rows.select("primaryID", "secondaryID", K.CLASS, K.PREDICATE, "comment")


@query(f"""WITH {B.EDGES}, {B.CLASSED}
SELECT "primaryID", "secondaryID", "secondarySymbol", {B.PREDICATE_CASE} AS "predicateID", mapping_cardinality,
  {B.DATE_CASE} || {B.COMMENT_CASE} || {B.RETIRED_CASE} || ' Release: v1.' AS "comment",
  'lineitem' AS "source" FROM classed""")
def described_mappings(spark, folder):
    """For each old id: where it maps now, and how."""
    rows = K.describe_mappings(B.edges(spark, folder), date="date", release="v1")
    rows = rows.withColumn("source", F.lit("lineitem"))
    return rows.select("primaryID", "secondaryID", "secondarySymbol", K.PREDICATE, K.CLASS, "comment", "source")


@query(f"""WITH {B.EDGES}
SELECT "primaryID", "secondaryID",
  "primaryID" IN (SELECT "secondaryID" FROM edges) AS target_retired FROM edges""")
def retired_target_flag(spark, folder):
    return K.flag_retired_target(B.edges(spark, folder).select("primaryID", "secondaryID"))


@query(f"""WITH {B.LIVE_EDGES},
flagged AS (SELECT "primaryID" IN (SELECT "secondaryID" FROM edges) AS target_retired FROM edges)
SELECT target_retired, count(*) AS n FROM flagged GROUP BY target_retired""")
def retired_target_counts(spark, folder):
    flagged = K.flag_retired_target(B.live_edges(spark, folder))
    return flagged.groupBy("target_retired").agg(F.count("*").alias("n"))


def symbol_withdrawals(spark, folder):
    """Withdrawn-symbol rows: orders as old ids, their customers as targets."""
    status = F.col("o_orderstatus")
    customer = F.concat(F.lit("H:"), "o_custkey", F.lit("|C"), "o_custkey", F.lit("|Approved"))
    other = F.concat(F.lit(", H:"), F.floor(F.col("o_orderkey") / 2), F.lit("|W|Entry Withdrawn"))
    return B.table(spark, folder, "orders").select(
        F.concat(F.lit("H:"), "o_orderkey").alias("HGNC_ID"),
        F.when(status == "F", V.WITHDRAWN).otherwise("Merged/Split").alias("STATUS"),
        F.concat(F.lit("W"), "o_custkey", F.lit("."), "o_orderpriority").alias("WITHDRAWN_SYMBOL"),
        F.when(status == "F", "").when(status == "P", F.concat(customer, other)).otherwise(customer).alias("targets"),
    )


WITHDRAWALS = """withdrawals AS (
  SELECT 'H:' || o_orderkey AS "secondaryID", 'W' || o_custkey || '.' || o_orderpriority AS "secondarySymbol",
    CASE o_orderstatus WHEN 'F' THEN 'Entry Withdrawn'
      WHEN 'P' THEN 'H:' || o_custkey || '|C' || o_custkey || '|Approved, H:' || (o_orderkey // 2) || '|W|Entry Withdrawn'
      ELSE 'H:' || o_custkey || '|C' || o_custkey || '|Approved' END AS targets
  FROM orders),
withdrawals_counted AS (
  SELECT *, count(*) OVER (PARTITION BY targets) AS n FROM withdrawals),
withdrawals_classed AS (
  SELECT *, CASE WHEN contains(targets, ', ') THEN '1:n' WHEN targets = 'Entry Withdrawn' THEN '1:0'
    WHEN n = 1 THEN '1:1' ELSE 'n:1' END AS mapping_cardinality FROM withdrawals_counted)"""


@query(f"""WITH {WITHDRAWALS}
SELECT "secondaryID", "secondarySymbol", targets, mapping_cardinality FROM withdrawals_classed""")
def cardinality_list_form(spark, folder):
    rows = symbol_withdrawals(spark, folder).select(
        F.col("HGNC_ID").alias("secondaryID"),
        F.col("WITHDRAWN_SYMBOL").alias("secondarySymbol"),
        C.targets_or_status("targets", "STATUS").alias("targets"),
    )
    return K.with_list_cardinality(rows, "targets")


@query(f"""WITH {WITHDRAWALS}, parts AS (
  SELECT "secondaryID", unnest(string_split(targets, ', ')) AS target FROM withdrawals)
SELECT "secondaryID", string_split(target, '|')[1] AS "primaryID",
  CASE WHEN contains(target, '|') THEN string_split(target, '|')[2] ELSE target END AS "primarySymbol",
  CASE WHEN contains(target, '|') THEN string_split(target, '|')[3] ELSE target END AS "status" FROM parts""")
def explode_targets(spark, folder):
    rows = symbol_withdrawals(spark, folder)
    rows = rows.select(F.col("HGNC_ID").alias("secondaryID"), C.targets_or_status("targets", "STATUS").alias("targets"))
    return L.explode_targets(rows, "targets")


@query(f"""WITH all_edges AS (SELECT * FROM (WITH {B.EDGES} SELECT * FROM edges)),
edges AS (SELECT * FROM all_edges WHERE "primaryID" <> 'Entry Withdrawn'), {B.CLASSED}
SELECT "primaryID", "secondaryID", mapping_cardinality, {B.PREDICATE_CASE} AS "predicateID",
  {B.COMMENT_CASE} || ' Release: v1.' AS "comment", 'live' AS "source" FROM classed
UNION ALL
SELECT 'Entry Withdrawn', "secondaryID", '1:0', 'oboInOwl:consider',
  'ID (subject) withdrawn/deprecated. Release: v1.', 'deleted' FROM all_edges WHERE "primaryID" = 'Entry Withdrawn'""")
def append_withdrawn(spark, folder):
    live, gone = K.split_withdrawn(B.edges(spark, folder).select("primaryID", "secondaryID"))
    live = K.describe_mappings(live, release="v1", note_retired=False).withColumn("source", F.lit("live"))
    return K.append_withdrawn(live, gone, release="v1", source="deleted")


@query("""SELECT l_orderkey || '-' || l_suppkey AS "secondaryID",
  CASE WHEN l_returnflag <> 'A' THEN l_partkey || '-' || l_suppkey END AS "primaryID",
  count(*) OVER (PARTITION BY CASE WHEN l_returnflag <> 'A' THEN l_partkey || '-' || l_suppkey END) AS n_rows
FROM lineitem""")
def window_counts(spark, folder):
    rows = B.edges(spark, folder).select("secondaryID", F.nullif("primaryID", F.lit(V.WITHDRAWN)).alias("primaryID"))
    return K.with_group_size(rows, "primaryID", "n_rows")


@query(f"""WITH {B.EDGES}, {B.CLASSED}
SELECT "primaryID", "secondaryID", {B.DATE_CASE} || {B.COMMENT_CASE} AS "comment" FROM classed""")
def strip_release(spark, folder):
    rows = K.describe_mappings(B.edges(spark, folder), date="date", release="2024-01", note_retired=False)
    return rows.select("primaryID", "secondaryID", C.without_release("comment").alias("comment"))
