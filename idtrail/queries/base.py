"""Registry, and the mapping data that the queries take from the given tables.

Mappings come from whole tables: an old id is ``orderkey-suppkey``, its current id is
``partkey-suppkey``. Both share one domain, so that targets can be retired themselves, and all
classes occur at every scale. Lines with return flag A (a third of the table) count as withdrawn.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from idtrail.functions import vocab as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(fn):
        QUERIES[name or fn.__name__] = fn
        if sql:
            SQL[name or fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def old_id():
    return F.concat_ws("-", "l_orderkey", "l_suppkey")


def current_id():
    return F.concat_ws("-", "l_partkey", "l_suppkey")


def live_edges(spark, folder) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    return rows.select(current_id().alias("primaryID"), old_id().alias("secondaryID"))


LIVE_EDGES = """edges AS (
  SELECT l_partkey || '-' || l_suppkey AS "primaryID", l_orderkey || '-' || l_suppkey AS "secondaryID"
  FROM lineitem)"""


def edges(spark, folder) -> DataFrame:
    """Mappings with withdrawn targets, old symbols and retirement dates (some missing)."""
    gone = F.col("l_returnflag") == "A"
    return table(spark, folder, "lineitem").select(
        F.when(gone, V.WITHDRAWN).otherwise(current_id()).alias("primaryID"),
        old_id().alias("secondaryID"),
        F.concat(F.lit("S"), "l_orderkey", F.lit("."), "l_linestatus").alias("secondarySymbol"),
        F.when(F.col("l_tax") > 0, F.date_format("l_shipdate", "yyyyMMdd")).alias("date"),
    )


EDGES = """edges AS (
  SELECT CASE WHEN l_returnflag = 'A' THEN 'Entry Withdrawn' ELSE l_partkey || '-' || l_suppkey END AS "primaryID",
         l_orderkey || '-' || l_suppkey AS "secondaryID",
         'S' || l_orderkey || '.' || l_linestatus AS "secondarySymbol",
         CASE WHEN l_tax > 0 THEN strftime(l_shipdate, '%Y%m%d') END AS "date"
  FROM lineitem)"""

COUNTED = """counted AS (
  SELECT *, count(*) OVER (PARTITION BY "primaryID") AS n_pri, count(*) OVER (PARTITION BY "secondaryID") AS n_sec
  FROM edges)"""

CLASS_CASE = """CASE WHEN "primaryID" = 'Entry Withdrawn' THEN '1:0'
  WHEN n_pri > 1 AND n_sec = 1 THEN 'n:1' WHEN n_pri = 1 AND n_sec = 1 THEN '1:1'
  WHEN n_pri = 1 AND n_sec > 1 THEN '1:n' WHEN n_pri > 1 AND n_sec > 1 THEN 'n:n' END"""

CLASSED = f"""{COUNTED},
classed AS (SELECT *, {CLASS_CASE} AS mapping_cardinality FROM counted)"""

PREDICATE_CASE = """CASE WHEN mapping_cardinality IN ('1:0', '1:n', 'n:n') THEN 'oboInOwl:consider'
  WHEN mapping_cardinality IN ('1:1', 'n:1') THEN 'IAO:0100001' END"""

COMMENT_CASE = """CASE mapping_cardinality WHEN '1:n' THEN 'ID (subject) is split into multiple.'
  WHEN '1:1' THEN 'ID (subject) is replaced.'
  WHEN 'n:n' THEN 'This ID (subject) and other ID(s) are merged/split into multiple ID(s).'
  WHEN 'n:1' THEN 'This ID (subject) and other ID(s) are merged into one ID.'
  WHEN '1:0' THEN 'ID (subject) withdrawn/deprecated.' END"""

DATE_CASE = """CASE WHEN "date" IS NULL THEN '' ELSE 'Withdrawn date: ' || "date" || '. ' END"""
RETIRED_CASE = """CASE WHEN "primaryID" IN (SELECT "secondaryID" FROM edges) THEN ' Object is also withdrawn.' ELSE '' END"""
