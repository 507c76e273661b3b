"""Entities of a class with their redirects, labels and aliases, from a table of triples.

Lay the table out partitioned by ``predicate``: every step filters on it, so a query then reads
only the predicates it names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from idtrail.functions import vocab as V
from idtrail.operators.joins import all_equal, completed, key_sides


def entities_of_class(triples: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Distinct entities that belong to one of ``classes``, directly or through a statement."""
    in_class = F.col("object").isin(*classes)
    found = triples.where((F.col("predicate") == V.INSTANCE_OF) & in_class).select("subject")
    for first, second in V.STATEMENT_PATHS:
        steps = triples.where(F.col("predicate") == first).select("subject", F.col("object").alias("statement"))
        ends = triples.where((F.col("predicate") == second) & in_class).select(F.col("subject").alias("statement"))
        found = found.union(steps.join(ends, "statement", "left_semi").select("subject"))  # a statement is of one entity
    return found.distinct()


def with_taxon(entities: DataFrame, triples: DataFrame, taxon: str) -> DataFrame:
    members = triples.where((F.col("predicate") == V.IN_TAXON) & (F.col("object") == taxon))
    return entities.join(members.select("subject").distinct(), "subject", "left_semi")


def english(triples: DataFrame, predicate: str, out: str) -> DataFrame:
    rows = triples.where((F.col("predicate") == predicate) & (F.col("lang") == "en"))
    return rows.select(F.col("subject").alias("primaryID"), F.col("object").alias(out)).distinct()


def redirects_by_class(
    triples: DataFrame,
    classes: Sequence[str],
    taxon: str | None = None,
    label: str = "name",
    alias: str = "synonym",
) -> DataFrame:
    """Distinct (primaryID, secondaryID, label, alias); what an entity lacks is NULL."""
    entities = entities_of_class(triples, classes)
    if taxon:
        entities = with_taxon(entities, triples, taxon)
    ids = entities.withColumnRenamed("subject", "primaryID")
    moved = triples.where(F.col("predicate") == V.SAME_AS)
    moved = moved.select(F.col("object").alias("primaryID"), F.col("subject").alias("secondaryID")).distinct()
    # Every part is distinct, so their joins are distinct as well: no final shuffle. An entity may have
    # many redirects and many aliases; labels are one or a few.
    key = ["primaryID"]
    rows = completed(moved.join(ids, key, "left_semi"), key_sides(ids, moved, key))
    rows = _joined(rows, english(triples, V.LABEL, label), label, "left", True)
    aliases = english(triples, V.ALT_LABEL, alias)
    return _joined(rows, completed(aliases, key_sides(ids, aliases, key)), alias, "inner", False)


def _joined(rows: DataFrame, part: DataFrame, value: str, how: str, hashed: bool) -> DataFrame:
    """Join by id, or by id and its hash: joins that take turns shuffle the rows anew, so each can split them."""
    part = part.select(F.col("primaryID").alias("__id"), value)
    pairs = [(rows["primaryID"], part["__id"])]
    pairs += [(F.xxhash64(rows["primaryID"]), F.xxhash64(part["__id"]))] if hashed else []
    return rows.join(part, all_equal(pairs), how).drop("__id")
