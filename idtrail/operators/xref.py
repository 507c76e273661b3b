"""Cross-reference graph of ids and labels as four plain tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from idtrail.functions import clean as C, vocab as V

ID, NAME = "id", "label"


def xref_edges(
    mappings: DataFrame | None = None,
    labels: DataFrame | None = None,
    label_columns: dict[str, bool] | None = None,
    mapping_label: str | None = None,
    primary: str = "primaryID",
    secondary: str = "secondaryID",
) -> DataFrame:
    """Distinct edges primary -> target; withdrawn targets and unusable labels are left out.

    ``label_columns`` names the label columns of ``labels`` and whether the label is a primary
    one. ``mapping_label`` is a label column that the mappings carry themselves. Leave ``labels``
    out where labels are attributes and not nodes.
    """
    parts = []
    if mappings is not None:
        live = mappings.where(F.col(primary).isNotNull() & (F.col(primary) != V.WITHDRAWN))
        parts.append(_targets(live.where(F.col(secondary).isNotNull()), primary, secondary, ID, False))
        if mapping_label:
            parts.append(_targets(live.where(C.is_label(mapping_label)), primary, mapping_label, NAME, False))
    for column, is_primary in (label_columns or {}).items():
        usable = labels.where(F.col(primary).isNotNull() & C.is_label(column))
        parts.append(_targets(usable, primary, column, NAME, is_primary))
    edges = reduce(DataFrame.unionByName, parts)
    return edges.groupBy(primary, "target", "kind").agg(F.bool_or("is_primary").alias("is_primary"))


def _targets(df, primary, column, kind, is_primary) -> DataFrame:
    return df.select(
        F.col(primary),
        F.trim(F.col(column)).alias("target"),
        F.lit(kind).alias("kind"),
        F.lit(is_primary).alias("is_primary"),
    )


def xref_nodes(
    edges: DataFrame,
    primaries: DataFrame | None = None,
    codes: tuple[str, str] | None = None,
    primary: str = "primaryID",
) -> DataFrame:
    """Distinct nodes; a node is primary if it is primary anywhere."""
    own = edges.select(primary) if primaries is None else edges.select(primary).union(primaries.select(primary))
    own = own.select(F.col(primary).alias("id"), F.lit(ID).alias("kind"), F.lit(True).alias("is_primary"))
    targets = edges.select(F.col("target").alias("id"), "kind", "is_primary")
    nodes = own.unionByName(targets).groupBy("id", "kind").agg(F.bool_or("is_primary").alias("is_primary"))
    if codes:
        code = F.when(F.col("kind") == ID, codes[0]).otherwise(codes[1])
        nodes = nodes.withColumn("system_code", code)
    return nodes


def xref_links(
    edges: DataFrame, primaries: DataFrame | None = None, primary: str = "primaryID"
) -> DataFrame:
    """One self link per primary id plus one link per edge.

    Edges are distinct as they come; only the primary ids are made so. An edge that is a self link
    already is left out.
    """
    own = edges.select(primary) if primaries is None else edges.select(primary).union(primaries.select(primary))
    own = own.select(F.col(primary).alias("source_id"), F.col(primary).alias("target_id"), F.lit(ID).alias("target_kind"))
    links = edges.where((F.col("kind") != ID) | (F.col(primary) != F.col("target"))).select(
        F.col(primary).alias("source_id"), F.col("target").alias("target_id"), F.col("kind").alias("target_kind")
    )
    return own.distinct().unionByName(links)


def xref_attributes(
    labels: DataFrame,
    columns: tuple[str, ...] = ("name", "synonym"),
    attribute: str = V.SYNONYM_ATTRIBUTE,
    primary: str = "primaryID",
) -> DataFrame:
    """Distinct (id, attribute, value) rows of the label columns."""
    values = F.explode(F.array(*[F.col(c) for c in columns]))
    rows = labels.select(F.col(primary).alias("id"), F.lit(attribute).alias("attr_name"), values.alias("attr_value"))
    return rows.where(F.trim("attr_value") != "").distinct()


def xref_sets(edges: DataFrame, pages: int = 1, primary: str = "primaryID") -> DataFrame:
    """Targets of each primary as sets, on up to ``pages`` pages each; one shuffle.

    All targets are kept. A row holds about one ``pages``-th of a primary's targets: ask for more
    pages where some primaries have millions.
    """
    page = F.pmod(F.xxhash64("target", "kind"), F.lit(pages)).cast("int")
    target = F.struct(F.col("target").alias("id"), "kind")
    return edges.groupBy(primary, page.alias("page")).agg(F.collect_set(target).alias("targets"))


def build_info(
    facts: DataFrame, source: str, version: str, build_date: str | None = None, datatype: str = "Identifiers"
) -> DataFrame:
    """(key, value) rows that describe one build.

    ``facts`` is a one-row table whose columns become rows too; it may bring BUILDDATE itself.
    """
    fixed = {"DATASOURCENAME": source, "DATASOURCEVERSION": version, "DATATYPE": datatype}
    fixed |= {"BUILDDATE": build_date} if build_date is not None else {}
    facts = facts.select(*[F.col(c).cast("string").alias(c) for c in facts.columns])
    facts = facts.withColumns({k: F.lit(v) for k, v in fixed.items()})
    return facts.unpivot([], facts.columns, "key", "value")
