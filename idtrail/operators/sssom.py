"""Second stage: mappings and labels joined into one published mapping set (SSSOM)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from idtrail.functions import clean as C, vocab as V
from idtrail.operators.cardinality import CLASS, PREDICATE, split_withdrawn, with_cardinality, with_predicate
from idtrail.operators.joins import anti_join, flag_member, full_join, full_join_few, grouped, lookup, semi_join
from idtrail.operators.rows import drop_empty, drop_self_mappings

NAME_COLUMNS = ("subject_id", "subject_label", "predicate_id", "object_id", "object_label", CLASS)
GENE_COLUMNS = NAME_COLUMNS + ("comment", "source")
PLAIN_COLUMNS = ("subject_id", "predicate_id", "object_id", CLASS, "comment", "source")


@dataclass(frozen=True)
class SetMetadata:
    """What the header of a mapping set says."""

    prefixes: Mapping[str, str] = field(default_factory=dict)
    provider: str = ""
    set_id: str = ""
    description: str = ""
    date: str = ""
    comment: str = ""
    license: str = V.SSSOM_LICENSE


def to_sssom_columns(df: DataFrame, columns, label="primarySymbol", other_label="secondarySymbol") -> DataFrame:
    """Canonical names; the primary id is the subject, the secondary id the object."""
    names = {
        "primaryID": "subject_id",
        label: "subject_label",
        PREDICATE: "predicate_id",
        "secondaryID": "object_id",
        other_label: "object_label",
    }
    return df.withColumnsRenamed(names).select(*columns)


def classify(df: DataFrame) -> DataFrame:
    return with_predicate(with_cardinality(df))


def sssom_of_names(mappings: DataFrame, names: DataFrame, drop_self: bool = False) -> DataFrame:
    """Two-column mappings classified and joined with (primaryID, name, synonym) rows."""
    if drop_self:
        mappings = drop_self_mappings(mappings)
    rows = full_join(classify(mappings.select("primaryID", "secondaryID")), names, ["primaryID"])
    return to_sssom_columns(rows, NAME_COLUMNS, "name", "synonym")


def as_it_is(df: DataFrame) -> DataFrame:
    return df


def sssom_of_redirects(
    redirects: DataFrame, label: str = "name", alias: str = "synonym", stage: Callable[[DataFrame], DataFrame] = as_it_is
) -> DataFrame:
    """One denormalised table: its distinct mappings classified and joined back on its labels.

    The labels are made distinct first, or k secondaries of an id would give k times k rows. ``stage`` stores the distinct mappings,
    which four parts read.
    """
    mappings = stage(drop_empty(redirects).select("primaryID", "secondaryID").distinct())
    labels = redirects.select("primaryID", label, alias).distinct()
    rows = full_join(labels, classify(mappings), ["primaryID"])
    return to_sssom_columns(rows, NAME_COLUMNS, label, alias)


def withdrawn_closure(df: DataFrame, primary="primaryID", secondary="secondaryID") -> DataFrame:
    """Withdrawn mappings and the mappings whose target is one of their old ids (one hop)."""
    live, gone = split_withdrawn(df, primary)
    return gone.unionByName(semi_join(live, _retired(gone, primary, secondary), [primary]))


def outside_closure(df: DataFrame, primary="primaryID", secondary="secondaryID") -> DataFrame:
    """The rest: live mappings to targets that are not withdrawn themselves."""
    live, gone = split_withdrawn(df, primary)
    return anti_join(live, _retired(gone, primary, secondary), [primary])


def _retired(gone, primary, secondary) -> DataFrame:
    return gone.select(F.col(secondary).alias(primary)).where(F.col(primary).isNotNull())


def merge_mappings_labels(
    mappings: DataFrame, labels: DataFrame, held_rows: str = "append", stage: Callable[[DataFrame], DataFrame] = as_it_is
) -> DataFrame:
    """Mappings and label rows in one table, by how labels cover the mappings.

    Set aside: the withdrawn closure, and mappings whose old symbol no label row has. The other
    mappings join the label rows on id and both symbols (NULL matches NULL), then the rows set
    aside are appended. As in the published sets, a covered mapping whose old symbol also occurs in the
    withdrawn closure is held back from the join. ``held_rows``: ``append`` keeps it, without label text;
    ``join`` joins it all the same; ``drop`` leaves it out, as the published sets do.

    Withdrawn mappings, which share one target, are set apart before anything is looked up. ``stage``
    stores the flagged rows, which three parts read.
    """
    if held_rows not in ("append", "join", "drop"):
        raise ValueError(f"held_rows: {held_rows!r}")
    symbol = "secondarySymbol"
    covering = labels.select(symbol, F.lit(True).alias("__covered"), F.lit(False).alias("__held"))
    held = withdrawn_closure(mappings.select("primaryID", "secondaryID", symbol))
    held = held.select(symbol, F.lit(False).alias("__covered"), F.lit(True).alias("__held"))
    facts = grouped(covering.unionByName(held), [symbol])
    facts = facts.agg(F.bool_or("__covered").alias("__covered"), F.bool_or("__held").alias("__held")).drop("__apart")
    live, gone = split_withdrawn(mappings)
    rows = lookup(live, facts, [symbol], null_safe=True)
    rows = stage(flag_member(rows, gone.select("secondaryID"), "primaryID", "__points"))
    covered = ~F.col("__points") & F.coalesce(F.col("__covered"), F.lit(False))
    held_back = F.lit(False) if held_rows == "join" else F.coalesce(F.col("__held"), F.lit(False))
    joined = rows.where(covered & ~held_back).select(*mappings.columns)
    joined = _with_merged_text(joined, labels, ["primaryID", "primarySymbol", symbol])
    aside = rows.where(~covered | held_back) if held_rows == "append" else rows.where(~covered)
    return to_sssom_columns(joined.unionByName(aside.select(*joined.columns)).unionByName(gone.select(*joined.columns)), GENE_COLUMNS)


def _with_merged_text(mappings, labels, keys) -> DataFrame:
    text = ("comment", "source")
    left = mappings.withColumnsRenamed({c: f"{c}_mapping" for c in text})
    right = labels.drop(PREDICATE, CLASS).withColumnsRenamed({c: f"{c}_label" for c in text})
    rows = full_join(left, right, keys)
    merged = {c: C.join_text(f"{c}_mapping", f"{c}_label") for c in text}
    return rows.withColumns(merged).drop(*[f"{c}_{s}" for c in text for s in ("mapping", "label")])


def sssom_of_two_key_labels(mappings: DataFrame, labels: DataFrame) -> DataFrame:
    """Mappings joined with distinct label rows on id and old symbol; release notes are cut.

    Withdrawn mappings have no target whose labels could match: they are appended.
    """
    mappings, gone = split_withdrawn(mappings.withColumn("comment", C.without_release("comment")))
    labels = labels.select("primaryID", "primarySymbol", "secondarySymbol", F.col("source").alias("source_label")).distinct()
    left = mappings.withColumnRenamed("source", "source_mapping")
    if "primarySymbol" in left.columns:
        left = left.withColumnRenamed("primarySymbol", "own_symbol")
    rows = full_join_few(left, labels, ["primaryID", "secondarySymbol"])
    if "own_symbol" in left.columns:
        rows = rows.withColumn("primarySymbol", F.coalesce("primarySymbol", "own_symbol"))
    rows = rows.withColumn("source", C.join_text("source_mapping", "source_label"))
    if "primarySymbol" not in gone.columns:
        gone = gone.withColumn("primarySymbol", F.lit(None).cast("string"))
    return to_sssom_columns(rows, GENE_COLUMNS).unionByName(to_sssom_columns(gone, GENE_COLUMNS))


def sssom_of_plain(mappings: DataFrame) -> DataFrame:
    """Described mappings without labels."""
    return to_sssom_columns(mappings, PLAIN_COLUMNS)


def with_curies(df: DataFrame, prefix: str, columns=("subject_id", "object_id")) -> DataFrame:
    """Optional: ids prefixed for use as CURIEs; the withdrawn marker stays as it is."""
    return df.withColumns(
        {c: F.when(F.col(c) == V.WITHDRAWN, F.col(c)).otherwise(F.concat(F.lit(prefix), F.col(c))) for c in columns}
    )


def source_summary(df: DataFrame) -> DataFrame:
    """One row: the source if all rows agree on one, else NULL (two extremes, no distinct)."""
    low, high = F.min("source"), F.max("source")
    return df.agg(F.when(low == high, low).alias("source"))


def header_lines(meta: SetMetadata) -> tuple[list[str], list[str]]:
    """Header lines before and after the place of the single source.

    Order: prefixes, provider, the single source if there is one, set id, description, license,
    date, comment.
    """
    before = ["# curie_map:"] + [f'#   {k} "{v}"' for k, v in meta.prefixes.items()]
    before += [f'# mapping_provider: "{meta.provider}"'] if meta.provider else []
    after = [("mapping_set_id", meta.set_id), ("mapping_set_description", meta.description)]
    after += [("license", meta.license), ("mapping_date", meta.date), ("comment", meta.comment)]
    return before, [f'# {k}: "{v}"' for k, v in after if v]


def header_rows(df: DataFrame, meta: SetMetadata) -> DataFrame:
    """Header of a mapping set as (seq, line) rows."""
    before, after = header_lines(meta)
    place = len(before)  # of the source, which takes two lines
    fixed = [(i, s) for i, s in enumerate(before)] + [(place + 2 + i, s) for i, s in enumerate(after)]
    lines = df.sparkSession.createDataFrame(fixed, "seq int, line string")
    if "source" not in df.columns:
        return lines
    quoted = F.concat(F.lit('# source: "'), F.col("source"), F.lit('"'))
    source = source_summary(df).where(F.col("source").isNotNull())
    source = source.select(F.posexplode(F.array(quoted, F.lit("#"))).alias("seq", "line"))
    return lines.unionByName(source.withColumn("seq", F.col("seq") + place))


def single_source(df: DataFrame) -> str | None:
    """The one source of all rows, if they agree; reads one column and returns one value."""
    return source_summary(df).first()["source"] if "source" in df.columns else None
